"""String expressions: Column to Column, all on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_u(c: Column) -> Column:
    """Strips Unicode white space; trim() strips U+0020 only."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def strip_list_marker(c: Column) -> Column:
    """A leading number with a dot goes, then one bullet; not the other way round."""
    numbered = trim_u(F.regexp_replace(c, r"(?U)^\d+\.\s*", ""))
    return trim_u(F.regexp_replace(numbered, r"(?U)^[●•\-*]\s*", ""))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(path: Column) -> Column:
    """Lower-cased extension with its dot, or empty; a leading dot does not count."""
    return F.lower(F.regexp_extract(basename(path), r"[^.](\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"(?<=[^.])\.[^.]+$", "")


def renamed(path: Column, epoch: Column) -> Column:
    """File name for a place that is taken: stem_epoch.suffix, case kept."""
    return F.concat(stem(path), F.lit("_"), epoch.cast("string"), F.regexp_extract(basename(path), r"[^.](\.[^.]+)$", 1))


def api_base(url: Column) -> Column:
    return F.concat(F.regexp_replace(url, "/+$", ""), F.lit("/v1"))


def page_name(number: Column, tag: Column) -> Column:
    return F.format_string("page_%04d_%s.png", number, tag)


def sample_id(source_file: Column, page_no: Column) -> Column:
    """Deterministic: a retried task names a page as before."""
    return F.md5(F.concat_ws("|", source_file, page_no.cast("string")))


def image_path(sample: Column) -> Column:
    return F.concat(F.lit("images/"), sample, F.lit(".png"))


def manifest_path(sample: Column) -> Column:
    return F.concat(F.lit("manifests/"), sample, F.lit(".jsonl"))


def raw_path(sample: Column) -> Column:
    return F.concat(F.lit("chandra_raw/"), sample, F.lit(".html"))


def is_manifest(path: Column) -> Column:
    return path.startswith("manifests/") & path.endswith(".jsonl")


def falsy(c: Column, default: Column) -> Column:
    """The default for null and zero."""
    return F.coalesce(F.nullif(c, F.lit(0)), default)


def gate_message(gate: Column, reason: Column) -> Column:
    return F.format_string("[%s] %s", gate, reason)
