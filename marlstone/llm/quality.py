"""Quality rules with adaptive thresholds (native: DataFrame functions only).

Each text gets a few counts, once, in a written table.  Some of them, as
rates, are summarised per (lang, source) in KLL quantile sketches, which merge;
every partition pre-aggregates its own, so a hot source costs one small sketch
per partition and not a hot task.  Sketches merge upwards (source -> language
-> all), and a group with too few texts to have quartiles of its own borrows
its language's, or the whole corpus's.  The thresholds are fences ``FENCE``
spreads beyond the quartiles.  A spread is the group's own interquartile
range, but no less than ``SHARE`` of its language's and of the corpus's, so
that a group full of copies does not fence out the rest; where even that is
nothing, nothing is fenced.  No fence has a fixed number in it.  The table of
fences, a row for each group, is joined back to the counts; it is broadcast if
it has at most ``FEW`` rows.  Sketches compact at random, so a rate within their
error of a fence may be judged otherwise in another run; all rows of a run are
judged by the same written fences.

Defined results: a null or empty text has no words, so it fails the base rule.
A null language or source is a group like any other.  Repeated rows are judged
one by one.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"

#: Fixed base rule: fewest words, and most words (percent) in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
#: Rates whose fences are adaptive, and the sides that are fenced.  All of them vary in any prose, so their quartiles differ.
RATES = {"punct_rate": "high", "word_len": "both", "upper_rate": "high"}
FENCE, SHARE = 8.0, 0.5
SKETCH_K = 800  # a quartile is off by a third of a percent of the ranks or so; a sketch has some 10 kB
MIN_GROUP = 50  # texts that a group needs for thresholds of its own
FEW = 100_000  # fences to broadcast, of 100 bytes or so each
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def text_counts(text: Column) -> dict[str, Column]:
    """Cheap counts of one text, as JVM expressions."""
    t = F.coalesce(text, F.lit(""))
    bare = F.regexp_replace(t, SPACE, "")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(NOT_SPACE))
    return {
        "word_chars": F.length(bare).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long"),
        "n_upper": (F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long"),
        "n_punct": (F.length(t) - F.length(F.translate(t, PUNCTUATION, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def _windows(h: str) -> Column:
    """Hashes of all windows of WINDOW words, from the array of word hashes."""
    a = F.col(h)
    at = F.when(F.size(a) >= WINDOW, F.sequence(F.lit(1), F.size(a) - F.lit(WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(a, i + F.lit(j - 1)) for j in range(WINDOW)]))


def _repeat_words(d: DataFrame) -> DataFrame:
    """Words inside windows (``win``) that occur twice or more: the union of their places.

    Each step is a column of its own: a lambda would evaluate an inlined array again for every element.
    """
    win = F.col("win")
    # most texts repeat nothing; a set of the windows tells so without sorting them
    again = F.size(win) != F.size(F.array_distinct(win))
    d = d.withColumn("again", again)
    d = d.withColumn("placed", F.when(F.col("again"), F.array_sort(F.transform(win, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))).drop("win", "again")
    placed = F.col("placed")
    alike = lambda i, x: F.coalesce(F.get(placed, i)["h"] == x["h"], F.lit(False))
    d = d.withColumn("at", F.array_sort(F.transform(F.filter(placed, lambda x, i: alike(i - 1, x) | alike(i + 1, x)), lambda x: x["i"]))).drop("placed")
    step = lambda acc, i: F.struct((acc["n"] + (i + WINDOW) - F.greatest(acc["end"], i)).alias("n"), (i + WINDOW).alias("end"))
    total = F.aggregate("at", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda acc: acc["n"].cast("long"))
    return d.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("at")


def features(docs: DataFrame, text: str = "text", columns: Sequence[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (all, or those named) in one struct ``row``, and the counts beside it."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in (docs.columns if columns is None else columns)]).alias("row"), F.col(f"`{text}`").alias("t"))
    d = d.select("row", *[c.alias(n) for n, c in text_counts(F.col("t")).items()], F.filter(F.split(F.coalesce("t", F.lit("")), SPACE, -1), lambda x: x != "").alias("w"))
    d = d.withColumn("h", F.transform("w", lambda x: F.xxhash64(x))).drop("w")
    d = d.withColumn("n_words", F.size("h").cast("long")).withColumn("win", _windows("h")).drop("h")
    return _repeat_words(d)


def rates(n: dict[str, Column]) -> dict[str, Column]:
    chars = F.greatest(n["word_chars"], F.lit(1)).cast("double")
    return {
        "punct_rate": n["n_punct"] / chars,
        "word_len": n["word_chars"] / F.greatest(n["n_words"], F.lit(1)).cast("double"),
        "upper_rate": n["n_upper"] / chars,
    }


def thresholds(counted: DataFrame) -> DataFrame:
    """One row for each group of ``counted`` (g_lang, g_source, n_words and the rates): ``lo_<rate>`` and ``hi_<rate>``.

    Texts under MIN_WORDS words do not count: they fail anyway.
    """
    d = counted.select("g_lang", "g_source", F.when(F.col("n_words") >= MIN_WORDS, F.struct(*RATES)).alias("r"))
    groups = d.groupBy("g_lang", "g_source").agg(F.count("r").alias("n"), *[F.kll_sketch_agg_double(F.col(f"r.{k}"), SKETCH_K).alias(k) for k in RATES])
    by_lang = groups.groupBy("g_lang").agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(k).alias(k) for k in RATES])
    every = by_lang.agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(k).alias(k) for k in RATES])

    def quartiles(df: DataFrame, tag: str, *keys: str) -> DataFrame:
        q = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(k, F.lit(r))).alias(f"{tag}_{k}_{name}") for k in RATES for name, r in (("q1", 0.25), ("q3", 0.75))]
        return df.select(*keys, F.col("n").alias(f"{tag}_n"), *q)

    g = quartiles(groups, "g", "g_lang", "g_source")
    la = quartiles(by_lang, "l", F.col("g_lang").alias("l_lang"))
    ev = quartiles(every, "e", F.lit(1).alias("one"))
    j = g.join(la, F.col("g_lang").eqNullSafe(F.col("l_lang"))).withColumn("one", F.lit(1)).join(ev, "one")
    enough = {tag: F.col(f"{tag}_n") >= MIN_GROUP for tag in "gl"}
    out = []
    for k, side in RATES.items():
        q1, q3 = (F.when(enough["g"], F.col(f"g_{k}_{q}")).when(enough["l"], F.col(f"l_{k}_{q}")).otherwise(F.col(f"e_{k}_{q}")) for q in ("q1", "q3"))
        range_of = lambda tag: F.col(f"{tag}_{k}_q3") - F.col(f"{tag}_{k}_q1")
        spread = F.greatest(F.when(enough["g"], range_of("g")), F.when(enough["l"], range_of("l") * F.when(enough["g"], SHARE).otherwise(1.0)), range_of("e") * F.when(enough["l"], SHARE).otherwise(1.0))
        width = F.when(spread > 0, spread * FENCE)
        out.append((q3 + width).alias(f"hi_{k}"))
        out.append(F.when(F.lit(side == "both"), q1 - width).alias(f"lo_{k}"))
    return j.select("g_lang", "g_source", *out)


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", columns: Sequence[str] | None = None) -> DataFrame:
    """``row`` (the columns of docs, all or those named), the counts, ``base_failed`` and ``kept``."""
    scratch = common.Scratch(docs.sparkSession, "quality")
    given = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(F.col(f"`{lang}`").cast("string").alias("l"), F.col(f"`{source}`").cast("string").alias("s")).alias(group := common.free(docs, "group_of")[0]))
    d = features(given, text, [*(docs.columns if columns is None else columns), group])
    d = d.select(F.struct(*[F.col(f"row.`{c}`") for c in (docs.columns if columns is None else columns)]).alias("row"), F.col(f"row.`{group}`.l").alias("g_lang"), F.col(f"row.`{group}`.s").alias("g_source"), *[c for c in d.columns if c != "row"])
    counted = scratch.save(d.select("*", *[c.alias(k) for k, c in rates({c: F.col(c) for c in d.columns}).items()]), "counted")
    fences = scratch.save(thresholds(counted), "fences").select(F.col("g_lang").alias("f_lang"), F.col("g_source").alias("f_source"), *[f"{side}_{k}" for k in RATES for side in ("lo", "hi")])
    fences = F.broadcast(fences) if fences.limit(FEW + 1).count() <= FEW else fences
    j = counted.join(fences, F.col("g_lang").eqNullSafe(F.col("f_lang")) & F.col("g_source").eqNullSafe(F.col("f_source")), "left")
    ok = F.lit(True)
    for k in RATES:
        ok = ok & F.coalesce(F.col(k) <= F.col(f"hi_{k}"), F.lit(True)) & F.coalesce(F.col(k) >= F.col(f"lo_{k}"), F.lit(True))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return j.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ok).alias("kept"))


def filter_quality(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of docs that are kept, with docs' own columns."""
    return judge(docs, text, lang, source).filter("kept").select("row.*")
