"""Contracts of the engine's operators on small fixtures."""

import json
import logging
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone import logs
from marlstone.errors import GateError, StorageError
from marlstone.functions import geometry, signature, text
from marlstone.operators import doctag, layout, neardup, numbering, outcome, split
from marlstone.options import Options
from marlstone.plans import catalogue, dataset, ingest
from marlstone.schemas import HASH_INDEX, MANIFEST, OUTCOME
from marlstone.sources import files, sinks
from marlstone.sources.scratch import written
from marlstone.streaming import watcher

LOC = "<loc_50><loc_50><loc_250><loc_250>"


def scan(rows, index=()):
    """The sequential choice."""
    seen, out = list(index), []
    for key, sig in rows:
        if sig is not None and any(bin((sig ^ s) & (2**64 - 1)).count("1") < 8 for s in seen):
            continue
        if sig is not None:
            seen.append(sig)
        out.append(key)
    return sorted(out)


def kept(spark, rows, index=None, parts=4):
    df = spark.createDataFrame(rows, "key long, sig long").repartition(parts)
    idx = None if index is None else spark.createDataFrame([(s,) for s in index], "sig long")
    return sorted(r["key"] for r in neardup.greedy(df, "key", idx).collect())


@pytest.mark.parametrize("rows", [
    [(1, 0), (2, 0x7F), (3, 0x3FFF)],  # a chain: the middle goes, its other neighbour stays
    [(1, 0x7F), (2, 0), (3, 0x3FFF)],
    [(1, 0), (2, 0x7F), (3, 0xFF00)],
    [(1, None), (2, None), (3, 5)],
    [(1, -(2**63)), (2, 0)],
])
def test_greedy_fixtures(spark, rows):
    assert kept(spark, rows) == scan(rows)


def test_greedy_random(spark):
    r = random.Random(1)
    rows = []
    for i in range(120):
        sig = r.getrandbits(64) if not rows or r.random() < 0.3 else r.choice(rows)[1] & (2**64 - 1)
        for _ in range(r.randint(0, 5)):
            sig ^= 1 << r.randrange(64)
        rows.append((i, sig - 2**64 if sig >= 2**63 else sig))
    assert kept(spark, rows, parts=1) == kept(spark, rows, parts=7) == scan(rows)
    assert kept(spark, rows[20:], [s for _, s in rows[:20]]) == scan(rows[20:], [s for _, s in rows[:20]])


def markup(spark, html, w=1000, h=800):
    return doctag.convert(spark.createDataFrame([(html, w, h)], "html string, img_w int, img_h int")).first()


def div(label, body, box="100 80 500 400"):
    return f'<div data-bbox="{box}" data-label="{label}">{body}</div>'


@pytest.mark.parametrize("html, lines", [
    (div("Text", ""), [f"<text>{LOC}</text>"]),
    (div("Section-Header", "<b>a</b>b"), [f"<section_header_level_1>{LOC}a b</section_header_level_1>"]),
    (div("Table", "<table><tr><td>1</table>"), [f"<table>{LOC}<table><tr><td>1</td></tr></table></table>"]),
    (div("Table", "x"), [f"<table>{LOC}x</table>"]),
    (div("Image", "x"), []),
    (div("Image", '<img alt=" a ">'), [f"<picture>{LOC}a</picture>"]),
    (div("Image", "<img>"), [f"<picture>{LOC}</picture>"]),
    (div("List-Group", "<ol><li>1. - x</li><li>- 1. x</li></ol>"), ["<unordered_list>", f"<list_item>{LOC}x</list_item>", f"<list_item>{LOC}1. x</list_item>", "</unordered_list>"]),
    (div("List-Group", "x"), [f"<text>{LOC}x</text>"]),
    (div("text", "a &lt; b"), [f"<text>{LOC}a < b</text>"]),
    (div("", ""), []),
    (div("Text", "x", " "), []),
    (div("Text", "x", "-5 0 99999 800"), ["<text><loc_0><loc_0><loc_499><loc_499>x</text>"]),
    (div("Text", "p" + div("Caption", "c")), [f"<text>{LOC}p c</text>", f"<caption>{LOC}c</caption>"]),
    ("", []),
])
def test_markup(spark, html, lines):
    assert markup(spark, html)["doctags"] == "<doctag>\n" + "\n".join(lines) + "\n</doctag>"


def test_page_without_regions_needs_no_size(spark):
    assert tuple(markup(spark, "<p>x</p>", 0, 0)[c] for c in ("doctags", "error")) == ("<doctag>\n\n</doctag>", None)
    assert tuple(markup(spark, "<p>x</p>", 5, 0)[c] for c in ("doctags", "error")) == ("<doctag>\n\n</doctag>", None)
    assert markup(spark, div("Text", "x"), 5, 0)["error"]


def test_wide_box_is_clamped(spark):
    got = markup(spark, div("Text", "x", "-99999999999 0 99999999999999999999 3000000000"))
    assert got["doctags"] == "<doctag>\n<text><loc_0><loc_0><loc_499><loc_499>x</text>\n</doctag>" and got["error"] is None


def test_bands_find_every_near_pair_and_few_others(spark):
    r = random.Random(4)
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    sigs = [r.getrandbits(64) for _ in range(3000)]
    for s in sigs[:300]:
        for n in (1, 5, 7, 8):
            sigs.append(s ^ sum(1 << i for i in r.sample(range(64), n)))
    d = spark.createDataFrame([(signed(s),) for s in set(sigs)], "sig long")
    got = {(x["l_sig"], x["r_sig"]) for x in neardup.near_pairs(d, d).collect()}
    all_ = np.array(sorted(set(sigs)), np.uint64)
    want = {(signed(int(a)), signed(int(b))) for a in all_ for b in all_[np.bitwise_count(all_ ^ a) < 8]}
    assert got == want
    met = neardup.bands(d, probes=True).alias("a").join(neardup.bands(d).alias("b"), ["band", "value"]).count()
    assert met < len(set(sigs)) ** 2 / 300


def plan(df):
    """The plan that ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_bands_are_not_broadcast(spark):
    u = spark.range(3000).select(F.xxhash64("id").alias("sig")).distinct()
    ran = plan(neardup.near_pairs(u, u))
    assert "SortMergeJoin" in ran and "BroadcastHashJoin" not in ran


@pytest.mark.parametrize("name", ["neardup_greedy", "dedup_split_counts", "dedup_cardinality"])
def test_queries_do_not_broadcast_bands(spark, monkeypatch, name):
    ran = {}

    def spied(df, name):
        ran.setdefault(name, plan(df))
        return written(df, name)

    monkeypatch.setattr(neardup, "written", spied)
    catalogue.queries()[name](spark, "/root/testdata/sf0.001")
    assert "SortMergeJoin [band" in ran["greedy-edges"] and "BroadcastHashJoin [band" not in ran["greedy-edges"]


@pytest.mark.parametrize("name", ["neardup_greedy", "dedup_split_counts", "dedup_cardinality"])
def test_queries_broadcast_no_table_that_grows(spark, monkeypatch, name):
    ran = []

    def spied(df, name):
        ran.append(plan(df))
        return written(df, name)

    monkeypatch.setattr(neardup, "written", spied)
    ran.append(plan(catalogue.queries()[name](spark, "/root/testdata/sf0.001")))
    # the only ones are of a row for each partition (numbered) and of a row each (reduction)
    assert len(ran) > 4 and not [p for p in ran if "BroadcastHashJoin" in p.replace("BroadcastHashJoin [_part", "")]


@pytest.mark.parametrize("name", ["dedup_split_counts", "dedup_cardinality"])
def test_queries_use_the_choice_without_its_joins(spark, monkeypatch, name):
    ran = []

    def spied(df, name):
        ran.append(plan(df))
        return written(df, name)

    monkeypatch.setattr(numbering, "written", spied)
    ran.append(plan(catalogue.queries()[name](spark, "/root/testdata/sf0.001")))
    assert not [p for p in ran if "Join" in p.replace("BroadcastHashJoin [_part", "")]


def test_reduction_counts_empty_tables(spark):
    some, none = spark.range(3), spark.range(0)
    for before, after, want in ((some, some, (3, 3)), (some, none, (3, 0)), (none, none, (0, 0))):
        assert outcome.reduction(before, after).collect() == [want]


def test_greedy_needs_unique_order(spark):
    with pytest.raises(ValueError, match="not unique"):
        neardup.greedy(spark.createDataFrame([(1, 5), (1, 6)], "key long, sig long"), "key")


@pytest.mark.parametrize("box", ["1 2 3", "1 2 3 12.5"])
def test_bad_box_fails_the_page_alone(spark, box):
    assert markup(spark, div("Text", "x", box))["error"]


def test_half_even(spark):
    d = spark.createDataFrame([(v,) for v in (1, 3, 5)], "v int").select(geometry.on_grid(F.col("v"), F.lit(1000)).alias("g"))
    assert [r["g"] for r in d.collect()] == [0, 2, 2]


def test_hex_round_trip(spark):
    d = spark.createDataFrame([("c4ca4238a0b92382",), ("0000000000000000",)], "h string")
    assert [r[0] for r in d.select(signature.to_hex(signature.from_hex(F.col("h")))).collect()] == ["c4ca4238a0b92382", "0" * 16]


def test_split(spark):
    assert split.sizes(6) == (4, 1, 1) and split.sizes(10) == (8, 1, 1) and split.sizes(11) == (8, 1, 2) and split.sizes(1000) == (800, 100, 100)
    with pytest.raises(ValueError):
        split.sizes(5)
    got = [{r["id"]: r["split"] for r in split.assign(spark.range(40).repartition(p), "id").collect()} for p in (1, 4, 13)]
    assert got[0] == got[1] == got[2]


@pytest.mark.parametrize("n, most", [(0, 0), (1, 1), (100, 1), (101, 2), (250, 3)])
def test_batches(spark, n, most):
    d = numbering.batches(spark.range(n), ["id"], 100)
    assert d.select("batch").distinct().count() == most


def test_options():
    with pytest.raises(ValueError):
        Options(batch_size=0)


def test_single_file_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.one_file(spark, str(tmp_path / "not-there.pdf"))
    (tmp_path / "notes.docx").write_text("words")
    with pytest.raises(ValueError, match="Unsupported file type"):
        files.one_file(spark, str(tmp_path / "notes.docx"))


def test_manifest_shapes(spark, tmp_path):
    d = spark.createDataFrame([('{\n "image_path": "a",\n "img_w": 1\n}',), ('{"image_path": "b"}\n\n{"image_path": "c"}\n',)], "value string")
    assert sorted(r["image_path"] for r in files.from_manifest_text(d).collect()) == ["a", "b", "c"]
    with pytest.raises(Exception):
        files.from_manifest_text(spark.createDataFrame([("{bad\n{worse",)], "value string")).collect()
    assert files.manifests(spark, str(tmp_path)).count() == 0
    for bad in ('{"image_path": "a"} tail', '[1]', '{"image_path": "a"}{"image_path": "b"}'):
        with pytest.raises(Exception, match="not one JSON object"):
            files.from_lines(spark.createDataFrame([(bad,)], "value string")).collect()


def test_manifests_read_what_is_written(spark, tmp_path, monkeypatch):
    d = spark.createDataFrame([(f"images/{i}.png", f"text {i}\nwith lines", None, "s", 1, 2) for i in range(20)], MANIFEST)
    sinks.write_manifests(d, str(tmp_path))
    sinks.write_manifests(d.limit(0), str(tmp_path))
    (tmp_path / "manifests" / "one.jsonl").write_text('{\n "image_path": "p",\n "img_w": 3\n}')
    (tmp_path / "manifests" / "other.json").write_text("{}")
    for whole in (files.WHOLE_BYTES, 60):  # with 60, files of lines are read line by line
        monkeypatch.setattr(files, "WHOLE_BYTES", whole)
        got = {tuple(r) for r in files.manifests(spark, str(tmp_path)).collect()}
        assert got == {tuple(r) for r in d.collect()} | {("p", None, None, None, 3, None)}


def png(path, rows):
    """A grey image."""
    import struct
    import zlib

    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    h, w = rows.shape
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">2I5B", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(b"\0" + r.tobytes() for r in rows))) + chunk(b"IEND", b""))


def test_images_to_a_split_dataset(spark, tmp_path):
    """Manifests and images in a folder: hashed, deduplicated, split."""
    pictures = tmp_path / "images"
    pictures.mkdir()
    r = np.random.RandomState(1)
    for i in range(12):
        base = np.kron(r.randint(0, 250, (8, 8)), np.ones((6, 6))).astype(np.uint8)
        png(pictures / f"{i}.png", base)
        if i < 3:
            png(pictures / f"{i}-copy.png", base)
    (pictures / "broken.png").write_bytes(b"no image")
    found = files.scan(spark, str(pictures)).select("path")
    names = found.select(F.concat(F.lit("images/"), text.basename(F.col("path"))).alias("image_path"))
    samples = names.select("image_path", F.lit("t").alias("output_text"), F.lit(None).cast("string").alias("chandra_raw"), F.lit("s").alias("source"), F.lit(1).alias("img_w"), F.lit(1).alias("img_h"))
    sinks.write_manifests(samples, str(tmp_path))
    hashed = signature.phash(files.images(spark, str(pictures)))
    assert hashed.filter("sig is null").count() == 1
    sigs = hashed.select(F.concat(F.lit("images/"), text.basename(F.col("origin"))).alias("image_path"), "sig")
    kept = dataset.build_from(spark, str(tmp_path), sigs)
    assert kept.count() == 13  # twelve pictures, and the one without a signature
    assert {x["split"]: x["n"] for x in dataset.split_and_publish(kept, str(tmp_path / "out")).collect()} == {"train": 10, "val": 1, "test": 2}


def test_folders(spark, tmp_path):
    files.ensure_warehouse(spark, str(tmp_path / "w"))
    files.ensure_warehouse(spark, str(tmp_path / "w"))
    (tmp_path / "x" / "a").mkdir(parents=True)
    (tmp_path / "x" / "a" / "f.bin").write_bytes(b"123")
    with pytest.raises(StorageError):
        files.ensure_warehouse(spark, str(tmp_path / "x"))
    assert [r["length"] for r in files.blobs(spark, str(tmp_path / "x"), "a/").collect()] == [3] and files.blobs(spark, str(tmp_path / "x"), "b").count() == 0
    assert files.hash_index(spark, str(tmp_path / "none"), HASH_INDEX).count() == 0
    (tmp_path / "c.json").write_text('{"count": 42}')
    assert files.json_object(spark, str(tmp_path / "c.json")).first()["count"] == 42
    with pytest.raises(StorageError):
        files.json_object(spark, str(tmp_path / "missing.json"))


def test_log_lines(capsys):
    logs.configure()
    try:
        1 / 0
    except ZeroDivisionError:
        logging.getLogger("marlstone.x").exception("gone %d", 3)
    row = json.loads(capsys.readouterr().out)
    assert (row["level"], row["module"], row["message"]) == ("ERROR", "marlstone.x", "gone 3") and "ZeroDivisionError" in row["exc"] and row["ts"]
    assert str(GateError("size", "too small")) == "[size] too small"
    logging.getLogger("marlstone").handlers.clear()


def _hashes(pages):
    return pages.withColumn("sig", F.xxhash64("content")).withColumn("img_w", F.lit(1000)).withColumn("img_h", F.lit(800))


def _two_pages(content, dpi):
    yield content + b"0"
    yield content + b"1"


def _good():
    return lambda content: "<div data-bbox='1 1 2 2' data-label='Text'>hello</div>"


def _half():
    def call(content):
        if content.endswith(b"1"):
            raise RuntimeError("no answer")
        return "<div></div>"

    return call


def test_ingest(spark, tmp_path):
    (tmp_path / "scan.png").write_bytes(b"picture one")
    (tmp_path / "doc.pdf").write_bytes(b"two pages")
    root = str(tmp_path / "out")
    go = lambda name, make, b: ingest.ingest_file(spark, str(tmp_path / name), root, make, _hashes, render=_two_pages, batch_id=b)
    assert go("scan.png", _good, 0) == 1
    assert go("doc.pdf", _half, 1) == 1
    assert go("doc.pdf", _good, 2) == 1  # the page that failed was not registered
    assert go("scan.png", _good, 3) == 0
    assert sinks.read_batches(spark, f"{root}/index", HASH_INDEX).count() == 3
    assert go("scan.png", _good, 0) == 1  # run again: it does not see itself
    (tmp_path / "bad.pdf").write_bytes(b"broken")
    with pytest.raises(StorageError, match="no pages"):
        ingest.ingest_file(spark, str(tmp_path / "bad.pdf"), root, _good, _hashes, render=_broken, batch_id=4)


def test_ingest_numbers_files(spark, tmp_path):
    """Files that are ingested without a number add to each other; streams and single files don't share a folder."""
    src, root = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for i in range(2):
        (src / f"{i}.png").write_bytes(b"picture %d" % i)
        assert ingest.ingest_file(spark, str(src / f"{i}.png"), root, _good, _hashes) == 1
    assert ingest.ingest_file(spark, str(src / "1.png"), root, _good, _hashes) == 0
    assert sorted(r["batch_id"] for r in spark.read.parquet(f"{root}/samples").collect()) == [0, 1]
    assert ingest.next_batch(spark, root) == 3
    with pytest.raises(GateError, match="single files"):
        watcher.watch(spark, str(src), root, _good, _hashes, available_now=True)
    (tmp_path / "stream" / "checkpoint").mkdir(parents=True)
    with pytest.raises(GateError, match="stream"):
        ingest.ingest_file(spark, str(src / "0.png"), str(tmp_path / "stream"), _good, _hashes)


def test_stream_archives_files(spark, tmp_path):
    """Files move one trigger later; a name that is taken is kept beside it; the ones that failed go apart."""
    src, root, to = tmp_path / "in", str(tmp_path / "out"), tmp_path / "old"
    src.mkdir()
    options = Options(prefetch=10)
    go = lambda: watcher.drain(watcher.watch(spark, str(src), root, _good, _hashes, options, _broken, available_now=True, archive_to=str(to)))
    names = lambda d: sorted(p.name for p in d.iterdir() if not p.name.startswith(".")) if d.exists() else []
    (to / "done").mkdir(parents=True)
    (to / "done" / "a.png").write_bytes(b"from before")
    (src / "a.png").write_bytes(b"picture a")
    (src / "bad.pdf").write_bytes(b"broken")
    go()
    assert names(src) == ["a.png", "bad.pdf"]
    (src / "b.png").write_bytes(b"picture b")
    go()
    assert names(src) == ["b.png"] and names(to / "failed") == ["bad.pdf"]
    assert len(names(to / "done")) == 2 and (to / "done" / "a.png").read_bytes() == b"from before"
    assert watcher.archive(spark, root, str(to), 0) == 0  # a second time moves nothing
    assert watcher.archive(spark, root, str(to), 1) == 1 and names(src) == [] and "b.png" in names(to / "done")


def _broken(content, dpi):
    if content == b"broken":
        raise ValueError("no pages in it")
    yield from _two_pages(content, dpi)


def test_stream_ingests_files(spark, tmp_path):
    """One trigger against many, a file that can't be rendered, and a stream that dies and starts again."""
    src = tmp_path / "in"
    src.mkdir()
    for i in range(4):
        (src / f"{i}.png").write_bytes(b"picture %d" % (i % 3))  # the last is a copy
    (src / "doc.pdf").write_bytes(b"two pages")
    (src / "bad.pdf").write_bytes(b"broken")
    (src / "notes.txt").write_text("not an input")
    seen = []
    for name, per in (("one", 100), ("many", 1), ("dies", 2)):
        root = str(tmp_path / name)
        options = Options(prefetch=per, commit_every=2)
        calls = []

        def hashes(pages):
            calls.append(1)
            if name == "dies" and len(calls) == 2:
                raise RuntimeError("killed")
            return _hashes(pages)

        go = lambda: watcher.drain(watcher.watch(spark, str(src), root, _good, hashes, options, _broken, available_now=True))  # noqa: B023, E731
        if name == "dies":
            with pytest.raises(Exception):
                go()
        go()
        statuses = {r["status"]: r["n"] for r in outcome.by_status(sinks.read_batches(spark, f"{root}/outcomes", OUTCOME), "status").collect()}
        failed = [r["error"] for r in spark.read.parquet(f"{root}/failed").collect()]
        states = {r["state"] for r in watcher.progress(spark, root).collect()}
        sinks.publish(spark, f"{root}/samples", f"{root}/published", 1)
        assert sinks.publish(spark, f"{root}/samples", f"{root}/published", 1) == 0  # nothing twice
        published = spark.read.parquet(f"{root}/published").select("image_path")
        seen.append((statuses, failed, states, published.count(), published.distinct().count()))
    assert seen == [({"saved": 5, "duplicate": 1, "failed": 1}, ["no pages in it"], {"done"}, 5, 5)] * 3


def test_dataset(spark, tmp_path):
    empty = spark.createDataFrame([], MANIFEST)
    sigs = spark.createDataFrame([("a.png", 0), ("b.png", -1)], "image_path string, sig long")
    with pytest.raises(RuntimeError, match="No manifest files"):
        dataset.build(empty, sigs)
    two = spark.createDataFrame([("a.png", "hello"), ("b.png", "world")], "image_path string, output_text string")
    assert dataset.build(two, sigs).count() == 2
    with pytest.raises(RuntimeError, match="No unique samples"):
        dataset.build(two.limit(1), sigs, spark.createDataFrame([("z", 0), ("y", -1)], "key string, sig long"))
    many = spark.range(20).select(F.col("id").cast("string").alias("image_path"))
    assert {r["split"]: r["n"] for r in dataset.split_and_publish(many, str(tmp_path / "d")).collect()} == {"train": 16, "val": 2, "test": 2}


def test_stream_batches(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(7):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(str(src))
    seen = []
    for name, per in (("one", 100), ("many", 1)):
        root = str(tmp_path / name)
        out = lambda rows, t: sinks.write_batch(rows, f"{root}/out", t)  # noqa: B023, E731
        fire = watcher.tumbling(root, ["id"], 20, out)
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", per).parquet(str(src))
        for _ in range(2):  # a second start finds nothing new
            watcher.start(stream, fire, f"{root}/checkpoint", available_now=True).awaitTermination()
        got = spark.read.parquet(f"{root}/out")
        seen.append((got.count(), got.groupBy("batch").count().filter("count = 20").count()))
        for _ in range(2):
            watcher.fire_rest(spark, root, out)
        got = spark.read.parquet(f"{root}/out")
        seen.append((got.count(), got.groupBy("batch").count().count()))
    assert seen == [(60, 3), (70, 4)] * 2


def test_phash_tells_images_apart():
    a = np.kron(np.random.RandomState(0).randint(0, 250, (8, 6, 3)), np.ones((8, 8, 1))).astype(np.uint8)
    near = np.clip(a.astype(int) + 2, 0, 255).astype(np.uint8)
    bits = lambda p, q: bin((signature.phash_pixels(p) ^ signature.phash_pixels(q)) & (2**64 - 1)).count("1")
    assert bits(a, near) < 8
    assert bits(a, a[::-1, ::-1]) >= 8


def test_text_functions(spark):
    d = spark.createDataFrame([("/a/b/Scan.PDF",)], "p string")
    r = d.select(text.suffix(F.col("p")), text.stem(F.col("p")), text.renamed(F.col("p"), F.lit(5)), text.trim_u(F.lit("　 a\n"))).first()
    assert tuple(r) == (".pdf", "Scan", "Scan_5.PDF", "a")
    assert layout.regions("<div data-bbox data-label></div>")[0]["bbox"] == ""
