"""Registered queries of the document-sample engine, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, signature, text
from ..operators import doctag, neardup, numbering, outcome, split
from ..operators.layout import exploded, with_regions
from ..sources import files, sinks
from ..sources.scratch import work_dir, written
from ..streaming import watcher

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SIMHASH_SQL = """
words AS (SELECT doc_id, unnest(list_distinct(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\x0b\\x0c]+'), lambda w: w <> ''))) AS w FROM documents),
hashes AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 16))::UBIGINT AS h FROM words),
bits AS (SELECT doc_id, b, sum(CASE WHEN (h >> b) & 1 = 1 THEN 1 ELSE -1 END) AS s FROM hashes, (SELECT unnest(range(64))::UBIGINT AS b) GROUP BY doc_id, b),
sigs AS (SELECT doc_id, bit_or(CASE WHEN s > 0 THEN 1::UBIGINT << b ELSE 0::UBIGINT END) AS sig FROM bits GROUP BY doc_id)
"""
GREEDY_SQL = f"""
WITH RECURSIVE {SIMHASH_SQL.strip()},
ranked AS (SELECT row_number() OVER (ORDER BY doc_id) AS rn, doc_id, sig FROM sigs),
scan AS (
  SELECT 0::BIGINT AS rn, NULL::BIGINT AS doc_id, false AS keep, []::UBIGINT[] AS kept
  UNION ALL
  SELECT r.rn, r.doc_id, len(list_filter(s.kept, lambda k: bit_count(xor(k, r.sig)) < 8)) = 0,
         CASE WHEN len(list_filter(s.kept, lambda k: bit_count(xor(k, r.sig)) < 8)) = 0 THEN list_append(s.kept, r.sig) ELSE s.kept END
  FROM scan s JOIN ranked r ON r.rn = s.rn + 1),
chosen AS (SELECT doc_id FROM scan WHERE keep UNION ALL SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM sigs))
"""


def _signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature.simhash(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ scans, filters, projections


@query("""SELECT page_id, lower(regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '[^./](\\.[^./]+)$', 1)) AS ext
          FROM pages WHERE lower(regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '[^./](\\.[^./]+)$', 1)) IN ('.html', '.pdf', '.png')""")
def scan_filter_suffix(spark, sf_dir):
    d = table(spark, sf_dir, "pages").select("page_id", F.split_part(F.split_part("url", F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1)).alias("path"))
    return d.select("page_id", text.suffix(F.col("path")).alias("ext")).filter(F.col("ext").isin(".html", ".pdf", ".png"))


@query("""SELECT doc_id, path FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN 'manifests/' ELSE 'images/' END || doc_id || CASE WHEN n_chars >= 1000 THEN '.jsonl' ELSE '.png' END AS path FROM documents)
          WHERE starts_with(path, 'manifests/') AND ends_with(path, '.jsonl')""")
def manifest_path_filter(spark, sf_dir):
    path = F.concat(F.when(F.col("lang") == "en", "manifests/").otherwise("images/"), F.col("doc_id").cast("string"), F.when(F.col("n_chars") >= 1000, ".jsonl").otherwise(".png"))
    return table(spark, sf_dir, "documents").select("doc_id", path.alias("path")).filter(text.is_manifest(F.col("path")))


@query("""SELECT md5(source || '|' || doc_id) AS sample_id, 'images/' || md5(source || '|' || doc_id) || '.png' AS image_path, 'manifests/' || md5(source || '|' || doc_id) || '.jsonl' AS manifest_path,
          'chandra_raw/' || md5(source || '|' || doc_id) || '.html' AS chandra_raw, 'colab-ingest' AS source, printf('page_%04d_%s.png', doc_id, substr(md5(source), 1, 6)) AS page FROM documents""")
def manifest_projection(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("sample_id", text.sample_id(F.col("source"), F.col("doc_id")))
    i = F.col("sample_id")
    return d.select("sample_id", text.image_path(i).alias("image_path"), text.manifest_path(i).alias("manifest_path"), text.raw_path(i).alias("chandra_raw"), F.lit("colab-ingest").alias("source"), text.page_name(F.col("doc_id"), F.substring(F.md5("source"), 1, 6)).alias("page"))


@query("""SELECT page_id, split_part(url, '/', -1) AS name, regexp_replace(url, '/+$', '') || '/v1' AS base FROM pages""")
def path_functions(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.basename(F.col("url")).alias("name"), text.api_base(F.col("url")).alias("base"))


@query("""SELECT o_orderkey, coalesce(nullif(o_orderkey % 4, 0), 9) AS value, '[' || o_orderstatus || '] ' || o_orderpriority AS message FROM orders""")
def falsy_default(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", text.falsy(F.col("o_orderkey") % 4, F.lit(9).cast("long")).alias("value"), text.gate_message(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("message"))


# ------------------------------------------------------------------ counts, thresholds, progress


@query("SELECT count(*) AS n FROM documents")
def stored_count(spark, sf_dir):
    return outcome.stored(table(spark, sf_dir, "documents"))


@query("SELECT count(*) AS n, count(*) >= 5000 AS ready FROM documents")
def ready_flag(spark, sf_dir):
    return outcome.ready(table(spark, sf_dir, "documents"), 5000)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def status_counts(spark, sf_dir):
    return outcome.by_status(table(spark, sf_dir, "events"), "event_type")


@query("SELECT count(*) FILTER (WHERE event_type = (SELECT min(event_type) FROM events)) AS saved FROM events")
def saved_count(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    least = e.agg(F.min("event_type").alias("least"))  # one row
    return outcome.saved(e.crossJoin(F.broadcast(least)).select(F.when(F.col("event_type") == F.col("least"), "saved").otherwise("failed").alias("status")))


@query("""WITH t AS (SELECT source AS source_file, count(*) AS total FROM documents GROUP BY source), d AS (SELECT source, count(*) AS n FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY source)
          SELECT source_file, total, total - coalesce(n, 0) AS remaining, CASE WHEN total - coalesce(n, 0) <= 0 THEN 'done' ELSE 'queued' END AS state FROM t LEFT JOIN d ON source = source_file""")
def source_progress(spark, sf_dir):
    """Documents of each source, and how many have no label yet."""
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("source_file"), "doc_id")
    return outcome.progress(d.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi"), d.groupBy("source_file").agg(F.count(F.lit(1)).alias("total")))


@query("""SELECT event_type, count(*) FILTER (WHERE value <= 1.0) AS le_1_0, count(*) FILTER (WHERE value <= 10.0) AS le_10_0, count(*) FILTER (WHERE value <= 100.0) AS le_100_0,
          round(sum(value), 3) AS total, count(value) AS n FROM events GROUP BY event_type""")
def latency_histogram(spark, sf_dir):
    return outcome.histogram(table(spark, sf_dir, "events"), "value", (1.0, 10.0, 100.0), "event_type").withColumn("total", F.round("total", 3))


@query("SELECT event_type, arg_max(value, (ts, event_id)) AS last FROM events GROUP BY event_type")
def gauge_last(spark, sf_dir):
    return outcome.gauge(table(spark, sf_dir, "events"), "value", F.struct("ts", "event_id"), "event_type")


# ------------------------------------------------------------------ order, batches, split


@query("SELECT o_orderkey, idx, (idx - 1) // 100 AS batch, total FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS idx, count(*) OVER () AS total FROM orders)")
def chunk_batches(spark, sf_dir):
    return numbering.batches(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 100).select("o_orderkey", "idx", "batch", "total")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def take_batch(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy("o_orderdate", "o_orderkey").limit(100).select("o_orderkey", "o_totalprice")


SPLIT_SQL = """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS k, count(*) OVER () AS n FROM documents),
s AS (SELECT doc_id, CASE WHEN k <= n - ceil(0.2::DOUBLE * n) THEN 'train' WHEN k <= n - ceil(0.5::DOUBLE * ceil(0.2::DOUBLE * n)) THEN 'val' ELSE 'test' END AS split FROM r) """


@query(SPLIT_SQL + "SELECT * FROM s")
def split_assign(spark, sf_dir):
    return split.assign(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query(SPLIT_SQL + "SELECT split, count(*) AS n FROM s GROUP BY split")
def split_sizes(spark, sf_dir):
    return outcome.by_status(split.assign(table(spark, sf_dir, "documents").select("doc_id"), "doc_id"), "split")


# ------------------------------------------------------------------ joins and set operations


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def known_files_antijoin(spark, sf_dir):
    known = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return files.new_files(table(spark, sf_dir, "customer").select("c_custkey"), known, "c_custkey")


@query("SELECT DISTINCT k FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier)")
def queue_union(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).unionByName(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))).distinct()


@query("SELECT l.doc_id, l.quality, d.source FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id")
def lineage_join(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("d_id"), "source")
    return table(spark, sf_dir, "labels").join(d, F.col("doc_id") == F.col("d_id"), "left").select("doc_id", "quality", "source")


# ------------------------------------------------------------------ signatures and near duplicates


@query("""SELECT vec_id, printf('%016x', bits) AS sig_hex FROM (SELECT vec_id, list_sum([CASE WHEN embedding[i + 1]::DOUBLE > list_aggregate([x::DOUBLE for x in embedding], 'median') THEN (1::UBIGINT << (63 - i)::UBIGINT)::HUGEINT ELSE 0 END for i in range(64)])::UBIGINT AS bits FROM embeddings)""")
def signature_bits(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", signature.to_hex(signature.median_bits(F.col("embedding"))).alias("sig_hex"))


@query(f"WITH {SIMHASH_SQL.strip()} SELECT doc_id, printf('%016x', sig) AS sig_hex FROM sigs")
def text_signatures(spark, sf_dir):
    return _signatures(spark, sf_dir).filter("sig is not null").select("doc_id", signature.to_hex(signature.from_hex(signature.to_hex(F.col("sig")))).alias("sig_hex"))


@query(f"WITH {SIMHASH_SQL.strip()}, u AS (SELECT DISTINCT sig FROM sigs) SELECT printf('%016x', a.sig) AS a_sig, printf('%016x', b.sig) AS b_sig, bit_count(xor(a.sig, b.sig))::INT AS distance FROM u a, u b WHERE a.sig <> b.sig AND bit_count(xor(a.sig, b.sig)) < 8")
def hamming_pairs(spark, sf_dir):
    u = _signatures(spark, sf_dir).filter("sig is not null").select("sig").distinct()
    return neardup.near_pairs(u, u).filter("l_sig <> r_sig").select(signature.to_hex(F.col("l_sig")).alias("a_sig"), signature.to_hex(F.col("r_sig")).alias("b_sig"), F.col("distance").cast("int").alias("distance"))


@query(f"WITH {SIMHASH_SQL.strip()} SELECT doc_id FROM documents p WHERE source <> 'src1' AND NOT EXISTS (SELECT 1 FROM sigs a JOIN sigs b ON bit_count(xor(a.sig, b.sig)) < 8 JOIN documents i ON i.doc_id = b.doc_id WHERE a.doc_id = p.doc_id AND i.source = 'src1')")
def neardup_index_antijoin(spark, sf_dir):
    """All other sources' documents against an index of one source."""
    d = table(spark, sf_dir, "documents")
    return neardup.unseen(signature.simhash(d.filter("source <> 'src1'")), signature.simhash(d.filter("source = 'src1'"))).select("doc_id")


@query(GREEDY_SQL + "SELECT doc_id FROM chosen")
def neardup_greedy(spark, sf_dir):
    return neardup.greedy(_signatures(spark, sf_dir), "doc_id").select("doc_id")


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The choice, written: what uses it is planned and run without the choice's own joins."""
    return written(neardup_greedy(spark, sf_dir), "kept")


@query(GREEDY_SQL + """, r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS k, count(*) OVER () AS n FROM chosen)
SELECT CASE WHEN k <= n - ceil(0.2::DOUBLE * n) THEN 'train' WHEN k <= n - ceil(0.5::DOUBLE * ceil(0.2::DOUBLE * n)) THEN 'val' ELSE 'test' END AS split, count(*) AS n FROM r GROUP BY 1""")
def dedup_split_counts(spark, sf_dir):
    return outcome.by_status(split.assign(_kept(spark, sf_dir), "doc_id"), "split")


@query(GREEDY_SQL + "SELECT (SELECT count(*) FROM documents) AS n_in, (SELECT count(*) FROM chosen) AS n_out")
def dedup_cardinality(spark, sf_dir):
    return outcome.reduction(table(spark, sf_dir, "documents"), _kept(spark, sf_dir))


# ------------------------------------------------------------------ layout to markup


@query("""SELECT l_orderkey, l_linenumber, '<loc_' || greatest(0, least(499, round_even(l_partkey::DOUBLE / 1000 * 500, 0)))::INT || '><loc_' || greatest(0, least(499, round_even(l_suppkey::DOUBLE / 800 * 500, 0)))::INT
          || '><loc_' || greatest(0, least(499, round_even((l_partkey + 7)::DOUBLE / 1000 * 500, 0)))::INT || '><loc_' || greatest(0, least(499, round_even((l_suppkey + 9)::DOUBLE / 800 * 500, 0)))::INT || '>' AS loc FROM lineitem""")
def loc_tokens(spark, sf_dir):
    box = F.concat_ws(" ", F.col("l_partkey"), F.col("l_suppkey"), F.col("l_partkey") + 7, F.col("l_suppkey") + 9)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", geometry.loc(geometry.parse_bbox(F.concat(F.lit(" "), box)), F.lit(1000), F.lit(800)).alias("loc"))


def _layout_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layout page for each document, made of its whole text: one region of each kind."""
    line = F.regexp_replace("text", r"[&<>\"]", "")
    box = F.concat_ws(" ", F.col("doc_id") % 900, F.lit(80), F.lit(500), F.lit(400))
    div = lambda label, body: F.concat(F.lit('<div data-bbox="'), box, F.lit(f'" data-label="{label}">'), *body, F.lit("</div>"))
    lit = F.lit
    parts = [div(label, [lit("<p>"), F.col("line"), lit("</p>")]) for label in (*doctag.TAGS, "Sidebar")]
    parts += [div("Table", [lit("<table><tr><td>"), F.col("line"), lit("</td></tr></table>")]), div("Image", [lit('<img src="a.png" alt="'), F.col("source"), lit('">')]), div("List-Group", [lit("<ul><li>1. "), F.col("source"), lit("</li><li>- x</li></ul>")]), lit("<div>no region</div>")]
    d = table(spark, sf_dir, "documents").withColumn("line", text.trim_u(line))
    return d.select("doc_id", F.concat(*parts).alias("html"), F.lit(1000).alias("img_w"), F.lit(800).alias("img_h"))


_LOC_SQL = "'<loc_' || least(499, round_even((doc_id % 900)::DOUBLE / 1000 * 500, 0))::INT || '><loc_50><loc_250><loc_250>'"


@query(f"""WITH b AS (SELECT doc_id, source, {_LOC_SQL} AS loc, regexp_replace(regexp_replace(regexp_replace(text, '[&<>"]', '', 'g'), '^\\s+', ''), '\\s+$', '') AS line FROM documents)
SELECT doc_id, '<doctag>' || chr(10) || '<text>' || loc || line || '</text>' || chr(10) || '<section_header_level_1>' || loc || line || '</section_header_level_1>' || chr(10) || '<page_header>' || loc || line || '</page_header>' || chr(10)
|| '<page_footer>' || loc || line || '</page_footer>' || chr(10) || '<caption>' || loc || line || '</caption>' || chr(10) || CASE WHEN line <> '' THEN '<text>' || loc || line || '</text>' || chr(10) ELSE '' END
|| '<table>' || loc || '<table><tr><td>' || line || '</td></tr></table></table>' || chr(10) || '<picture>' || loc || source || '</picture>' || chr(10)
|| '<unordered_list>' || chr(10) || '<list_item>' || loc || source || '</list_item>' || chr(10) || '<list_item>' || loc || 'x</list_item>' || chr(10) || '</unordered_list>' || chr(10) || '</doctag>' AS doctags FROM b""")
def doctag_regions(spark, sf_dir):
    return doctag.convert(_layout_pages(spark, sf_dir)).select("doc_id", "doctags")


@query("SELECT label, count(*) AS n FROM (SELECT unnest(['Text','Section-Header','Page-Header','Page-Footer','Caption','Sidebar','Table','Image','List-Group']) AS label FROM documents) GROUP BY label")
def region_labels(spark, sf_dir):
    return outcome.by_status(exploded(with_regions(_layout_pages(spark, sf_dir))).select(F.col("region.label").alias("label")), "label")


@query("""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace('  7. • ' || text, '^\\s+', ''), '^[0-9]+\\.\\s*', ''), '^\\s+', ''), '^[●•\\-*]\\s*', ''), '^\\s+', ''), '\\s+$', '') AS item FROM documents""")
def list_markers(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_list_marker(text.trim_u(F.concat(F.lit("  7. • "), F.col("text")))).alias("item"))


@query("SELECT page_id, '<doctag>' || chr(10) || chr(10) || '</doctag>' AS doctags, 0 AS n_regions, NULL::VARCHAR AS error FROM pages WHERE html NOT LIKE '%data-bbox%'")
def raw_pages_markup(spark, sf_dir):
    """The pages as they are: parsed whole; none of them has a region."""
    d = table(spark, sf_dir, "pages").select("page_id", "html", F.lit(0).alias("img_w"), F.lit(0).alias("img_h"))
    return with_regions(doctag.convert(d)).select("page_id", "doctags", F.size("regions").alias("n_regions"), "error")


# ------------------------------------------------------------------ JSON, manifests, streams


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_valid(props) AS ok FROM events")
def log_parse(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.from_json("props", "map<string,string>").isNotNull().alias("ok"))


@query("SELECT 'images/' || doc_id || '.png' AS image_path, text AS output_text, source FROM documents")
def manifest_round_trip(spark, sf_dir):
    """Samples written as JSON lines and read back."""
    root = work_dir(spark, "manifests")
    d = table(spark, sf_dir, "documents")
    sinks.write_manifests(d.select(F.concat(F.lit("images/"), F.col("doc_id").cast("string"), F.lit(".png")).alias("image_path"), F.col("text").alias("output_text"), F.lit(None).cast("string").alias("chandra_raw"), "source", F.lit(1).alias("img_w"), F.lit(1).alias("img_h")), root)
    return files.manifests(spark, root).select("image_path", "output_text", "source")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).format("parquet").option("pathGlobFilter", "events.parquet").load(sf_dir)


@query("SELECT (idx - 1) // 100 AS batch, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS idx FROM events) GROUP BY 1")
def stream_count_batches(spark, sf_dir):
    """The events as a file stream, cut into batches of 100 and committed batch by batch."""
    root = work_dir(spark, "stream")
    fire = lambda rows, trigger: sinks.write_batch(rows, f"{root}/out", trigger)
    watcher.drain(watcher.start(_event_stream(spark, sf_dir), watcher.tumbling(root, ["event_id"], 100, fire), f"{root}/checkpoint", available_now=True), root, fire)
    return spark.read.parquet(f"{root}/out").groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("SELECT user_id, count(*) AS total, 0::BIGINT AS remaining, 'done' AS state FROM events GROUP BY user_id")
def stream_progress(spark, sf_dir):
    """Progress of each source after the stream has been drained."""
    root = work_dir(spark, "stream")
    fire = lambda rows, trigger: sinks.write_batch(rows.select("user_id"), f"{root}/out", trigger)
    watcher.drain(watcher.start(_event_stream(spark, sf_dir), watcher.tumbling(root, ["event_id"], 100, fire), f"{root}/checkpoint", available_now=True), root, fire)
    totals = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("total"))
    return outcome.progress(spark.read.parquet(f"{root}/out"), totals, "user_id")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
