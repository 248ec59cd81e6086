"""The registered queries of the ten operators and of the pipeline, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, common, counting, decontaminate, jaccard, oracles, packing, pii, quality, suffix, tokens, toxicity, urls

def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(_table(spark, sf_dir, "documents"), k=4, percent=85).select("doc_id", "n_shingles", "component_id")


def _read_back(rows: DataFrame, parse: Callable = chat.parse_instruct) -> DataFrame:
    """One row a conversation, from the formatted spans alone: roles and texts are parsed out of them."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean"

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        turns, loss, n, chars, total, rewrites = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, False
        for batch in batches:
            out = []
            cols = (batch.column(c).to_pylist() for c in ("conv_id", "span", "text_start", "text_end", "loss", "rewrites", "last"))
            for conv, span, a, b, is_loss, rewrote, last in zip(*cols):
                for role, text in parse(span):
                    turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    n += 1
                if is_loss:
                    text = chat.unescape(span[a:b])
                    chars += len(text)
                    loss.update(text.encode("utf-8", "surrogatepass"))
                total += len(span)
                rewrites |= rewrote
                if last:
                    out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total, rewrites))
                    turns, loss, n, chars, total, rewrites = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, False
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[x.split()[0] for x in schema.split(", ")])

    return rows.mapInArrow(run, schema)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return _read_back(chat.render_turns(conversations.unionByName(extra)))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokens.public_vocabulary(), capacity=1024, end_id=2)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after its personal data are replaced by their kind's name, from stored trees."""
    vocabulary = tokens.public_vocabulary()
    trees = common.Scratch(spark, "counting").save(counting.build(_table(spark, sf_dir, "documents"), vocabulary), "trees")
    return counting.apply_edits(counting.with_redactions(trees), vocabulary, keep_trees=False)


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [urls.split_rule(r, v) for r, v in oracles.URL_RULES]
    return urls.judge(_table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return judged.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(_table(spark, sf_dir, "documents")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op7 that SQL can express."""
    return op7_quality_rules(spark, sf_dir).drop("kept")


def pii_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op9 that SQL can express."""
    return op9_pii(spark, sf_dir).select("doc_id", *[f"n_{k}" for k in pii.BASE_KINDS])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
        return corpus_pipeline.run(spark, sf_dir)

    found = [op1_ngram_jaccard_join, op2_chat_formatting, op3_best_fit_packing, op4_token_counts, op5_suffix_array_dedup, op6_url_filters, op7_quality_rules, op8_benchmark_decontamination, op9_pii, op10_toxicity, pipeline, quality_base_counts, pii_base_counts]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op6_url_filters": oracles.URLS, "quality_base_counts": oracles.QUALITY_COUNTS, "pii_base_counts": oracles.PII_COUNTS}
