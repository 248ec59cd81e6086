"""Near duplicates of 64-bit signatures: candidates by equal bands, then a greedy choice in order.

Two signatures at distance 7 or less differ by one bit at most in one of four
bands of sixteen bits.  So an equi-join of (band, value) with every value that
is one bit or none away (17 probes a band) finds each pair, and of two random
signatures about one pair in a thousand meets; nothing is compared all with
all.  Rows with equal signatures are collapsed before the join; adaptive
execution splits the values that stay hot.  Every join here is a merge join.
Spark doesn't count the rows that explode adds (68 for a probing signature), so
it would take a table of many times the driver's memory for one to broadcast;
and it judges signatures, edges and keys by their compressed files, so what it
broadcasts of them is several times as large in the driver.
The greedy choice keeps a row unless an earlier kept row is near: the
lexicographically first maximal independent set, found in rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.signature import hamming
from ..options import HAMMING_BELOW
from ..sources.scratch import written

BANDS, WIDTH = 4, 16
FARTHEST = 2 * BANDS - 1  # with more differing bits, every band may have two


def _band(sig: Column, i: int) -> Column:
    return F.shiftrightunsigned(sig, WIDTH * i).bitwiseAND(F.lit((1 << WIDTH) - 1))


def bands(df: DataFrame, probes: bool = False) -> DataFrame:
    """A row for each band of ``sig`` (band, value); with ``probes`` also for every value one bit away."""
    d = df.select("sig", F.posexplode(F.array(*[_band(F.col("sig"), i) for i in range(BANDS)])).alias("band", "value"))
    flips = F.explode(F.array(*[F.lit(x).cast("long") for x in (0, *(1 << i for i in range(WIDTH)))]))
    return d.select("sig", "band", "value", flips.alias("flip")).select("sig", "band", F.col("value").bitwiseXOR(F.col("flip")).alias("value")) if probes else d


def near_pairs(left: DataFrame, right: DataFrame, below: int = HAMMING_BELOW) -> DataFrame:
    """Distinct (l_sig, r_sig, distance) with distance < below between two tables of distinct signatures."""
    if not 1 <= below <= FARTHEST + 1:
        raise ValueError(f"bands find distances up to {FARTHEST}")
    a = bands(left, probes=True).select(F.col("sig").alias("l_sig"), "band", "value")
    b = bands(right).select(F.col("sig").alias("r_sig"), "band", "value")
    d = hamming(F.col("l_sig"), F.col("r_sig"))
    # of the bands a pair meets in only the first one counts, so the pair needs no distinct()
    x = F.col("l_sig").bitwiseXOR(F.col("r_sig"))
    first = F.coalesce(*[F.when(F.bit_count(_band(x, i)) <= 1, F.lit(i)) for i in range(BANDS)])
    return a.hint("merge").join(b.hint("merge"), ["band", "value"]).filter((d < below) & (first == F.col("band"))).select("l_sig", "r_sig", d.alias("distance"))


def unseen(batch: DataFrame, index: DataFrame, below: int = HAMMING_BELOW) -> DataFrame:
    """Rows of the batch (with ``sig``) that are near no row of the index; a null signature is near nothing."""
    sigs = batch.filter("sig is not null").select("sig").distinct()
    hit = near_pairs(sigs, index.filter("sig is not null").select("sig").distinct(), below).select(F.col("l_sig").alias("h_sig")).distinct()
    return batch.join(hit.hint("merge"), F.col("sig") == F.col("h_sig"), "left_anti")


def greedy(batch: DataFrame, order: str, index: DataFrame | None = None, below: int = HAMMING_BELOW) -> DataFrame:
    """Rows of the batch that a scan in ``order`` would keep: near no kept or indexed row before them.

    ``order`` must be unique; rows with a null signature are kept and make no other row go.
    """
    rows = batch if index is None else unseen(batch, index, below)
    rows = written(rows, "greedy-rows")
    if not rows.groupBy(order).count().filter("count > 1").isEmpty():
        raise ValueError(f"{order} is not unique")
    first = rows.filter("sig is not null").groupBy("sig").agg(F.min(order).alias("at"))
    first = written(first, "greedy-first")
    at = lambda side: first.select(F.col("sig").alias(f"{side}_sig"), F.col("at").alias(f"{side}_at")).hint("merge")
    edges = near_pairs(first.select("sig"), first.select("sig"), below).join(at("l"), "l_sig").join(at("r"), "r_sig").filter("l_at < r_at").select("l_at", "r_at")
    edges = written(edges, "greedy-edges")
    gone = None
    while not edges.isEmpty():
        later = edges.select(F.col("r_at").alias("x")).distinct()
        kept = edges.select(F.col("l_at").alias("x")).distinct().join(later.hint("merge"), "x", "left_anti")
        drop = written(edges.join(kept.hint("merge"), F.col("l_at") == F.col("x"), "left_semi").select(F.col("r_at").alias("x")).distinct(), "greedy-drop")
        gone = drop if gone is None else gone.unionByName(drop)
        done = drop.unionByName(kept).distinct().hint("merge")
        edges = written(edges.join(done, F.col("l_at") == F.col("x"), "left_anti").join(done, F.col("r_at") == F.col("x"), "left_anti"), "greedy-edges")
    good = first if gone is None else first.join(gone.hint("merge"), F.col("at") == F.col("x"), "left_anti")
    return rows.join(good.select(F.col("at").alias("k_at")).hint("merge"), F.col(order) == F.col("k_at"), "left_semi").unionByName(rows.filter("sig is null"))
