"""URL rules, and trust and distrust that flow along links between hosts.

A rule is (host, path, verdict) and fits its host and all subdomains if the
url's path starts with the rule's; the longest rule that fits decides.  Other
urls are decided by their host: trust is a personalised PageRank from the
hosts whose pages the rules allow, distrust one over the reversed edges from
the hosts whose pages the rules block (who links to bad hosts is bad).  A
host's seed is the share of its pages that the rules allow or block; a host
is blocked if its distrust exceeds its trust by ``THRESHOLD`` of what a fully
blocked host has by itself.

Scores are iterated until no host receives more than ``TOLERANCE`` in a round;
``MAX_ROUNDS`` raises.

Everything is DataFrame code.  A short rule list is one expression; a longer
one is a table that is joined on the suffixes of the distinct hosts.  Pages are
never collected, and a host with a third of all pages is pre-aggregated before
every shuffle; the join that hands a host's verdict to its pages is a plain
equi-join, which adaptive execution splits.

Defined results: a null url, or one without ``://``, has an empty host and
path; no rule fits it, and its verdict is allow.  Null html has no links.
Repeated rows are judged one by one.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

Rule = tuple[str, str, str]  # host, path, verdict

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING, TOLERANCE, MAX_ROUNDS, THRESHOLD = 0.85, 1e-4, 200, 0.5
INLINE_RULES = 500


def split_rule(rule: str, verdict: str) -> Rule:
    host, slash, path = rule.partition("/")
    return host.lower(), slash + path, verdict


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(u, _PARTS, 1)), F.regexp_extract(u, _PARTS, 2)


BEST = "struct<n:int,rule:string,verdict:string>"


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(length, rule, verdict) of the longest rule that fits, else null."""
    if not rules:
        return F.lit(None).cast(BEST)
    fit = [
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(len(h) + len(p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for h, p, v in sorted(rules, key=lambda r: (-len(r[0]) - len(r[1]), r))
    ]
    return F.coalesce(*fit)


def with_best_rule(urls: DataFrame, rules: Sequence[Rule], inline: int = INLINE_RULES) -> DataFrame:
    """``urls`` (host, path) with ``best``: struct(length, rule, verdict) of the longest rule that fits, else null."""
    if len(rules) <= inline:
        return urls.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    table = urls.sparkSession.createDataFrame(sorted(set(rules)), "r_host string, r_path string, r_verdict string")
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    seen = urls.select("host", "path").distinct()
    fit = seen.withColumn("suffix", F.explode(suffixes)).join(table, F.col("suffix") == F.col("r_host")).filter(F.col("path").startswith(F.col("r_path")))
    found = F.struct((F.length("r_host") + F.length("r_path")).alias("n"), F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"))
    # rules of one length that fit one url are equal but for the verdict; the least verdict counts, as in the expression
    best = fit.groupBy(F.col("host").alias("b_host"), F.col("path").alias("b_path")).agg(F.min_by(found, F.struct(F.negate(found["n"]).alias("n"), found["verdict"])).alias("best"))
    return urls.join(best, (F.col("host") == F.col("b_host")) & (F.col("path") == F.col("b_path")), "left").drop("b_host", "b_path")


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct links between different hosts: ``src``, ``dst``, from absolute links in the html."""
    host, _ = host_and_path(F.col("url"))
    links = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1)), lambda h: lower_ascii(h)))
    d = common.pick(pages, {"url": "string", "html": "string"}).select(host.alias("src"), links.alias("links")).filter((F.col("src") != "") & (F.size("links") > 0))
    return d.select("src", F.explode("links").alias("dst")).filter("src <> dst").distinct()


def propagate(scratch: common.Scratch, seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Personalised PageRank of ``seeds`` (host, seed) along ``edges`` (src, dst): host, score.

    score = (1 - damping) * seed + damping * (what the hosts that point here share out evenly).
    """
    out = edges.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))
    shares = scratch.save(edges.join(out, "src").select("src", "dst", (F.lit(damping) / F.col("deg")).alias("w")), "shares")
    base = scratch.save(seeds.filter("seed > 0").select("host", (F.col("seed") * (1 - damping)).alias("score")), "seeds")
    new = base  # what flows in a round: the part of the score that came in the round before
    total = base
    for _ in range(max_rounds):
        fresh = scratch.save(new.join(shares, new["host"] == shares["src"]).select(F.col("dst").alias("host"), (F.col("score") * F.col("w")).alias("score")).groupBy("host").agg(F.sum("score").alias("score")), "flow")
        if new is not base:
            scratch.drop(new)
        new, before = fresh, total
        if (most := fresh.agg(F.max("score")).first()[0]) is None:
            return total
        total = scratch.save(before.unionByName(fresh).groupBy("host").agg(F.sum("score").alias("score")), "score")
        if before is not base:
            scratch.drop(before)
        if most <= tolerance:
            return total
    raise RuntimeError(f"scores still change by {most} after {max_rounds} rounds")


def judge(pages: DataFrame, rules: Sequence[Rule], inline: int = INLINE_RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust`` of every row of pages."""
    scratch = common.Scratch(pages.sparkSession, "urls")
    host, path = host_and_path(F.col("url"))
    p = common.pick(pages, {"page_id": "long", "url": "string"}).select("page_id", host.alias("host"), path.alias("path"))
    p = with_best_rule(p, rules, inline)
    share = lambda v: F.avg(F.when(F.col("best.verdict") == v, 1.0).otherwise(0.0))
    hosts = scratch.save(p.filter("host <> ''").groupBy("host").agg(share("allow").alias("allow"), share("block").alias("block")), "hosts")
    edges = scratch.save(host_edges(pages), "edges")
    trust = propagate(scratch, hosts.select("host", F.col("allow").alias("seed")), edges)
    distrust = propagate(scratch, hosts.select("host", F.col("block").alias("seed")), edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    scores = trust.select("host", F.col("score").alias("trust"), F.lit(0.0).alias("distrust")).unionByName(distrust.select("host", F.lit(0.0).alias("trust"), F.col("score").alias("distrust")))
    scores = scores.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
    j = p.join(scores.withColumnRenamed("host", "s_host"), F.col("host") == F.col("s_host"), "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    bad = distrust - trust > THRESHOLD * (1 - DAMPING)
    verdict = F.coalesce(F.col("best.verdict"), F.when(bad, F.lit("block")).otherwise(F.lit("allow")))
    return j.select("page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
