"""Queries of the ten operators against their SQL."""

from collections import Counter

import duckdb
import pytest

from marlstone.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = c.sql(queries.oracle_sql()[name])
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(x) for x in cols]
    assert Counter(tuple(r[x] for x in cols) for r in df.collect()) == Counter(tuple(r[i] for i in at) for r in rel.fetchall())


def test_url_sql_follows_links(spark, tmp_path):
    """Links between hosts, with a cycle: the verdicts of the graph."""
    link = lambda *hosts: "".join(f'<a href="http://{h}/">' for h in hosts)
    pages = [("http://bad.net/es/", link("farm0.org"))] + [(f"http://farm{i}.org/", link("bad.net", f"farm{(i + 1) % 5}.org")) for i in range(5)]
    pages += [("http://bad.net/fr/x", ""), ("http://ok.org/", link("a.com")), ("http://a.com/", link("ok.org")), ("http://one.org/", link("Bad.net")), (None, None)]
    d = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    d.write.parquet(str(tmp_path / "pages.parquet"))
    c = duckdb.connect()
    c.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = {r[0]: r for r in c.sql(f"SELECT page_id, host, path, rule, verdict FROM ({queries.oracle_sql()['op6_url_filters']})").fetchall()}
    got = {r["page_id"]: tuple(r) for r in queries.op6_url_filters(spark, str(tmp_path)).collect()}
    assert got == want and {g[4] for g in got.values() if g[3] is None} == {"allow", "block"}
