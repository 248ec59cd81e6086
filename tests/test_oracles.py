"""Every registered query against its SQL, as a multiset of rows with columns by name."""

from collections import Counter

import duckdb
import pytest

from marlstone.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_matches_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    rel = duck.sql(catalogue.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    mine = Counter(tuple(r[c] for c in cols) for r in df.collect())
    at = [rel.columns.index(c) for c in cols]
    theirs = Counter(tuple(r[i] for i in at) for r in rel.fetchall())
    assert mine == theirs
    assert mine, "an empty result shows nothing"
