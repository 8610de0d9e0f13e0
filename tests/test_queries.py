"""Every query with SQL against DuckDB on the smallest tables, and stability under repartitioning."""

import math
import os

import duckdb
import pytest

from phasegrid.plans import queries as plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*' if os.path.isdir(path) else path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value if value is None or isinstance(value, (int, str, bool)) else str(value)


def near(a, b):
    return a == b or (isinstance(a, (int, float)) and isinstance(b, (int, float)) and abs(a - b) <= 2e-6 * max(1, abs(a)))


@pytest.mark.parametrize("name", sorted(plans.ORACLE))
def test_query_matches_sql(spark, sf, duck, name):
    df = plans.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    relation = duck.sql(plans.ORACLE[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in relation.fetchall()), key=repr)
    assert len(got) == len(want)
    bad = [(g, w) for g, w in zip(got, want, strict=True) if not all(map(near, g, w))]
    assert not bad, bad[:3]


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE)))
def test_query_without_sql_runs(spark, sf, name):
    df = plans.QUERIES[name](spark, sf)
    assert df.limit(3).count() >= 0 and df.schema.fields


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
