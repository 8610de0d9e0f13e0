"""The raster queries in sessions that don't have the settings of ``local_session``."""

import duckdb
import pytest

from phasegrid.plans import queries as plans
from tests.test_queries import duck, plain  # noqa: F401

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


@pytest.fixture
def pushdown(spark):
    """Gives the session its own setting of filter pushdown, or none."""
    before = spark.conf.get(PUSHDOWN)

    def give(value=None):
        spark.conf.unset(PUSHDOWN) if value is None else spark.conf.set(PUSHDOWN, value)

    yield give
    spark.conf.set(PUSHDOWN, before)


def got_and_wanted(spark, folder, duck, name):  # noqa: F811
    df = plans.QUERIES[name](spark, folder)
    got = sorted(tuple(plain(r[c]) for c in df.columns) for r in df.collect())
    columns = ", ".join(f'"{c}"' for c in df.columns)
    return got, sorted(tuple(map(plain, r)) for r in duck.sql(f"SELECT {columns} FROM ({plans.ORACLE[name]})").fetchall())


@pytest.mark.parametrize("name", ["raster_altline", "raster_roundtrip", "raster_altsample", "raster_complex_window", "raster_integers", "raster_pushdown", "raster_short_complex", "raster_headers"])
def test_default_session(spark, sf, duck, pushdown, name):  # noqa: F811
    """Filter pushdown isn't set, and Spark's own default is false."""
    pushdown()
    got, want = got_and_wanted(spark, sf, duck, name)
    assert got == want and spark.conf.get(PUSHDOWN) == "true"


@pytest.fixture(scope="module")
def gaps(spark, sf, tmp_path_factory):
    """A folder with some rows of the table, and DuckDB on it."""
    folder = tmp_path_factory.mktemp("gaps")
    con = duckdb.connect()
    some = f"SELECT CASE vec_id WHEN 200 THEN 50000 ELSE vec_id END AS vec_id, embedding, label FROM '{sf}/embeddings.parquet' WHERE vec_id IN (0, 1, 2, 11, 12, 40, 101, 102, 200)"
    con.sql(f"COPY ({some}) TO '{folder}/embeddings.parquet' (FORMAT parquet)")
    con.sql(f"CREATE VIEW embeddings AS FROM '{folder}/embeddings.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", ["raster_roundtrip", "raster_altsample", "raster_complex_window", "raster_integers", "raster_pushdown", "raster_short_complex", "raster_headers", "raster_altline"])
def test_gaps_without_pushdown(spark, gaps, pushdown, name):
    """Rows that the table doesn't have aren't in the results, and pushdown stays off."""
    pushdown("false")
    got, want = got_and_wanted(spark, *gaps, name)
    assert want and got == want and spark.conf.get(PUSHDOWN) == "false"
