"""How the driver's tables are read as scenes, stacks and catalogues; with the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phasegrid.operators import raster, timeseries
from phasegrid.operators.joins import pairs_within
from phasegrid.plans import network

COLS = 64
MIN_DAYS, MAX_DAYS = 6, 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(value: Column) -> Column:
    """Rounded for comparison, without a negative zero."""
    return F.round(value, 6) + F.lit(0.0)


def epoch_micros(column: str) -> Column:
    """Microseconds since 1970 of a timestamp without zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', cast({column} AS timestamp_ntz))")


def embedding_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(r, c, v): a raster of 64 columns."""
    return raster.pixels(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def embedding_complex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(r, c, re, im): a complex raster of 32 columns."""
    return raster.complex_from_arrays(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def rows_of(spark: SparkSession, sf_dir: str) -> int:
    """The height of the embedding raster, from its ids."""
    return table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0] + 1


def monthly_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(px, date, phase): pixel = nation, date = month of order."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("px"))
    joined = orders.join(customers, "o_custkey")
    month = F.to_date(F.date_trunc("month", "o_orderdate"))
    return joined.groupBy("px", month.alias("date")).agg(F.round(F.sum("o_totalprice") / 1e6, 9).alias("phase"))


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(idx, date, days) of all months with orders: one column of one table, no join."""
    month = F.to_date(F.date_trunc("month", "o_orderdate"))
    return network.date_index(table(spark, sf_dir, "orders").select(month.alias("date")).distinct())


def month_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = months(spark, sf_dir)
    return network.network(pairs_within(indexed, "date", MIN_DAYS, MAX_DAYS), indexed)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(px, date1, date2, i1, i2, days, u). The pair table has some hundred rows, whatever the scale
    (months of order dates), and is joined as AQE sees fit."""
    return timeseries.form_pairs(monthly_phases(spark, sf_dir), month_pairs(spark, sf_dir), ["px"])


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()


PX = "px AS (SELECT vec_id::BIGINT AS r, (i - 1)::INTEGER AS c, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 65) t(i))"
Z = PX + ", z AS (SELECT r, (c // 2)::INTEGER AS c, max(CASE WHEN c % 2 = 0 THEN v END) AS re, max(CASE WHEN c % 2 = 1 THEN v END) AS im FROM px GROUP BY ALL)"
N_ROWS = "(SELECT max(vec_id) + 1 FROM embeddings)"
OBS = """obs AS (SELECT c_nationkey AS px, date_trunc('month', o_orderdate)::DATE AS date, round(sum(o_totalprice) / 1e6, 9) AS phase
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""
DATES = OBS + ", dates AS (SELECT (row_number() OVER (ORDER BY date) - 1)::INTEGER AS idx, date, (date - min(date) OVER ())::INTEGER AS days FROM (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS date FROM orders))"
STEPS = DATES + ", steps AS (SELECT * FROM (SELECT idx AS k, date AS start, lead(date) OVER (ORDER BY idx) AS end_, (lead(date) OVER (ORDER BY idx) - date)::INTEGER AS dt FROM dates) WHERE end_ IS NOT NULL)"
PAIRS = STEPS + f""", pairs AS (SELECT a.date AS date1, b.date AS date2, a.idx AS i1, b.idx AS i2, a.days AS t1, b.days AS t2, (b.date - a.date)::INTEGER AS days
  FROM dates a JOIN dates b ON b.date - a.date BETWEEN {MIN_DAYS} AND {MAX_DAYS})"""
UNW = PAIRS + """, unw AS (SELECT p1.px, date1, date2, i1, i2, t1, t2, days, p2.phase - p1.phase AS u
  FROM pairs JOIN obs p1 ON p1.date = date1 JOIN obs p2 ON p2.date = date2 AND p2.px = p1.px)"""
VEL = UNW + """, vel AS (SELECT px, k, sum(u) / (sum(abs(days)::DOUBLE) + 1e-6) AS v
  FROM (SELECT px, u, days, unnest(range(i1, i2))::INTEGER AS k FROM unw) GROUP BY ALL)"""
MAD = VEL + """, dev AS (SELECT px, k, v, round(abs(v - med), 9) AS dev FROM vel JOIN (SELECT px, median(abs(v)) AS med FROM vel GROUP BY px) USING (px)),
 mad AS (SELECT px, k, v, dev, mad, dev > greatest(round(mad * 3.0::DOUBLE, 9), 0.0) AS outlier
  FROM dev JOIN (SELECT px, round(median(dev), 9) AS mad FROM dev GROUP BY px) USING (px))"""
KEPT = MAD + """, kept AS (SELECT * FROM unw u WHERE NOT EXISTS (SELECT 1 FROM mad m WHERE m.px = u.px AND m.outlier AND m.k >= u.i1 AND m.k < u.i2))"""
