"""The interferogram graph: dates, intervals, pairs and design matrices.

These tables have one row per date or pair; the pixel-sized work joins them by broadcast when their
checked size allows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def date_index(dates: DataFrame, date: str = "date") -> DataFrame:
    """(idx, date, days since the first)."""
    order = Window.orderBy(date)
    distinct = dates.select(F.col(date).alias("date")).where(F.col(date).isNotNull()).distinct()
    return distinct.select(
        (F.dense_rank().over(order) - 1).alias("idx"), "date", F.datediff("date", F.min("date").over(order)).alias("days")
    )


def intervals(indexed: DataFrame) -> DataFrame:
    """(k, start, end, dt) between consecutive dates."""
    order = Window.orderBy("idx")
    out = indexed.select(F.col("idx").alias("k"), F.col("date").alias("start"), F.lead("date").over(order).alias("end"))
    return out.where("end is not null").withColumn("dt", F.datediff("end", "start"))


def network(pairs: DataFrame, indexed: DataFrame) -> DataFrame:
    """(date1, date2, days, i1, i2) with both dates' indexes."""
    first = indexed.select(F.col("date").alias("date1"), F.col("idx").alias("i1"))
    second = indexed.select(F.col("date").alias("date2"), F.col("idx").alias("i2"))
    return pairs.join(first, "date1").join(second, "date2")


def incidence(pairs: DataFrame) -> DataFrame:
    """Matrix A in sparse form: −1 at the first date, +1 at the second."""
    entries = F.array(F.struct(F.col("i1").alias("idx"), F.lit(-1).alias("sign")), F.struct(F.col("i2").alias("idx"), F.lit(1).alias("sign")))
    return pairs.select("date1", "date2", F.explode(entries).alias("e")).select("date1", "date2", "e.*")


def integration(pairs: DataFrame, steps: DataFrame) -> DataFrame:
    """Matrix B in sparse form: the intervals that a pair spans. Intervals are a dense index, so they
    are exploded from the pair and need no range join."""
    spanned = pairs.where("i2 > i1").withColumn("k", F.explode(F.sequence(F.col("i1"), F.col("i2") - 1)))
    return spanned.join(steps.select("k", "dt"), "k").select("date1", "date2", "k", "dt")


def regularisation_scale(b: DataFrame) -> DataFrame:
    """The sum of squared entries of B."""
    return b.agg(F.sum(F.col("dt") * F.col("dt")).alias("scale"))


def matrices(ifgs: list[tuple[int, int]], days: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Dense A (without its first column) and B for the tube solvers."""
    a, b = np.zeros((len(ifgs), len(days))), np.zeros((len(ifgs), len(days) - 1))
    steps = np.diff(np.asarray(days, dtype=float))
    for row, (i, j) in enumerate(ifgs):
        a[row, i], a[row, j] = -1, 1
        b[row, i:j] = steps[i:j]
    return a[:, 1:], b


def seasonal_design(ifgs: list[tuple[int, int]], days: list[int], terms: int, period: float = 365.25) -> np.ndarray:
    """Columns: days, then sine and cosine differences of each term."""
    t = np.asarray(days, dtype=float)
    basis = [t]
    for k in range(1, terms + 1):
        basis += [np.sin(2 * np.pi * k * t / period), np.cos(2 * np.pi * k * t / period)]
    basis = np.stack(basis, axis=1)
    i, j = np.asarray(ifgs, dtype=int).reshape(-1, 2).T
    return basis[j] - basis[i]
