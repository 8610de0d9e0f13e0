"""Persistent scatterers by phase similarity with neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phasegrid.functions import cplx
from phasegrid.operators.joins import small


def circle(radius: int) -> list[tuple[int, int]]:
    """The octant x >= y >= 1 of the midpoint circle, upwards."""
    x, error, out = radius, 1 - radius, []
    for y in range(1, radius + 1):
        if error > 0:
            x -= 1
            error -= 2 * x
        error += 2 * y + 1
        if x < y:
            break
        out.append((x, y))
    return out


def spiral(low: int, high: int) -> list[tuple[int, int]]:
    """Offsets (dr, dc) of the rings low + 1 .. high − 1, outwards. A ring is a midpoint circle with the
    cells in its rows that lie between it and the rings before it, which circles alone would miss. It
    begins with its axis points; each cell of its octant is followed by its mirror images."""
    seen, out = {(0, 0)}, []
    for radius in range(1, high):
        ring = [(radius, 0)]
        seen |= {(radius, 0), (0, radius)}
        for x, y in circle(radius):
            first = x
            while first > 0 and (first - 1, y) not in seen:
                first -= 1
            for cell in ((i, y) for i in range(first, x + 1)):
                seen |= {cell, cell[::-1]}
                ring.append(cell)
        if radius > low:
            for x, y in ring:
                if y == 0:
                    out += [(x, 0), (-x, 0), (0, x), (0, -x)]
                    continue
                for u, v in [(x, y)] if x == y else [(x, y), (y, x)]:
                    out += [(u, v), (-u, -v), (u, -v), (-u, v)]
    return out


def offsets(spark: SparkSession, low: int, high: int) -> DataFrame:
    return spark.createDataFrame([(i, dr, dc) for i, (dr, dc) in enumerate(spiral(low, high))], "ord int, dr int, dc int")


def pair_similarity(stack: DataFrame, scatterers: DataFrame, offset_table: DataFrame, rows: int, cols: int, most: int) -> DataFrame:
    """(r, c, ord, sim): similarity of each pixel with its first ``most`` scatterer neighbours.

    ``stack`` has (ifg, r, c, re, im). Neighbours are chosen on the mask alone, before the stack is
    touched; then each pixel's series is an array, so a pair is one join row and not one per ifg."""
    moved = stack.select("r", "c").distinct().crossJoin(small(offset_table))
    moved = moved.select("r", "c", "ord", (F.col("r") + F.col("dr")).alias("nr"), (F.col("c") + F.col("dc")).alias("nc"))
    moved = moved.where((F.col("nr") >= 0) & (F.col("nr") < rows) & (F.col("nc") >= 0) & (F.col("nc") < cols))
    near = moved.join(scatterers.select(F.col("r").alias("nr"), F.col("c").alias("nc")), ["nr", "nc"])
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("r", "c").orderBy("ord"))).where(F.col("rank") <= most)
    re, im = cplx.unit(cplx.pair())
    series = stack.select("r", "c", F.struct("ifg", re.alias("re"), im.alias("im")).alias("z"))
    series = series.groupBy("r", "c").agg(F.array_sort(F.collect_list("z")).alias("z"))
    other = series.select(F.col("r").alias("nr"), F.col("c").alias("nc"), F.col("z").alias("nz"))
    both = near.join(series, ["r", "c"]).join(other, ["nr", "nc"])
    terms = F.zip_with("z", "nz", lambda a, b: a["re"] * b["re"] + a["im"] * b["im"])
    sim = F.aggregate(terms, F.lit(0.0), lambda a, v: a + v) / F.size("z")
    return both.select("r", "c", "ord", sim.alias("sim"))


def median_similarity(pairs: DataFrame, pixels: DataFrame) -> DataFrame:
    """The upper median over neighbours; 0 without any."""
    lists = pairs.groupBy("r", "c").agg(F.sort_array(F.collect_list("sim")).alias("s"))
    upper = F.get("s", F.floor(F.size("s") / 2).cast("int"))
    return pixels.select("r", "c").join(lists, ["r", "c"], "left").select("r", "c", F.coalesce(upper, F.lit(0.0)).alias("sim"))


def max_similarity(pairs: DataFrame, pixels: DataFrame) -> DataFrame:
    """The largest over neighbours; scatterers themselves are 1, pixels without neighbours 0."""
    best = pairs.groupBy("r", "c").agg(F.max("sim").alias("best"))
    joined = pixels.select("r", "c", "ps").join(best, ["r", "c"], "left")
    return joined.select("r", "c", F.when(F.col("ps") == 1, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("sim"))


def updated(ps: Column, sim: Column, threshold: float, overwrite: bool) -> Column:
    """1 where the similarity reaches the threshold; else 0, or as it was."""
    return F.when(sim >= threshold, 1).otherwise(F.lit(0) if overwrite else ps)
