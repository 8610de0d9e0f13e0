"""Interval, nearest and neighbourhood joins that plan as equi joins."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasegrid.session import cut

#: A side is broadcast by hint only below this many rows.
SMALL_ROWS = 100_000


def small(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Broadcast ``df`` if a bounded count shows that it has at most ``limit`` rows; else leave the
    strategy to AQE."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def band_join(left: DataFrame, right: DataFrame, left_key: Column, right_low: Column, right_high: Column, width: float, on: Sequence[str] = ()) -> DataFrame:
    """Rows with right_low <= left_key <= right_high. The right side is copied to each bucket of
    ``width`` that its interval touches, so the join hashes on the bucket; choose a width near the
    typical interval. The residual predicate keeps it exact."""
    bucket = lambda x: F.floor(x / width)
    l_side = left.withColumn("__bucket", bucket(left_key)).withColumn("__at", left_key)
    r_side = right.withColumns({"__low": right_low, "__high": right_high}).where(F.col("__low") <= F.col("__high"))
    r_side = r_side.withColumn("__bucket", F.explode(F.sequence(bucket(F.col("__low")), bucket(F.col("__high")))))
    joined = l_side.join(r_side, ["__bucket", *on]).where((F.col("__at") >= F.col("__low")) & (F.col("__at") <= F.col("__high")))
    return joined.drop("__bucket", "__at", "__low", "__high")


def first_match(joined: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Per key the matched row that is least by ``order``: one combining aggregate."""
    least = F.min(F.struct(*order, *[c for c in keep if c not in order])).alias("m")
    return joined.groupBy(*keys).agg(least).select(*keys, *[F.col(f"m.{c}").alias(c) for c in keep])


def pairs_within(dates: DataFrame, date: str, low: int, high: int) -> DataFrame:
    """(date1, date2, days) of all date pairs with low <= days <= high, as a band join on buckets of
    ``high`` days."""
    a = dates.select(F.col(date).alias("date1")).distinct()
    b = dates.select(F.col(date).alias("date2")).distinct()
    day = lambda c: F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))
    joined = band_join(b, a, day("date2"), day("date1") + low, day("date1") + high, float(max(1, high)))
    return joined.select("date1", "date2", F.datediff("date2", "date1").alias("days"))


def nearest_boxes(left: DataFrame, right: DataFrame, on: Sequence[str], left_id: str, right_id: str, other: bool = False) -> DataFrame:
    """For each left box (top, bottom) the right box with the least abs(top diff) + abs(bottom diff),
    ties to the least id; with ``other`` one of another id (ids of a key are unique then). Boxes with
    a null bound, and those whose key has no right box, have no row.

    Equal boxes of a key are searched for once, and of equal right boxes the two least ids stand for
    all. A box that finds its own id is searched for again without it."""
    box = [*on, "top", "bottom"]
    whole = F.col("top").isNotNull() & F.col("bottom").isNotNull()
    l_side = left.select(*on, F.col(left_id).alias("l_id"), "top", "bottom").where(whole)
    r_side = right.select(*on, F.col(right_id).alias("r_id"), "top", "bottom").where(whole)
    least = Window.partitionBy(*box).orderBy("r_id")
    r_side = cut(r_side.withColumn("i", F.row_number().over(least)).where("i <= 2"))
    places = l_side.select(*box).distinct().withColumn("own", F.lit(None).cast(r_side.schema["r_id"].dataType))
    found = l_side.join(_nearest(places, r_side.where("i = 1").drop("i"), on), box)
    if other:
        found = cut(found)
        again = found.where(F.col("r_id") == F.col("l_id")).select(*box, F.col("l_id").alias("own"))
        again = _nearest(again, r_side.drop("i"), on).withColumnRenamed("own", "l_id")
        kept = found.where(F.col("r_id") != F.col("l_id")).select(*on, "l_id", "r_id", "distance")
        return kept.unionByName(again.select(*on, "l_id", "r_id", "distance"))
    return found.select(*on, "l_id", "r_id", "distance")


def _nearest(places: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``places(on, top, bottom, own)`` with r_id and distance of the nearest right box but ``own``.

    With u = top + bottom and v = top - bottom the distance is max(abs(u diff), abs(v diff)). Right
    boxes are bucketed in cells of u and v; what lies within one cell's width of a place is in the
    nine cells around it, so a match that near is final. Other places go on with wider cells, and
    the last cells span all."""
    ends = [f(c) for c in ("top", "bottom") for f in (F.min, F.max)]
    n, *of_right = right.agg(F.count("*"), *ends).first()
    of_left = list(places.agg(*ends).first())
    if not n or of_left[0] is None:
        return places.withColumns({"r_id": F.lit(None).cast(right.schema["r_id"].dataType), "distance": F.lit(None).cast("long")}).limit(0)
    low, high = (lambda i: min(of_left[i], of_right[i])), (lambda i: max(of_left[i], of_right[i]))
    span = float(high(1) - low(0) + high(3) - low(2)) + 1.0
    span = max(span, float(max(high(1), high(3)) - min(low(0), low(2))) * 2 + 1.0)
    width = max(span / 2**40, min(1.0, span / math.sqrt(n)))
    u, v = F.col("top") + F.col("bottom"), F.col("top") - F.col("bottom")
    cell = lambda x, w: F.floor(x / w).cast("long")
    key = [*on, "top", "bottom", "own"]
    left, out = places, None
    while True:
        near = F.explode(F.array(*[F.struct((cell(u, width) + i).alias("cu"), (cell(v, width) + j).alias("cv")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
        l_side = left.select(*key, near.alias("cell")).select(*key, "cell.*")
        r_side = right.select(*on, F.col("top").alias("r_top"), F.col("bottom").alias("r_bottom"), "r_id", cell(u, width).alias("cu"), cell(v, width).alias("cv"))
        far = F.abs(F.col("top") - F.col("r_top")) + F.abs(F.col("bottom") - F.col("r_bottom"))
        met = l_side.join(r_side, [*on, "cu", "cv"]).where(F.col("own").isNull() | (F.col("own") != F.col("r_id")))
        best = met.groupBy(*key).agg(F.min(F.struct(far.alias("distance"), "r_id")).alias("m")).select(*key, "m.r_id", "m.distance")
        last = width > span
        best = cut(best if last else best.where(F.col("distance") <= width))
        out = best if out is None else out.unionByName(best)
        if last:
            return out
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"b.{c}")) for c in key]
        left = cut(left.alias("l").join(best.alias("b"), same, "left_anti"))
        if left.isEmpty():
            return out
        width *= 4


def bracket(samples: DataFrame, at: str, value: str) -> DataFrame:
    """(t0, t1, v0, v1) between consecutive samples, for ``interpolate``."""
    order = Window.orderBy(at)
    out = samples.select(F.col(at).alias("t0"), F.lead(at).over(order).alias("t1"), F.col(value).alias("v0"), F.lead(value).over(order).alias("v1"))
    return out.where("t1 is not null")


def interpolate(points: DataFrame, at: str, samples: DataFrame, sample_at: str, value: str, width: float) -> DataFrame:
    """Points with ``value`` interpolated linearly between the samples around them, clamped to the
    first and last sample outside. Sample tables are graph-sized (one row per date or polynomial)."""
    ends = samples.agg(
        F.min(sample_at).alias("first_t"), F.max(sample_at).alias("last_t"),
        F.min_by(value, sample_at).alias("first_v"), F.max_by(value, sample_at).alias("last_v"),
    )
    clamped = points.crossJoin(F.broadcast(ends))  # one row by construction
    outside = clamped.where((F.col(at) <= F.col("first_t")) | (F.col(at) >= F.col("last_t")))
    outside = outside.withColumn(value, F.when(F.col(at) <= F.col("first_t"), F.col("first_v")).otherwise(F.col("last_v")))
    inner = clamped.where((F.col(at) > F.col("first_t")) & (F.col(at) < F.col("last_t")))
    joined = band_join(inner, bracket(samples, sample_at, value), F.col(at), F.col("t0"), F.col("t1"), width)
    joined = joined.where(F.col(at) < F.col("t1"))
    share = (F.col(at) - F.col("t0")) / (F.col("t1") - F.col("t0"))
    joined = joined.withColumn(value, F.col("v0") + share * (F.col("v1") - F.col("v0")))
    columns = [*points.columns, value]
    return joined.select(*columns).unionByName(outside.select(*columns))


def neighbours(df: DataFrame, offsets: DataFrame, rows: int, cols: int) -> DataFrame:
    """(r, c, ord, nr, nc) for each pixel and offset that stays inside: the offset list is a table of
    a few hundred rows by its radius, checked before it is broadcast."""
    moved = df.select("r", "c").crossJoin(small(offsets))
    moved = moved.select("r", "c", "ord", (F.col("r") + F.col("dr")).alias("nr"), (F.col("c") + F.col("dc")).alias("nc"))
    return moved.where((F.col("nr") >= 0) & (F.col("nr") < rows) & (F.col("nc") >= 0) & (F.col("nc") < cols))
