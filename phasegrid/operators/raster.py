"""Raster algebra on the long form: one row per pixel, (keys..., r, c, value columns).

Everything here is relational, so Catalyst prunes columns, pushes box filters into the scan and
combines block averages on the map side. Zero is "no data" but takes part in averages.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasegrid.functions import cplx


def pixels(arrays: DataFrame, row: str, values: str) -> DataFrame:
    """(r, c, v) from rows of arrays."""
    return arrays.select(F.col(row).cast("long").alias("r"), F.posexplode(values).alias("c", "v")).withColumn("v", F.col("v").cast("double"))


def complex_pixels(real: DataFrame) -> DataFrame:
    """(r, c, re, im) from (r, c, v): values 2c and 2c + 1 of a row are one complex pixel."""
    pick = lambda odd: F.max(F.when(F.col("c") % 2 == odd, F.col("v")))
    return real.groupBy("r", F.expr("cast(c div 2 as int)").alias("c")).agg(pick(0).alias("re"), pick(1).alias("im"))


def complex_from_arrays(arrays: DataFrame, row: str, values: str) -> DataFrame:
    """(r, c, re, im) straight from interleaved arrays, without a shuffle."""
    pairs = F.transform(
        F.sequence(F.lit(0), F.expr(f"size({values}) div 2 - 1")), lambda i: F.struct(F.get(values, 2 * i).alias("re"), F.get(values, 2 * i + 1).alias("im"))
    )
    rows = arrays.select(F.col(row).cast("long").alias("r"), F.posexplode(pairs).alias("c", "z"))
    return rows.select("r", "c", F.col("z.re").cast("double").alias("re"), F.col("z.im").cast("double").alias("im"))


def in_box(df: DataFrame, top: int, bottom: int, left: int, right: int) -> DataFrame:
    """Half-open box; on a scan these are pushed filters."""
    return df.where((F.col("r") >= top) & (F.col("r") < bottom) & (F.col("c") >= left) & (F.col("c") < right))


def blocks(df: DataFrame, rows: int, cols: int, looks: tuple[int, int]) -> DataFrame:
    """Drop what doesn't fill a block of a ``rows`` × ``cols`` raster, and add br, bc."""
    a, b = looks
    whole = in_box(df, 0, rows // a * a, 0, cols // b * b)
    return whole.withColumns({"br": F.expr(f"r div {a}"), "bc": F.expr(f"cast(c div {b} as int)")})


def multilook(df: DataFrame, rows: int, cols: int, looks: tuple[int, int], values: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Block sums divided by the block's size (so absent cells count as 0)."""
    cells = float(looks[0] * looks[1])
    return blocks(df, rows, cols, looks).groupBy(*keys, "br", "bc").agg(*[(F.sum(v) / cells).alias(v) for v in values])


def multilook_short(df: DataFrame, rows: int, cols: int, looks: tuple[int, int], value: str) -> DataFrame:
    """Averages of an integer raster, truncated to its type again."""
    return multilook(df, rows, cols, looks, [value]).withColumn(value, F.col(value).cast("short"))


def power_looks(df: DataFrame, rows: int, cols: int, looks: tuple[int, int], keys: Sequence[str] = ()) -> DataFrame:
    """Mean squared magnitude, also for 1 × 1 looks."""
    squared = df.withColumn("power", cplx.power(cplx.pair()))
    return multilook(squared, rows, cols, looks, ["power"], keys)


def amplitude_looks(df: DataFrame, rows: int, cols: int, looks: tuple[int, int], keys: Sequence[str] = ()) -> DataFrame:
    made = power_looks(df, rows, cols, looks, keys)
    return made.select(*keys, "br", "bc", F.sqrt("power").alias("amp"))


def mosaic(df: DataFrame, priority: str, values: Sequence[str], nonzero: Column, last_wins: bool = False, keys: Sequence[str] = ("r", "c")) -> DataFrame:
    """Per cell the values of the first (or last) source by priority that has data there: one
    aggregate that combines on the map side, whatever the number of sources."""
    packed = F.struct(*values)
    pick = (F.max_by if last_wins else F.min_by)(packed, F.col(priority))
    return df.where(nonzero).groupBy(*keys).agg(pick.alias("m")).select(*keys, "m.*")


def nonzero_rows(df: DataFrame, has_data: Column, keys: Sequence[str] = ()) -> DataFrame:
    return df.where(has_data).select(*keys, "r").distinct()


def row_extent(df: DataFrame, has_data: Column, keys: Sequence[str] = ()) -> DataFrame:
    """First and last row with data, and its number of rows."""
    found = df.where(has_data).groupBy(*keys) if keys else df.where(has_data)
    return found.agg(F.min("r").alias("top"), F.max("r").alias("bottom"), F.count_distinct("r").alias("n_rows"))


def strips(df: DataFrame, has_data: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Runs of consecutive rows with data: top, bottom (exclusive), n_rows. ``keys`` name the images;
    a window runs over the distinct rows of one image."""
    rows = nonzero_rows(df, has_data, keys)
    island = F.col("r") - F.row_number().over(Window.partitionBy(*keys).orderBy("r"))
    grouped = rows.withColumn("island", island).groupBy(*keys, "island")
    return grouped.agg(F.min("r").alias("top"), (F.max("r") + 1).alias("bottom"), F.count("*").alias("n_rows")).drop("island")


def zero_mask(df: DataFrame, other: DataFrame, value: str, keys: Sequence[str] = ("r", "c")) -> DataFrame:
    """``value`` where ``other`` (re, im) has data, else 0."""
    no_data = (F.col("re") == 0) & (F.col("im") == 0)
    return df.join(other, list(keys)).withColumn(value, F.when(no_data, 0.0).otherwise(F.col(value))).drop("re", "im")


def completeness(df: DataFrame, image: str, has_data: Column, max_deviation: float) -> DataFrame:
    """Per image its data count, the share lost against the median and whether it is flagged."""
    counts = df.groupBy(image).agg(F.count_if(has_data).alias("n"))
    middle = counts.agg(F.median("n").alias("med"))
    joined = counts.crossJoin(F.broadcast(middle))  # one row by construction
    lost = (F.col("med") - F.col("n")) / F.col("med")
    return joined.select(image, "n", "med", lost.alias("lost"), ((F.col("med") - F.col("n")) > F.col("med") * max_deviation).alias("flagged"))


def validity_mask(df: DataFrame, has_data: Column, at_median: bool = False, keys: Sequence[str] = ("r", "c")) -> DataFrame:
    """Per cell the number of images with data, and whether it exceeds the median of the counts above
    0 (``at_median``: reaches it)."""
    counts = df.groupBy(*keys).agg(F.count_if(has_data).alias("n"))
    middle = counts.where("n > 0").agg(F.median("n").alias("med"))
    test = F.col("n") >= F.col("med") if at_median else F.col("n") > F.col("med")
    return counts.crossJoin(F.broadcast(middle)).select(*keys, "n", test.alias("valid"))


def stretch(df: DataFrame, value: str, low: float, high: float, accuracy: int = 10_000) -> DataFrame:
    """The exact percentiles that an image is stretched between, without NaN; nulls if it has no values.

    A sketch of rank error n / ``accuracy`` brackets each percentile; the values below a bracket are
    counted and only those in it, about 4 n / ``accuracy``, are ranked exactly. Starts two jobs."""
    clean = df.where(~F.isnan(value) & F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    ends = [min(1.0, max(0.0, p + d / accuracy)) for p in (low, high) for d in (-2, 2)]
    n, marks = clean.agg(F.count("*"), F.percentile_approx("v", ends, accuracy)).first()
    if not n:
        return df.sparkSession.createDataFrame([(None, None)], "low double, high double")
    brackets = [(p, marks[2 * i] if ends[2 * i] > 0 else -math.inf, marks[2 * i + 1] if ends[2 * i + 1] < 1 else math.inf) for i, p in enumerate((low, high))]
    inside = [F.col("v").between(a, z) for _, a, z in brackets]
    counts = clean.agg(*[F.count_if(F.col("v") < a) for _, a, _ in brackets], *[F.count_if(x) for x in inside]).first()
    picks = []
    for i, (p, _, _) in enumerate(brackets):
        place, held = p * (n - 1) - counts[i], counts[2 + i]
        whole = not 0 <= place <= held - 1  # the next value lies beyond the bracket
        share, kept = (p, F.col("v")) if whole else (place / max(1, held - 1), F.when(inside[i], F.col("v")))
        picks.append(F.percentile(kept, F.lit(float(share))))
    return clean.agg(picks[0].alias("low"), picks[1].alias("high"))


def mirror_index(i: Column, n: int) -> Column:
    """Reflect an index at 0 and n − 1 without repeating the edge."""
    return F.when(i < 0, -i).when(i >= n, 2 * (n - 1) - i).otherwise(i)


def box_mean(df: DataFrame, rows: int, cols: int, half: int, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """(2·half + 1)² box mean with mirrored edges. The sum is separable: each pixel is sent to the
    2·half + 1 columns it counts in and summed, then the same along rows, so a pixel is copied
    2·(2·half + 1) times and not its square."""
    width = float((2 * half + 1) ** 2)

    def along(source: DataFrame, axis: str, n: int) -> DataFrame:
        # The targets t with mirror(t + d) = i: i − d itself and the reflections of the edges.
        direct = F.transform(F.sequence(F.lit(-half), F.lit(half)), lambda d: F.col(axis) - d)
        low = F.filter(F.transform(F.sequence(F.lit(-half), F.lit(half)), lambda d: -F.col(axis) - d), lambda t: F.col(axis) > 0)
        high = F.filter(F.transform(F.sequence(F.lit(-half), F.lit(half)), lambda d: 2 * (n - 1) - F.col(axis) - d), lambda t: F.col(axis) < n - 1)
        every = F.filter(F.concat(direct, low, high), lambda t: (t >= 0) & (t < n))
        spread = source.select(*keys, *[F.explode(every).alias(x) if x == axis else F.col(x) for x in ("r", "c")], value)
        return spread.groupBy(*keys, "r", "c").agg(F.sum(value).alias(value))

    summed = along(along(df.select(*keys, "r", "c", value), "c", cols), "r", rows)
    return summed.withColumn(value, F.col(value) / width)


def reference_phase(stack: DataFrame, image: str, value: str, mask: Column, point: tuple[int, int], window: tuple[int, int], shape: tuple[int, int]) -> DataFrame:
    """Per image the mean of value · mask over the window; masked cells count as 0 but are counted."""
    half_r, half_c = (window[0] + 1) // 2, (window[1] + 1) // 2
    top, bottom = max(0, point[0] - half_r + 1), min(shape[0], point[0] + half_r)
    left, right = max(0, point[1] - half_c + 1), min(shape[1], point[1] + half_c)
    cells = in_box(stack, top, bottom, left, right)
    return cells.groupBy(image).agg((F.sum(F.when(mask, F.col(value)).otherwise(0.0)) / F.count("*")).alias("ref"))


def tubes(stack: DataFrame, order: str, value: str, keys: Sequence[str] = ("r", "c")) -> DataFrame:
    """One row per pixel with its values as an array in image order."""
    rows = stack.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, value))).alias("t"))
    return rows.select(*keys, F.transform("t", lambda x: x[value]).alias("u"))


def reproject(df: DataFrame, row: Column, col: Column, value: str, order: str, rows: int, cols: int) -> DataFrame:
    """Send each pixel to the integer cell (row, col); of several the last by ``order`` stays."""
    sent = df.select(row.cast("int").alias("r2"), col.cast("int").alias("c2"), value, order)
    sent = sent.where((F.col("r2") >= 0) & (F.col("r2") < rows) & (F.col("c2") >= 0) & (F.col("c2") < cols))
    return sent.groupBy("r2", "c2").agg(F.max_by(value, order).alias(value))


def evenly_spaced(df: DataFrame, order: str, k: int) -> DataFrame:
    """At most ``k`` rows at places floor(i·(n − 1)/(k − 1)) of the order."""
    numbered = df.withColumn("__i", F.row_number().over(Window.orderBy(order)) - 1)
    n = df.agg(F.count("*").alias("n"))
    places = n.select(F.explode(F.sequence(F.lit(0), F.least(F.lit(k), F.col("n")) - 1)).alias("j"), F.col("n"))
    step = F.floor(F.col("j") * (F.col("n") - 1) / F.greatest(F.lit(1), F.least(F.lit(k), F.col("n")) - 1))
    return numbered.join(F.broadcast(places.select(step.alias("__i")).distinct()), "__i", "left_semi").drop("__i")


def bilinear(points: DataFrame, df: DataFrame, key: str, row: str, col: str, values: Sequence[str], shape: tuple[int, int] | None = None) -> DataFrame:
    """(key, values) of ``df(r, c, ...)`` at fractional places. A point is sent to its four cells with
    their weights and summed after one equi join; cells that are absent count as 0. With a ``shape``,
    places outside take the nearest place of the raster."""
    y, x = F.col(row), F.col(col)
    if shape:
        y, x = (F.greatest(F.lit(0.0), F.least(v, F.lit(float(n - 1)))) for v, n in zip((y, x), shape, strict=True))
    r0, c0 = F.floor(y), F.floor(x)
    a, b = y - r0, x - c0
    corner = lambda dr, dc, w: F.struct((r0 + dr).cast("long").alias("r"), (c0 + dc).cast("int").alias("c"), w.alias("w"))
    four = F.array(corner(0, 0, (1 - a) * (1 - b)), corner(0, 1, (1 - a) * b), corner(1, 0, a * (1 - b)), corner(1, 1, a * b))
    spread = points.select(key, F.explode(four).alias("q")).select(key, "q.*")
    return spread.join(df, ["r", "c"]).groupBy(key).agg(*[F.sum(F.col(v) * F.col("w")).alias(v) for v in values])


def detrend_plane(stack: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """An extension: each image less its least-squares plane over (r, c). The plane comes from nine
    sums per image, combined on the map side; coordinates are centred for conditioning."""
    centre = stack.groupBy(*keys).agg(F.avg("r").alias("__r0"), F.avg("c").alias("__c0"), F.avg(value).alias("__v0"))
    moved = stack.join(centre, list(keys)).withColumns({"__x": F.col("r") - F.col("__r0"), "__y": F.col("c") - F.col("__c0")})
    product = lambda a, b: F.sum(F.col(a) * F.col(b))
    sums = moved.groupBy(*keys).agg(
        product("__x", "__x").alias("xx"), product("__x", "__y").alias("xy"), product("__y", "__y").alias("yy"), product("__x", value).alias("xv"), product("__y", value).alias("yv")
    )
    whole = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    slope_r = F.coalesce(F.try_divide(F.col("xv") * F.col("yy") - F.col("yv") * F.col("xy"), whole), F.lit(0.0))
    slope_c = F.coalesce(F.try_divide(F.col("yv") * F.col("xx") - F.col("xv") * F.col("xy"), whole), F.lit(0.0))
    planes = sums.select(*keys, slope_r.alias("__a"), slope_c.alias("__b"))
    flat = F.col(value) - F.col("__v0") - F.col("__a") * F.col("__x") - F.col("__b") * F.col("__y")
    return moved.join(planes, list(keys)).select(*stack.columns, flat.alias("__flat")).withColumn(value, F.col("__flat")).drop("__flat")


def write_store(stack: DataFrame, path: str, image: str, attributes: dict[str, object]) -> None:
    """A stack as one folder per image, rows in order, zstd; its attributes in a JSON file beside it."""
    ordered = stack.repartition(image).sortWithinPartitions(image, "r", "c")
    ordered.write.partitionBy(image).option("compression", "zstd").mode("overwrite").parquet(f"{path}/data")
    spark = stack.sparkSession
    spark.createDataFrame([(json.dumps(attributes),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/attributes")


def read_store(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, object]]:
    """(rows, attributes) of a store; a filter on the image prunes its folders."""
    return spark.read.parquet(f"{path}/data"), json.loads(spark.read.text(f"{path}/attributes").first()["value"])


def crop_filled(df: DataFrame, top: int, bottom: int, left: int, right: int, value: str, fill: float = 0.0) -> DataFrame:
    """(r, c, value) of a box, counted from its corner; cells that the raster doesn't have are ``fill``."""
    width = right - left
    flat = df.sparkSession.range((bottom - top) * width)
    cells = flat.select(F.expr(f"cast(id div {width} as int)").alias("r"), (F.col("id") % width).cast("int").alias("c"))
    inside = in_box(df, top, bottom, left, right).select((F.col("r") - top).cast("int").alias("r"), (F.col("c") - left).cast("int").alias("c"), value)
    return cells.join(inside, ["r", "c"], "left").withColumn(value, F.coalesce(value, F.lit(fill)))
