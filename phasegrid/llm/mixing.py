"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0..1, piecewise linear between knots. Its
integral is the source's share of all tokens. The token demand of a source up to time t is the
integral up to t, so a token at fraction m of the source's demand is trained at the time t where
the integral, scaled to 1 at the end, reaches m. Documents stand in a fixed pseudo-random order in
their source; their running token count gives m, and the inverted integral gives their position.

A source whose target exceeds its size is repeated: whole epochs first, then part of one. Documents
are taken whole, so the part of an epoch ends within one document of the target; the gap at its end
is filled with later, smaller documents of the same bucket, in at most ``FILL_ROUNDS`` passes over it.

Running counts are two-level: sums per (source, hash bucket) are aggregated first, their running sum
gives each bucket's start, and only rows of one bucket meet in one window. A source with a third of
all rows is thus dealt over many tasks; ``bucket_rows`` bounds the mean bucket.

Null texts have size 0, null is a source of its own and comes last. Reruns agree: the order depends
on the rows' values only, and rows that tie in all of them are alike. A text of any length is counted
whole. Repeated rows are documents of their own. One row per source reaches the driver. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasegrid.llm.shared import WORD, cut, listed, text_or_empty

FILL_ROUNDS = 4
Knots = Sequence[tuple[float, float]]
FLAT: Knots = ((0.0, 1.0), (1.0, 1.0))
#: For weights that fall: heavy sources come earlier, their schedules fall over time, the light ones rise.
CURRICULUM: Sequence[Knots] = (((0.0, 1.5), (1.0, 0.5)), FLAT, ((0.0, 0.5), (1.0, 1.5)))


def integral(knots: Knots) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False))


def targets(sizes: Sequence[int], weights: Sequence[float], limit: float = 3.0) -> list[float]:
    """Share sum(sizes) by weight; no target exceeds ``limit`` times its source's size, and the
    excess is shared again by weight among the others until none does."""
    total, out = float(sum(sizes)), [0.0] * len(sizes)
    free = [i for i in range(len(sizes)) if sizes[i] > 0 and weights[i] > 0]
    left = total
    while free:
        unit = left / sum(weights[i] for i in free)
        full = [i for i in free if weights[i] * unit > limit * sizes[i]]
        if not full:
            for i in free:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = limit * sizes[i]
        left -= sum(out[i] for i in full)
        free = [i for i in free if i not in set(full)]
    return out


def pieces(knots: Knots) -> list[tuple[float, float, float, float, float]]:
    """(m0, m1, t0, w0, slope) of each piece, scaled so that the integral over all is 1."""
    whole, at, out = integral(knots), 0.0, []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        part = (t1 - t0) * (w0 + w1) / 2 / whole
        if part > 0:
            out.append((at, at + part, t0, w0 / whole, (w1 - w0) / (t1 - t0) / whole))
            at += part
    return out


def inverse(m: Column, parts: Column) -> Column:
    """The time at which the scaled integral reaches ``m``: the root of w0·x + slope·x²/2 = m − m0."""
    piece = F.coalesce(F.get(F.filter(parts, lambda p: m < p["m1"]), F.lit(0)), F.element_at(parts, -1))
    rise = F.greatest(F.lit(0.0), m - piece["m0"])
    root = F.sqrt(F.greatest(F.lit(0.0), piece["w0"] * piece["w0"] + 2.0 * piece["slope"] * rise))
    return piece["t0"] + F.coalesce(F.try_divide(2.0 * rise, piece["w0"] + root), F.lit(0.0))


def cycle(weights: Sequence[float], n: int) -> list[float]:
    return [float(weights[i % len(weights)]) for i in range(n)]


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    schedules: Sequence[Knots] = (FLAT,),
    limit: float = 3.0,
    bucket_rows: int = 2_000,
) -> DataFrame:
    """One row per document of ``docs(doc_id, text, source)``: doc_id, source, size, source_size,
    target, copies, taken, position (of its first copy; null if it isn't taken) and demand, its
    fraction of the source's demand.

    The i-th source by code point has the i-th weight and the i-th schedule shape, repeating; the
    shape is scaled so that its integral is the source's target."""
    spark = docs.sparkSession
    sized = cut(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(F.col("doc_id").cast("long"), F.lit("order")).alias("h"),
        )
    )
    by_source = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    by_source.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["size"] for r in by_source]
    goal = targets(sizes, cycle(weights, len(sizes)), limit)
    plan = []
    for i, row in enumerate(by_source):
        epochs = min(int(limit), int(goal[i] // row["size"])) if row["size"] else 0
        rest = max(0.0, goal[i] - epochs * row["size"]) if epochs < limit else 0.0
        parts = [dict(zip(("m0", "m1", "t0", "w0", "slope"), p, strict=True)) for p in pieces(schedules[i % len(schedules)])]
        plan.append((row["source"], row["source"] is None, row["size"], goal[i], epochs, rest, parts))
    kind = (
        "p_source string, p_null boolean, source_size long, target double, epochs int, rest double, "
        "parts array<struct<m0: double, m1: double, t0: double, w0: double, slope: double>>"
    )
    plan = listed(spark, plan, kind).withColumn("p_source", F.coalesce("p_source", F.lit("")))
    bits = max(0, math.ceil(math.log2(max(1, sum(r["n"] for r in by_source) / bucket_rows))))
    bucket = F.shiftright(F.col("h"), 64 - bits) if bits else F.lit(0).cast("long")
    keyed = sized.select(
        "doc_id", "source", "size", "h", F.coalesce("source", F.lit("")).alias("p_source"), F.col("source").isNull().alias("p_null"), bucket.alias("bucket")
    )
    key = ["p_source", "p_null", "bucket"]
    per_bucket = keyed.groupBy(*key).agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("p_source", "p_null").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select(*key, F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("bucket_start"))
    starts = starts.join(plan, ["p_source", "p_null"])
    rows = keyed.join(starts, key)

    in_bucket = Window.partitionBy(*key)
    in_order = in_bucket.orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.col("bucket_start") + F.sum("size").over(in_order))
    rows = rows.withColumn("start", F.col("end") - F.col("size"))
    edge = (F.col("start") < F.col("rest")) & (F.col("end") > F.col("rest"))
    rows = rows.withColumn("edge", edge)
    rows = rows.withColumn("edge_start", F.max(F.when(edge, F.col("start"))).over(in_bucket))
    rows = rows.withColumn("edge_size", F.max(F.when(edge, F.col("size"))).over(in_bucket))
    rows = rows.withColumn("gap", F.col("rest") - F.col("edge_start"))
    # Rounds of filling: what still fits the gap, in order, until the next one doesn't.
    rows = rows.withColumns({"filled": F.lit(False), "left": F.col("gap")})
    for _ in range(FILL_ROUNDS):
        fits = (F.col("start") > F.col("edge_start")) & ~F.col("filled") & (F.col("size") > 0) & (F.col("size") <= F.col("left"))
        rows = rows.withColumn("fits", F.coalesce(fits, F.lit(False)))
        rows = rows.withColumn("fill_end", F.sum(F.when(F.col("fits"), F.col("size")).otherwise(0)).over(in_order))
        rows = rows.withColumn("now", F.coalesce(F.col("fits") & (F.col("fill_end") <= F.col("left")), F.lit(False)))
        rows = rows.withColumn("left", F.col("left") - F.sum(F.when(F.col("now"), F.col("size")).otherwise(0)).over(in_bucket))
        rows = rows.withColumn("filled", F.col("filled") | F.col("now"))
    whole_edge = F.coalesce(F.col("edge_size") - F.col("gap") < F.col("left"), F.lit(False))
    extra = (F.col("end") <= F.col("rest")) | (F.col("edge") & whole_edge) | (F.col("filled") & ~whole_edge)
    rows = rows.withColumn("copies", F.when(F.col("size") > 0, F.col("epochs") + F.when(extra, 1).otherwise(0)).otherwise(0))
    rows = rows.withColumn("demand", F.coalesce(F.try_divide(F.col("start").cast("double"), F.col("target")), F.lit(0.0)))
    at = F.when(F.col("copies") > 0, F.least(F.lit(1.0), inverse(F.least(F.lit(1.0), F.col("demand")), F.col("parts"))))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", F.col("copies").cast("int").alias("copies"),
        (F.col("size") * F.col("copies")).alias("taken"), at.alias("position"), "demand",
        F.try_divide(F.col("source_size").cast("double"), F.col("target")).alias("epoch_demand"), "parts", "h",
    )


def with_positions(mixed: DataFrame) -> DataFrame:
    """Add ``positions``: that of each copy, in order; at most ``limit`` of them."""

    def of(copy: Column) -> Column:
        m = F.least(F.lit(1.0), F.col("demand") + copy * F.col("epoch_demand"))
        return F.least(F.lit(1.0), inverse(m, F.col("parts")))

    return mixed.withColumn("positions", F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), of)))


def training_order(mixed: DataFrame) -> DataFrame:
    """A row for each copy that is trained on, range-sorted by position."""
    copies = with_positions(mixed).select("doc_id", "source", "size", F.posexplode("positions").alias("copy", "position"))
    return copies.orderBy("position", "doc_id", "copy")
