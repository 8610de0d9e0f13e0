"""From unwrapped interferogram stacks to velocities and displacement series.

Observations are rows (pixel keys, date1, date2, i1, i2, days, u). Screening, stacking and models
with few parameters are aggregates per pixel; models with one parameter per interval are solved in
NumPy over pixel tubes, a batch of pixels per call, so no pixel is a Python call of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WAVELENGTH = 0.055465763
YEAR = 365.25
SMALL = 1e-6


def form_pairs(phases: DataFrame, pairs: DataFrame, px: Sequence[str], phase: str = "phase") -> DataFrame:
    """u = phase(date2) − phase(date1) for each pair whose dates a pixel has; ``phases`` has one row per
    pixel and date.

    A pixel's phases are gathered once (a value per date), and the pairs, one row holding the graph,
    are exploded against them. So the pixels are shuffled once, before the pairs multiply them, and
    what follows by pixel needs no further shuffle."""
    graph = pairs.agg(F.collect_list(F.struct("date1", "date2", "i1", "i2", "days")).alias("__pairs"))
    series = phases.groupBy(*px).agg(F.map_from_entries(F.collect_list(F.struct("date", phase))).alias("__m"))
    rows = series.crossJoin(F.broadcast(graph)).select(*px, "__m", F.explode("__pairs").alias("p"))  # one row by construction
    u = F.try_element_at("__m", F.col("p.date2")) - F.try_element_at("__m", F.col("p.date1"))
    return rows.select(*px, "p.*", u.alias("u")).where("u is not null")


def pair_tubes(phases: DataFrame, pairs: DataFrame, px: Sequence[str], phase: str = "phase") -> DataFrame:
    """(px, u): the differences of all pairs in (i1, i2) order as one array, NaN where a date is
    missing. One shuffle by pixel; the pairs never become rows."""
    graph = pairs.agg(F.array_sort(F.collect_list(F.struct("i1", "i2", "date1", "date2"))).alias("__pairs"))
    series = phases.groupBy(*px).agg(F.map_from_entries(F.collect_list(F.struct("date", phase))).alias("__m"))
    gap = lambda p: F.try_element_at("__m", p["date2"]) - F.try_element_at("__m", p["date1"])
    tube = F.transform("__pairs", lambda p: F.coalesce(gap(p), F.lit(float("nan"))))
    return series.crossJoin(F.broadcast(graph)).select(*px, tube.alias("u"))  # one row by construction


def subtract_reference(obs: DataFrame, reference: DataFrame, image: Sequence[str]) -> DataFrame:
    """u less the image's reference phase."""
    return obs.join(reference, list(image)).withColumn("u", F.col("u") - F.col("ref")).drop("ref")


def interval_velocity(obs: DataFrame, px: Sequence[str]) -> DataFrame:
    """(px, k, v): phase over days, summed over the pairs that span interval k. Intervals are
    exploded from the pair, so no join is needed."""
    spanned = obs.where("i2 > i1").withColumn("k", F.explode(F.sequence(F.col("i1"), F.col("i2") - 1)))
    summed = spanned.groupBy(*px, "k").agg(F.sum("u").alias("u"), F.sum(F.abs("days").cast("double")).alias("bl"))
    return summed.select(*px, "k", (F.col("u") / (F.col("bl") + SMALL)).alias("v"))


def mad_outliers(velocity: DataFrame, px: Sequence[str], scale: float, floor: float = 0.0, digits: int = 9) -> DataFrame:
    """(px, k, v, dev, mad, outlier): the centre is the median of abs(v), deviations are from signed
    v and rounded, since on clean data rounding alone would decide. Both medians are windows over
    the pixel's intervals, one per date."""
    pixel = Window.partitionBy(*px)
    dev = velocity.withColumn("med", F.median(F.abs("v")).over(pixel)).withColumn("dev", F.round(F.abs(F.col("v") - F.col("med")), digits))
    dev = dev.withColumn("mad", F.round(F.median("dev").over(pixel), digits))
    limit = F.greatest(F.round(F.col("mad") * scale, digits), F.lit(floor))
    return dev.select(*px, "k", "v", "dev", "mad", (F.col("dev") > limit).alias("outlier"))


def flagged(obs: DataFrame, px: Sequence[str], scale: float, floor: float = 0.0) -> DataFrame:
    """Adds ``keep``: no interval that the observation spans is an outlier. A pixel's outliers are a
    list of at most one number per date, joined by pixel."""
    outliers = mad_outliers(interval_velocity(obs, px), px, scale, floor).where("outlier")
    bad = outliers.groupBy(*px).agg(F.collect_list("k").alias("__bad"))
    hit = F.exists("__bad", lambda k: (k >= F.col("i1")) & (k < F.col("i2")))
    return obs.join(bad, list(px), "left").withColumn("keep", ~F.coalesce(hit, F.lit(False))).drop("__bad")


def screened(obs: DataFrame, px: Sequence[str], scale: float, floor: float = 0.0) -> DataFrame:
    """The observations that ``flagged`` keeps."""
    return flagged(obs, px, scale, floor).where("keep").drop("keep")


def stack_velocity(obs: DataFrame, px: Sequence[str], scale: float = 0.0, floor: float = 0.0, wavelength: float = WAVELENGTH, empty_as_null: bool = False) -> DataFrame:
    """(px, n, velocity in metres a year). A pixel whose observations are all screened out has
    velocity 0, or null by option."""
    rows = flagged(obs, px, scale, floor) if scale > 0 else obs.withColumn("keep", F.lit(True))
    pick = lambda c: F.sum(F.when(F.col("keep"), F.col(c).cast("double")))
    made = rows.groupBy(*px).agg(F.count_if("keep").alias("n"), pick("u").alias("u"), pick("days").alias("bl"))
    v = F.col("u") / (F.col("bl") + SMALL) * (wavelength / (4 * math.pi) * YEAR)
    return made.select(*px, "n", (v if empty_as_null else F.coalesce(v, F.lit(0.0))).alias("velocity"))


def sbas_linear(obs: DataFrame, px: Sequence[str], weight: Column | None = None, regularisation: float = 0.0) -> DataFrame:
    """(px, rate): the weighted least-squares rate per day."""
    w, g = (F.lit(1.0) if weight is None else weight), F.col("days").cast("double")
    made = obs.groupBy(*px).agg(F.sum(w * g * F.col("u")).alias("gd"), F.sum(w * g * g).alias("gg"))
    return made.select(*px, F.try_divide(F.col("gd"), F.col("gg") + regularisation).alias("rate"))


def _det3(m: list[list[Column]]) -> Column:
    a, b, c = m
    return a[0] * (b[1] * c[2] - b[2] * c[1]) - a[1] * (b[0] * c[2] - b[2] * c[0]) + a[2] * (b[0] * c[1] - b[1] * c[0])


def sbas_seasonal(obs: DataFrame, px: Sequence[str], t1: Column, t2: Column, regularisation: float = 1e-3, period: float = YEAR) -> DataFrame:
    """(px, rate per year, sine, cosine): linear and annual terms by Cramer's rule on the moments.
    ``t1`` and ``t2`` are the dates' days; the day column is scaled to years for conditioning."""
    turn = 2 * math.pi / period
    rows = obs.select(
        *px, "u", ((t2 - t1) / period).alias("g0"), (F.sin(t2 * turn) - F.sin(t1 * turn)).alias("g1"), (F.cos(t2 * turn) - F.cos(t1 * turn)).alias("g2")
    )
    moments = [F.sum(F.col(f"g{i}") * F.col(f"g{j}")).alias(f"m{i}{j}") for i in range(3) for j in range(i, 3)]
    made = rows.groupBy(*px).agg(*moments, *[F.sum(F.col(f"g{i}") * F.col("u")).alias(f"d{i}") for i in range(3)])
    m = [[F.col(f"m{min(i, j)}{max(i, j)}") + (regularisation if i == j else 0.0) for j in range(3)] for i in range(3)]
    d = [F.col(f"d{i}") for i in range(3)]
    whole = _det3(m)
    solved = [_det3([[d[i] if j == k else m[i][j] for j in range(3)] for i in range(3)]) / whole for k in range(3)]
    return made.select(*px, solved[0].alias("rate"), solved[1].alias("sine"), solved[2].alias("cosine"))


def cumulative(velocity: DataFrame, steps: DataFrame, px: Sequence[str]) -> DataFrame:
    """(px, k, disp): 0 at the first date, then the running sum of v · dt."""
    joined = velocity.join(steps.select("k", "dt"), "k")
    order = Window.partitionBy(*px).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(*px, (F.col("k") + 1).alias("idx"), F.sum(F.col("v") * F.col("dt")).over(order).alias("disp"))


def seasonal_series(model: DataFrame, indexed: DataFrame, px: Sequence[str], wavelength: float = WAVELENGTH, period: float = YEAR) -> DataFrame:
    """(px, idx, disp) in metres from the seasonal model; ``indexed`` has a row per date."""
    day = F.col("days").cast("double")
    turn = 2 * math.pi / period
    phase = F.col("rate") * day / period + F.col("sine") * F.sin(day * turn) + F.col("cosine") * F.cos(day * turn)
    return model.crossJoin(F.broadcast(indexed.select("idx", "days"))).select(*px, "idx", (phase * (wavelength / (4 * math.pi))).alias("disp"))


def _solve(tubes: DataFrame, px: Sequence[str], solve, width: int) -> DataFrame:
    """Map batches of tubes (px..., u) to parameter arrays."""
    names = list(px)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            u = np.array(batch.column("u").to_pylist(), dtype=np.float64)
            x = solve(u)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], lists], names=[*names, "x"])

    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tubes.schema.fields if f.name in names)
    return tubes.select(*names, "u").mapInArrow(run, f"{keys}, x array<double>")


def least_squares(u: np.ndarray, g: np.ndarray, regularisation: float = 0.0) -> np.ndarray:
    """(pixels, parameters) from (pixels, pairs); NaN observations have weight 0. Pixels with the same
    gaps share a factorisation; a singular one falls back to the least-norm solution."""
    weight = (~np.isnan(u)).astype(np.float64)
    d = np.nan_to_num(u)
    out = np.zeros((len(u), g.shape[1]))
    patterns, inverse = np.unique(weight, axis=0, return_inverse=True)
    inverse = np.asarray(inverse).ravel()
    for number, w in enumerate(patterns):
        rows = np.flatnonzero(inverse == number)
        normal = g.T @ (w[:, None] * g) + regularisation * np.eye(g.shape[1])
        right = (d[rows] * w) @ g
        if np.linalg.matrix_rank(normal) == len(normal):
            out[rows] = np.linalg.solve(normal, right.T).T
        else:
            out[rows] = right @ np.linalg.pinv(normal).T
    return out


def least_absolute(u: np.ndarray, g: np.ndarray, regularisation: float = 0.0, rho: float = 0.4, alpha: float = 1.0, rounds: int = 20) -> np.ndarray:
    """(pixels, parameters): L1 fit by the alternating direction method of multipliers."""
    inverse = np.linalg.pinv(g.T @ g + regularisation * np.eye(g.shape[1]))
    gap = np.isnan(u.T)
    d = np.nan_to_num(u.T)
    kappa = np.where(gap, 0.0, 1.0 / rho)
    z, dual, x = np.zeros_like(d), np.zeros_like(d), np.zeros((g.shape[1], d.shape[1]))
    for _ in range(rounds):
        x = inverse @ (g.T @ (d + z - dual))
        fit = alpha * (g @ x) + (1 - alpha) * (z + d)
        rest = fit - d + dual
        z = np.maximum(0, rest - kappa) - np.maximum(0, -rest - kappa)
        z = np.where(gap, rest, z)
        dual = dual + fit - z - d
    return x.T


def sbas_ls(tubes: DataFrame, px: Sequence[str], b: np.ndarray, regularisation: float = 0.0) -> DataFrame:
    """(px, x): the velocity of each interval by least squares. ``b`` has one row per pair."""
    return _solve(tubes, px, lambda u: least_squares(u, b, regularisation), b.shape[1])


def sbas_l1(tubes: DataFrame, px: Sequence[str], b: np.ndarray, regularisation: float = 0.0, rho: float = 0.4, alpha: float = 1.0, rounds: int = 20) -> DataFrame:
    """(px, x): the velocity of each interval by least absolute deviations."""
    return _solve(tubes, px, lambda u: least_absolute(u, b, regularisation, rho, alpha, rounds), b.shape[1])


def sbas_model(tubes: DataFrame, px: Sequence[str], design: np.ndarray, regularisation: float = 0.0) -> DataFrame:
    """(px, x): any linear model with a shared design, such as seasonal ones with several terms."""
    return _solve(tubes, px, lambda u: least_squares(u, design, regularisation), design.shape[1])


def interval_series(solved: DataFrame, px: Sequence[str], dt: Sequence[float], wavelength: float = WAVELENGTH) -> DataFrame:
    """Products of one solution, as projections of it: (px, displacement array, cumulative, velocity
    in metres a year), so the solver runs once."""
    days = F.array(*[F.lit(float(x)) for x in dt])
    steps = F.zip_with("x", days, lambda v, t: v * t * (wavelength / (4 * math.pi)))
    # Prefix sums by slices are quadratic in dates, which are a few hundred.
    series = F.concat(
        F.array(F.lit(0.0)),
        F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.aggregate(F.slice(steps, F.lit(1), i), F.lit(0.0), lambda a, v: a + v)),
    )
    out = solved.withColumn("displacement", series)
    last = F.element_at("displacement", -1)
    return out.select(*px, "displacement", last.alias("cumulative"), (last / float(sum(dt)) * YEAR).alias("velocity"))
