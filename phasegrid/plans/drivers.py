"""The processing steps over scene tables, each a lazy DataFrame built from the operators.

Tables: images (date, r, c, re, im), pairs (date1, date2, days), interferograms (date1, date2, r, c,
re, im), unwrapped stacks (date1, date2, r, c, u), masks (r, c, valid), delays (date, r, c, delay).
Steps skip pairs that a manifest already lists, so a rerun does what is missing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasegrid.config import Config, Filter, TimeSeries
from phasegrid.functions import cplx
from phasegrid.functions.geo import Grid
from phasegrid.operators import catalog, interferograms, orbit, raster, similarity, timeseries, unwrapping
from phasegrid.operators.joins import nearest_boxes, pairs_within, small
from phasegrid.plans import network

PAIR = ["date1", "date2"]
PX = ["r", "c"]


def slc_pairs(images: DataFrame, days: tuple[int, int]) -> DataFrame:
    return pairs_within(images.select("date").distinct(), "date", *days)


def geocode_scenes(
    terrain: DataFrame, bursts: DataFrame, grid: Grid, done: DataFrame | None = None, heights: tuple[float, float] = (0.0, 10_000.0), guard: int = 5, tile: int = 256
) -> DataFrame:
    """(date, iw, burst, r, c, re, im) of all bursts whose date isn't done, on the cells of
    ``terrain(r, c, height)`` that they may cover and have data for.

    ``bursts`` has (date, iw, burst) and the columns of ``orbit.BURST``. Cells and burst areas meet by
    tiles of ``tile``² cells, so no join is by range."""
    todo = catalog.todo(bursts, done, ["date"]) if done is not None else bursts
    ids = ["date", "iw", "burst"]
    areas = orbit.burst_areas(todo, ids, heights)
    boxes = areas.select(*ids, grid.box(*[F.col(n) for n in orbit.SIDES]).alias("b")).select(*ids, "b.*").where("top < bottom and left < right")
    spread = lambda low, high: F.explode(F.sequence(F.expr(f"{low} div {tile}"), F.expr(f"({high} - 1) div {tile}")))
    boxes = boxes.withColumn("tr", spread("top", "bottom")).withColumn("tc", spread("left", "right"))
    cells = terrain.select("r", "c", "height", F.expr(f"cast(r as bigint) div {tile}").alias("tr"), F.expr(f"cast(c as bigint) div {tile}").alias("tc"))
    met = cells.join(boxes, ["tr", "tc"]).where("r >= top and r < bottom and c >= left and c < right")
    points = met.select(*ids, "r", "c", "height", grid.lat(F.col("r")).alias("lat"), grid.lon(F.col("c")).alias("lon"))
    out = orbit.geocode_bursts(points, todo, ids, guard)
    return out.where("re != 0 or im != 0").select(*ids, "r", "c", "re", "im")


def frames(pixels: DataFrame) -> DataFrame:
    """(date, r, c, re, im) of ``geocode_scenes``: in a subswath the first burst with data wins, over
    subswaths the highest."""
    swaths = interferograms.stitch_raw(pixels, ["date", "iw"], "burst")
    return interferograms.stitch_frame(swaths, ["date"])


def interfere(images: DataFrame, pairs: DataFrame, rows: int, cols: int, looks: tuple[int, int], done: DataFrame | None = None) -> DataFrame:
    """Multilooked interferograms of all pairs that aren't done. Full-resolution pixels are shuffled
    once, by look block; a pixel's dates meet there, and the pairs of a block are summed in place."""
    wanted = catalog.todo(pairs, done, PAIR) if done is not None else pairs
    cells = raster.blocks(images, rows, cols, looks).repartition("br", "bc")
    series = cells.groupBy("br", "bc", "r", "c").agg(F.collect_list(F.struct("date", "re", "im")).alias("z"))
    both = series.select("br", "bc", "z", F.explode("z").alias("a")).select("br", "bc", "a", F.explode("z").alias("b"))
    both = both.select("br", "bc", F.col("a.date").alias("date1"), F.col("b.date").alias("date2"), "a", "b")
    re, im = cplx.mul_conj((F.col("a.re"), F.col("a.im")), (F.col("b.re"), F.col("b.im")))
    size = float(looks[0] * looks[1])
    looked = both.join(small(wanted.select(*PAIR)), PAIR).groupBy(*PAIR, "br", "bc").agg((F.sum(re) / size).alias("re"), (F.sum(im) / size).alias("im"))
    return looked.select(*PAIR, F.col("br").alias("r"), F.col("bc").alias("c"), "re", "im")


def interfere_bursts(
    bursts: DataFrame, pixels: DataFrame, pairs: DataFrame, rows: int, cols: int, looks: tuple[int, int], done: DataFrame | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Multilooked interferograms from geocoded bursts: match, form, stitch subswaths, stitch the frame.

    ``bursts`` has (keys, date, iw, burst, acquisition, top, bottom), a row per burst, and ``pixels``
    (keys, date, iw, burst, r, c, re, im); ``keys`` name the frame. Each burst of the first date is
    paired with the nearest of the second in its subswath. The phase offset of a subswath is carried
    where the acquisition of either date changes; the highest subswath with data wins."""
    wanted = small((catalog.todo(pairs, done, PAIR) if done is not None else pairs).select(*PAIR))
    frame = [*PAIR, *keys]
    first = bursts.withColumnRenamed("date", "date1").join(wanted, "date1")
    second = bursts.withColumnRenamed("date", "date2").join(wanted, "date2")
    matched = nearest_boxes(first, second, [*frame, "iw"], "burst", "burst")
    acquired = lambda side, name: side.select(*frame, "iw", F.col("burst").alias(f"{name}_id"), F.col("acquisition").alias(f"{name}_acq"), F.col("top").alias(f"{name}_top"))
    matched = matched.join(acquired(first, "l"), [*frame, "iw", "l_id"]).join(acquired(second, "r"), [*frame, "iw", "r_id"])
    matched = matched.withColumn("acquisition", F.concat_ws("|", "l_acq", "r_acq"))
    one = pixels.withColumnsRenamed({"date": "date1", "burst": "l_id"}).join(matched, ["date1", *keys, "iw", "l_id"])
    two = pixels.withColumnsRenamed({"date": "date2", "burst": "r_id"}).join(matched.select(*frame, "iw", "l_id", "r_id"), ["date2", *keys, "iw", "r_id"])
    ids = [*frame, "iw", "l_id"]
    ifg = interferograms.form(one, two, [*ids, "r", "c"])
    ifg = ifg.join(matched.select(*ids, F.struct("l_top", "l_id").alias("ord"), "acquisition"), ids)
    swaths = interferograms.stitch_subswath_pixels(ifg, [*frame, "iw"])
    whole = interferograms.stitch_frame(swaths, frame)
    out = interferograms.looked(whole, rows, cols, looks, keys=frame)
    return out.select(*frame, F.col("br").alias("r"), F.col("bc").alias("c"), "re", "im")


def scatterers(stack: DataFrame, candidates: DataFrame, rows: int, cols: int, neighbours: int, radii: tuple[int, int], least_median: float, least_max: float) -> DataFrame:
    """(r, c, median, ps, max, selected) of ``candidates(r, c, ps)`` over ``stack(ifg, r, c, re, im)``.

    The median similarity with the candidates decides which pixels are scatterers (candidates below
    the threshold are none); the largest similarity with these then admits others. No pixel has a
    limit but ``neighbours``, the number of nearest scatterers it is compared with."""
    spirals = similarity.offsets(stack.sparkSession, *radii)
    pairs = similarity.pair_similarity(stack, candidates.where("ps = 1"), spirals, rows, cols, neighbours)
    median = similarity.median_similarity(pairs, candidates).withColumnRenamed("sim", "median")
    middle = candidates.join(median, PX).select(*PX, "median", similarity.updated(F.col("ps"), F.col("median"), least_median, True).alias("ps"))
    again = similarity.pair_similarity(stack, middle.where("ps = 1"), spirals, rows, cols, neighbours)
    best = similarity.max_similarity(again, middle).withColumnRenamed("sim", "max")
    return middle.join(best, PX).withColumn("selected", similarity.updated(F.col("ps"), F.col("max"), least_max, False))


def coherence(images: DataFrame, ifgs: DataFrame, rows: int, cols: int, looks: tuple[int, int], above_one: str = "null") -> DataFrame:
    amps = raster.amplitude_looks(images, rows, cols, looks, ["date"])
    amps = amps.select("date", F.col("br").alias("r"), F.col("bc").alias("c"), "amp")
    return interferograms.coherence(ifgs, amps, above_one)


def integrity(images: DataFrame, max_deviation: float) -> tuple[DataFrame, DataFrame]:
    """(dates with their data counts and flags, validity mask)."""
    data = (F.col("re") != 0) | (F.col("im") != 0)
    return raster.completeness(images, "date", data, max_deviation), raster.validity_mask(images, data)


def phase_correction(ifgs: DataFrame, delays: DataFrame, wavelength: float, rows: int, cols: int, options: Filter, flip: bool = False) -> DataFrame:
    """Delay correction, then the adaptive filter."""
    corrected = interferograms.correct_wrapped(ifgs, delays, wavelength, flip=flip)
    return interferograms.goldstein(corrected.select(*PAIR, *PX, "re", "im"), rows, cols, options.window, options.alpha, PAIR)


def batch_unwrap(ifgs: DataFrame, done: DataFrame | None = None, shape: tuple[int, int] | None = None, coherence: DataFrame | None = None) -> DataFrame:
    """(date1, date2, r, c, u): tiles of each interferogram weighted by ``coherence(date1, date2, r, c,
    coh)``, levelled to one another; without a ``shape`` one tile. Cells without data are masked to 0."""
    todo = catalog.todo(ifgs, done, PAIR) if done is not None else ifgs
    phase = todo.select(*PAIR, *PX, cplx.angle(cplx.pair()).alias("phase"))
    if coherence is not None:
        phase = phase.join(coherence.select(*PAIR, *PX, F.coalesce("coh", F.lit(0.0)).alias("coh")), [*PAIR, *PX])
    weight = "coh" if coherence is not None else None
    out = unwrapping.tiled_unwrap(phase, PAIR, shape, coherence=weight) if shape else unwrapping.unwrap(phase, PAIR, coherence=weight)
    out = out.withColumnRenamed("unwrapped", "u")
    return raster.zero_mask(out, todo.select(*PAIR, *PX, "re", "im"), "u", [*PAIR, *PX])


def time_series(stack: DataFrame, shape: tuple[int, int], options: TimeSeries, mask: DataFrame | None = None, wavelength: float = timeseries.WAVELENGTH) -> DataFrame:
    """Velocity (and for the series methods displacement and cumulative) per pixel.

    The reference phase is subtracted first; masked pixels aren't solved and get a NaN velocity. Dates and pairs are graph
    tables; the solver methods collect them, and only them, to build their design matrices."""
    if mask is not None:
        solved = time_series(stack.join(mask.where("valid").select(*PX), PX), shape, options, None, wavelength)
        return mask.select(*PX).distinct().join(solved, PX, "left").withColumn("velocity", F.coalesce("velocity", F.lit(float("nan"))))
    dates = network.date_index(stack.select(F.col("date1").alias("date")).union(stack.select(F.col("date2").alias("date"))))
    days = F.datediff("date2", "date1")
    pairs = network.network(stack.select(*PAIR).distinct().withColumn("days", days), dates)
    reference = raster.reference_phase(
        stack.withColumn("img", F.struct(*PAIR)), "img", "u", F.lit(True), (options.reference_row, options.reference_col), tuple(options.reference_window), shape
    )
    reference = reference.select("img.*", "ref")
    obs = timeseries.subtract_reference(stack, reference, PAIR).join(small(pairs), PAIR)
    if options.method == "stack":
        return timeseries.stack_velocity(obs, PX, options.mad_scale, wavelength=wavelength)
    kept = timeseries.screened(obs, PX, options.mad_scale) if options.mad_scale > 0 else obs
    factor = wavelength / (4 * 3.141592653589793)
    if options.method == "linear":
        rate = timeseries.sbas_linear(kept, PX, regularisation=options.regularisation)
        return rate.select(*PX, (F.col("rate") * factor * timeseries.YEAR).alias("velocity"))
    graph = [tuple(r) for r in pairs.select("i1", "i2").orderBy("i1", "i2").collect()]
    at = [r["days"] for r in dates.orderBy("idx").collect()]
    place = {p: k for k, p in enumerate(graph)}
    order = stack.sparkSession.createDataFrame([(*p, k) for p, k in place.items()], "i1 int, i2 int, ord int")
    full = kept.select(*PX, "i1", "i2", "u").join(small(order), ["i1", "i2"])
    tubes = full.groupBy(*PX).agg(F.map_from_entries(F.collect_list(F.struct("ord", "u"))).alias("m"))
    tubes = tubes.select(*PX, F.transform(F.sequence(F.lit(0), F.lit(len(graph) - 1)), lambda k: F.coalesce(F.get(F.array(F.try_element_at("m", k)), F.lit(0)), F.lit(float("nan")))).alias("u"))
    _, design = network.matrices(graph, at)
    penalty = options.regularisation * float((design**2).sum())
    if options.method == "seasonal":
        model = network.seasonal_design(graph, at, options.seasonal_terms)
        solved = timeseries.sbas_model(tubes, PX, model, options.regularisation)
        return solved.select(*PX, "x", (F.element_at("x", 1) * factor * timeseries.YEAR).alias("velocity"))
    if options.method == "ls":
        solved = timeseries.sbas_ls(tubes, PX, design, penalty)
    else:
        solved = timeseries.sbas_l1(tubes, PX, design, penalty, options.rho, options.alpha, options.rounds)
    return timeseries.interval_series(solved, PX, [b - a for a, b in zip(at, at[1:], strict=False)], wavelength)


def per_path(scenes: DataFrame, base: Config) -> list[tuple[int, dict]]:
    """One configuration per path of a catalogue (a row per path, so it fits the driver)."""
    out = []
    for row in catalog.path_summary(scenes, "path", "frame", "direction", "scene").orderBy("path").collect():
        made = asdict(base)
        made["io"] = {k: f"path{row['path']}/{v}" if v else v for k, v in made["io"].items()}
        out.append((row["path"], made))
    return out


