"""The steps from images to velocity, through the command line and the functions."""

import math

import numpy as np
import pytest
import yaml
from pyspark.sql import functions as F

from phasegrid import __main__ as cli
from phasegrid import config
from phasegrid.operators.timeseries import WAVELENGTH, YEAR
from phasegrid.plans import drivers

DATES = [f"2020-{m:02d}-{d:02d}" for m, d in ((1, 1), (1, 13), (1, 25), (2, 6), (2, 18), (3, 1))]


@pytest.fixture(scope="module")
def images(spark):
    """A 16 × 12 scene whose phase grows by 0.004 rad a day per row."""
    days = [0, 12, 24, 36, 48, 60]
    rows = []
    for date, day in zip(DATES, days, strict=True):
        for r in range(16):
            for c in range(12):
                p = 0.004 * day * (r // 4)
                rows.append((date, r, c, math.cos(p), math.sin(p)))
    frame = spark.createDataFrame(rows, "date string, r long, c int, re double, im double")
    return frame.withColumn("date", F.to_date("date")).cache()


@pytest.mark.parametrize("method", config.METHODS)
def test_images_to_velocity(spark, images, method):
    pairs = drivers.slc_pairs(images, (6, 30))
    assert pairs.count() == 9
    ifgs = drivers.interfere(images, pairs, 16, 12, (2, 2)).cache()
    assert ifgs.count() == 9 * 8 * 6
    assert drivers.interfere(images, pairs, 16, 12, (2, 2), done=pairs).count() == 0
    stack = drivers.batch_unwrap(ifgs)
    options = config.TimeSeries(method=method, regularisation=0.0 if method != "seasonal" else 1e-9, reference_row=0, reference_col=0, reference_window=[1, 1], rounds=50)
    out = drivers.time_series(stack, (8, 6), options)
    got = {(x["r"], x["c"]): x["velocity"] for x in out.collect()}
    assert len(got) == 48
    if method == "seasonal":  # sixty days can't tell a trend from a year's wave
        assert all(np.isfinite(v) for v in got.values())
        return
    for (r, _), v in got.items():
        assert v == pytest.approx(0.004 * (r // 2) * WAVELENGTH / (4 * math.pi) * YEAR, abs=1e-6)


def test_coherence_integrity_and_correction(spark, images):
    pairs = drivers.slc_pairs(images, (6, 13))
    ifgs = drivers.interfere(images, pairs, 16, 12, (2, 2))
    coh = drivers.coherence(images, ifgs, 16, 12, (2, 2), "clip").collect()
    assert len(coh) == 5 * 48 and all(x["coherence"] == pytest.approx(1.0) for x in coh)
    dates, mask = drivers.integrity(images.where("not (date = '2020-01-25' and r < 8)"), 0.1)
    assert [str(x["date"]) for x in dates.where("flagged").collect()] == ["2020-01-25"]
    assert mask.where("valid").count() == 0 or mask.count() == 192
    delays = images.select("date", "r", "c").where("r < 8 and c < 6").withColumn("delay", F.lit(0.01))
    fixed = drivers.phase_correction(ifgs, delays, WAVELENGTH, 8, 6, config.Filter(window=8, alpha=0.2))
    assert fixed.count() == 5 * 48


def test_command_line(spark, images, tmp_path):
    path = str(tmp_path / "c.yml")
    assert cli.main(["init", path]) == 0
    made = yaml.safe_load(open(path))
    made["looks"] = {"rows": 2, "cols": 2}
    made["pairs"]["max_days"] = 30
    made["timeseries"]["reference_window"] = [1, 1]
    yaml.safe_dump(made, open(path, "w"))
    images.write.parquet(str(tmp_path / "scenes" / "images"))
    size = ["--rows", "16", "--cols", "12"]
    for command in ("integrity", "slcpairs", "interfere", "coherence", "unwrap", "timeseries"):
        assert cli.main([command, path, *size]) == 0
    assert spark.read.parquet(str(tmp_path / "timeseries")).count() == 48
    spark.range(48).selectExpr("int(id div 6) AS r", "int(id % 6) AS c", "1 AS ps").write.parquet(str(tmp_path / "candidates"))
    chosen = ["--candidates", str(tmp_path / "candidates"), "--output", str(tmp_path / "chosen"), "--radii", "0", "3"]
    assert cli.main(["scatterers", path, *size, *chosen]) == 0
    chosen = spark.read.parquet(str(tmp_path / "chosen")).collect()
    assert len(chosen) == 48 and all(x["selected"] == 1 and x["median"] > 0.9 for x in chosen)
    scenes = spark.createDataFrame([(5, 1, "ASCENDING", "a"), (5, 2, "ASCENDING", "b"), (7, 1, "DESCENDING", "c")], "path int, frame int, direction string, scene string")
    scenes.write.parquet(str(tmp_path / "catalogue"))
    assert cli.main(["subconfig", path, "--scenes", str(tmp_path / "catalogue")]) == 0
    assert config.load(str(tmp_path / "path5.yml")).io.output.endswith("path5/timeseries")


def test_scenes_are_geocoded_burst_by_burst(spark, sf):
    """Every frame cell has the value that its burst gives alone; done dates are left out."""
    from phasegrid.functions import geo
    from phasegrid.operators import orbit
    from phasegrid.plans.queries import circular_orbit

    o = circular_orbit()
    vectors = [[float(t), *map(float, x), *map(float, v)] for t, x, v in zip(o.t, o.x, o.v, strict=True)]
    rng = np.random.default_rng(5)
    data = {k: rng.normal(size=(40, 30)) + 1j * rng.normal(size=(40, 30)) for k in (0, 1)}
    made = {k: orbit.Burst(data[k], 80.0 + 0.05 * k, 0.002, 850_000.0, 10.0, 0.0555, (0.0, -2300.0, 0.0, 0.0), (0.0, 0.0, 0.0, 0.0), 1.6, (0, 39, 0, 29)) for k in data}
    rows = [
        (date, 1, k, 30, x.start, x.line_time, x.near, x.range_step, x.wavelength, list(x.ka), list(x.dc), x.steering, list(x.valid), vectors, x.data.real.ravel().tolist(), x.data.imag.ravel().tolist())
        for date in (1, 2) for k, x in made.items()
    ]
    bursts = spark.createDataFrame(rows, "date int, iw int, burst int, " + orbit.BURST)
    lat, lon, _ = orbit.range_to_llh(o, 80.05, 850_150.0, 0.0)
    grid = geo.Grid(90, 50, float(lon) - 0.0025, float(lat) + 0.0045, 0.0001, -0.0001)
    terrain = grid.cells(spark).select(F.col("row").alias("r"), F.col("col").alias("c"), F.lit(0.0).alias("height"))
    pixels = drivers.geocode_scenes(terrain, bursts, grid, done=spark.createDataFrame([(2,)], "date int"), heights=(-50.0, 50.0), tile=16)
    got = {(x["date"], x["burst"], x["r"], x["c"]): complex(x["re"], x["im"]) for x in pixels.collect()}
    assert {k[0] for k in got} == {1} and len({k[1] for k in got}) == 2
    cells = grid.cells(spark).toPandas()
    for k, x in made.items():
        re, im = orbit.geocoder(o, x)(cells["lat"].to_numpy(), cells["lon"].to_numpy(), np.zeros(len(cells)))
        want = {(1, k, r, c): complex(a, b) for r, c, a, b in zip(cells["row"], cells["col"], re, im, strict=True) if a or b}
        mine = {q: v for q, v in got.items() if q[1] == k}
        assert want.keys() == mine.keys() and len(want) > 50
        assert all(abs(want[q] - mine[q]) < 1e-6 for q in want)
    frame = {(x["r"], x["c"]): complex(x["re"], x["im"]) for x in drivers.frames(pixels).collect()}
    assert frame == {(r, c): got.get((1, 0, r, c), got.get((1, 1, r, c))) for _, _, r, c in got}


def test_ellipsoidal_heading_follows_the_geodesic(spark):
    """Known azimuths: along meridian and equator, a published test line, and the sphere nearby."""
    from phasegrid.functions import geo

    # The line is Vincenty's example (b) on the international ellipsoid, so only near on this one.
    rows = [(0.0, 0.0, 10.0, 0.0), (0.0, 0.0, 0.0, 20.0), (10.0, 5.0, 10.0, 5.0), (10.0, 179.5, 10.1, -179.5), (37.331931575, 0.0, 26.128566516, 41.476529802)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double")
    out = [x[0] for x in frame.select(geo.heading_ellipsoid(*[F.col(n) for n in "abcd"])).collect()]
    assert out[0] == pytest.approx(0.0) and out[1] == pytest.approx(90.0) and out[2] is None
    assert 80 < out[3] < 90
    assert out[4] == pytest.approx(95.466, abs=0.01)


def test_stretch_is_exact(spark):
    """Skewed, tied, few and no values against NumPy."""
    from phasegrid.operators import raster

    rng = np.random.default_rng(3)
    for values in (rng.normal(size=60_000) ** 3, rng.integers(0, 4, 5_000).astype(float), np.array([7.0]), np.array([1.0, 2.0])):
        frame = spark.createDataFrame([(float(v),) for v in (*values, math.nan)], "v double").repartition(6)
        for low, high in ((0.02, 0.98), (0.0, 1.0)):
            got = raster.stretch(frame, "v", low, high).first()
            assert list(got) == pytest.approx(list(np.quantile(values, [low, high])), abs=1e-9)
    assert list(raster.stretch(frame.where("v > 9"), "v", 0.1, 0.9).first()) == [None, None]
