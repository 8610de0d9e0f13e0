"""Closed forms and NumPy references: solvers, orbits, filters, unwrapping, stitching."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from phasegrid.functions import cplx, geo
from phasegrid.operators import interferograms, joins, orbit, raster, similarity, timeseries, unwrapping
from phasegrid.plans import network
from phasegrid.plans.queries import circular_orbit

DAYS = [0, 12, 24, 36, 60, 72, 96, 108, 120, 144, 156, 168]
IFGS = [(i, j) for i in range(12) for j in range(i + 1, min(12, i + 4))]


def stack(rate, corrupt=(), noise=0.0, seed=0):
    r = np.random.default_rng(seed)
    u = np.array([rate * (DAYS[j] - DAYS[i]) for i, j in IFGS]) + r.normal(0, noise, len(IFGS)) if noise else np.array([rate * (DAYS[j] - DAYS[i]) for i, j in IFGS])
    for k in corrupt:
        u[k] += 2 * math.pi
    return u


def observations(spark, series):
    rows = [(p, str(i), str(j), i, j, DAYS[j] - DAYS[i], float(u[k])) for p, u in enumerate(series) for k, (i, j) in enumerate(IFGS)]
    return spark.createDataFrame(rows, "px int, date1 string, date2 string, i1 int, i2 int, days int, u double")


def test_all_solvers_return_the_rate(spark):
    series = [stack(0.01), stack(-0.003)]
    obs = observations(spark, series)
    factor = timeseries.WAVELENGTH / (4 * math.pi) * timeseries.YEAR
    got = {r["px"]: r["velocity"] for r in timeseries.stack_velocity(obs, ["px"]).collect()}
    assert np.allclose([got[0], got[1]], [0.01 * factor, -0.003 * factor], rtol=1e-6)
    got = {r["px"]: r["rate"] for r in timeseries.sbas_linear(obs, ["px"]).collect()}
    assert np.allclose([got[0], got[1]], [0.01, -0.003])
    _, b = network.matrices(IFGS, DAYS)
    u = np.array(series)
    assert np.allclose(timeseries.least_squares(u, b), [[0.01] * 11, [-0.003] * 11])
    assert np.allclose(timeseries.least_absolute(u, b), [[0.01] * 11, [-0.003] * 11], atol=1e-6)
    tubes = spark.createDataFrame([(0, series[0].tolist()), (1, series[1].tolist())], "px int, u array<double>")
    solved = timeseries.sbas_ls(tubes, ["px"], b)
    steps = np.diff(DAYS).tolist()
    rows = {r["px"]: r for r in timeseries.interval_series(solved, ["px"], steps).collect()}
    assert math.isclose(rows[0]["velocity"], 0.01 * factor, rel_tol=1e-9)
    assert math.isclose(rows[0]["cumulative"], rows[0]["displacement"][-1])
    l1 = {r["px"]: r["x"] for r in timeseries.sbas_l1(tubes, ["px"], b).collect()}
    assert np.allclose(l1[1], -0.003, atol=1e-6)


def test_pair_tubes_mark_missing_dates(spark):
    phases = spark.createDataFrame([(1, "a", 1.0), (1, "b", 3.0), (1, "c", 7.0), (2, "a", 1.0), (2, "c", 2.0)], "px int, date string, phase double")
    pairs = spark.createDataFrame([("b", "c", 1, 2, 5), ("a", "b", 0, 1, 4), ("a", "c", 0, 2, 9)], "date1 string, date2 string, i1 int, i2 int, days int")
    got = {r["px"]: r["u"] for r in timeseries.pair_tubes(phases, pairs, ["px"]).collect()}
    assert got[1] == [2.0, 6.0, 4.0] and got[2][1] == 1.0 and math.isnan(got[2][0]) and math.isnan(got[2][2])
    rows = {(r["px"], r["i1"], r["i2"]): r["u"] for r in timeseries.form_pairs(phases, pairs, ["px"]).collect()}
    assert rows == {(1, 0, 1): 2.0, (1, 0, 2): 6.0, (1, 1, 2): 4.0, (2, 0, 2): 1.0}


def test_screening_and_l1_survive_a_jump(spark):
    u = stack(0.01, corrupt=[7], noise=1e-3)
    obs = observations(spark, [u])
    kept = timeseries.screened(obs, ["px"], 3.0)
    i, j = IFGS[7]
    assert kept.where((F.col("i1") == i) & (F.col("i2") == j)).count() == 0 < kept.count()
    _, b = network.matrices(IFGS, DAYS)
    assert np.abs(timeseries.least_squares(u[None], b) - 0.01).max() > 0.02
    assert np.abs(timeseries.least_absolute(u[None], b, rounds=200) - 0.01).max() < 2e-3


def test_screening_that_drops_all_gives_zero_or_null(spark):
    obs = observations(spark, [stack(0.01, noise=1.0)]).where("i2 - i1 = 3")
    none = timeseries.stack_velocity(obs, ["px"], scale=1e-9)
    assert none.first()["velocity"] == 0.0
    assert timeseries.stack_velocity(obs, ["px"], scale=1e-9, empty_as_null=True).first()["velocity"] is None


def test_missing_observations_and_singular_networks():
    _, b = network.matrices(IFGS, DAYS)
    u = stack(0.02)[None].repeat(2, axis=0)
    u[1, 3] = np.nan
    assert np.allclose(timeseries.least_squares(u, b), 0.02)
    assert np.isfinite(timeseries.least_squares(u[:, :1], b[:1])).all()
    assert np.allclose(timeseries.least_absolute(u, b), 0.02, atol=1e-5)


def test_closure_of_the_matrices():
    a, b = network.matrices(IFGS, DAYS)
    length = [DAYS[j] - DAYS[i] for i, j in IFGS]
    assert np.allclose(a @ np.array(DAYS[1:]), length) and np.allclose(b.sum(axis=1), length)


def test_seasonal_models_recover_their_terms(spark):
    days = list(range(0, 1500, 40))
    pairs = [(i, j) for i in range(len(days)) for j in range(i + 1, min(len(days), i + 4))]
    t = np.array(days) / 365.25
    signal = 3 * t + 0.7 * np.sin(2 * np.pi * t) - 0.2 * np.cos(2 * np.pi * t)
    u = np.array([signal[j] - signal[i] for i, j in pairs])
    x = timeseries.least_squares(u[None], network.seasonal_design(pairs, days, 1))[0]
    assert np.allclose([x[0] * 365.25, x[1], x[2]], [3, 0.7, -0.2], atol=1e-9)
    rows = [(0, float(days[i]), float(days[j]), float(v)) for (i, j), v in zip(pairs, u, strict=True)]
    obs = spark.createDataFrame(rows, "px int, t1 double, t2 double, u double")
    got = timeseries.sbas_seasonal(obs, ["px"], F.col("t1"), F.col("t2"), 1e-12)
    r = got.first()
    assert np.allclose([r["rate"], r["sine"], r["cosine"]], [3, 0.7, -0.2], atol=1e-6)
    series = timeseries.seasonal_series(got, spark.createDataFrame([(0, 0), (1, 365)], "idx int, days int"), ["px"], 4 * math.pi)
    disp = {r["idx"]: r["disp"] for r in series.collect()}
    assert math.isclose(disp[0], -0.2, abs_tol=1e-6)


def test_orbit_kernels():
    o = circular_orbit()
    rate = math.sqrt(3.986004418e14 / 7_071_000.0**3)
    q = np.linspace(15, 140, 40)
    x, v = o.at(q)
    assert np.allclose(np.linalg.norm(x, axis=1), 7_071_000.0, atol=1e-6)
    assert np.allclose(np.linalg.norm(v, axis=1), 7_071_000.0 * rate, atol=1e-6)
    for right in (True, False):
        p = orbit.range_to_llh(o, 80.0, 850_000.0, 250.0, right)
        (t,), look = o.zero_doppler(orbit.llh_to_xyz(p[0], p[1], p[2])[None])
        assert abs(t - 80) < 1e-6 and abs(np.linalg.norm(look) - 850_000) < 1e-3
        # Ascending: the right side is east of the track.
        assert (p[1] > orbit.xyz_to_llh(o.at(np.array([80.0]))[0][0])[1]) == right
    box = orbit.burst_bounds(o, (70, 73), (800_000, 900_000), (0, 1000))
    assert box["south"] < box["north"] and box["west"] < box["east"]
    up = orbit.Orbit(o.t, o.x * (1 + 100 / 7_071_000.0), o.v)
    target = orbit.llh_to_xyz(*orbit.range_to_llh(o, 80.0, 850_000.0, 0.0))
    forth, back = orbit.perpendicular_baseline(o, up, target), orbit.perpendicular_baseline(up, o, target)
    assert 20 < abs(forth) < 100 and abs(forth + back) < 0.1
    assert orbit.perpendicular_baseline(o, o, target) == pytest.approx(0, abs=1e-5)
    with pytest.raises(ValueError):
        orbit.Orbit.from_rows([(0, 1, 2, 3, 4, 5, 6)])


def test_orbit_frames(spark):
    o = circular_orbit()
    rows = [(i, *map(float, orbit.range_to_llh(o, 60.0 + i, 820_000.0 + 1000 * i, 100.0))) for i in range(20)]
    points = spark.createDataFrame(rows, "k int, lat double, lon double, height double")
    for r in orbit.zero_doppler(points, o).collect():
        assert abs(r["time"] - 60 - r["k"]) < 1e-6 and abs(r["slant"] - 820_000 - 1000 * r["k"]) < 1e-2
    for r in orbit.line_of_sight(points, o).collect():
        assert math.isclose(r["los_e"] ** 2 + r["los_n"] ** 2 + r["los_u"] ** 2, 1, abs_tol=1e-9) and 10 < r["look"] < 60


def test_geocoding_finds_a_point(spark):
    o = circular_orbit()
    near, step, start, line = 850_000.0, 10.0, 80.0, 0.002
    data = np.zeros((60, 80), dtype=complex)
    data[30, 40] = 2.0
    burst = orbit.Burst(data, start, line, near, step, 0.0555, (0.0, -2300.0, 0.0, 0.0), (0.0, 0.0, 0.0, 0.0), 1.6, (0, 59, 0, 79))
    rows = [(i, j, *map(float, orbit.range_to_llh(o, start + i * line, near + j * step, 0.0))) for i in (0, 29, 30, 31) for j in (39, 40, 41)]
    points = spark.createDataFrame(rows, "i int, j int, lat double, lon double, height double")
    power = {(r["i"], r["j"]): math.hypot(r["re"], r["im"]) for r in orbit.geocode(points, o, burst).collect()}
    assert max(power, key=power.get) == (30, 40) and power[30, 40] == pytest.approx(2.0, abs=0.05)
    assert power[29, 40] < 0.1 and power[0, 39] == 0


def test_geodesy_round_trips(spark):
    rows = [(float(lat), float(lon), float(h)) for lat in (-80, -10.5, 0, 45, 89) for lon in (-179, 0, 33.3) for h in (-100, 0, 8000)]
    frame = spark.createDataFrame(rows, "lat double, lon double, h double")
    xyz = geo.llh_to_xyz(F.col("lat"), F.col("lon"), F.col("h"))
    back = geo.xyz_to_llh(*xyz)
    for r in frame.select("*", *[c.alias(n) for c, n in zip(back, ("la", "lo", "hh"), strict=True)]).collect():
        assert abs(r["lat"] - r["la"]) < 1e-8 and abs(r["lon"] - r["lo"]) < 1e-9 and abs(r["h"] - r["hh"]) < 1e-3
    enu = geo.xyz_to_enu(F.col("lat"), F.col("lon"), geo.enu_to_xyz(F.col("lat"), F.col("lon"), (F.lit(1.0), F.lit(2.0), F.lit(3.0))))
    assert np.allclose([list(r) for r in frame.select(*enu).collect()], [1, 2, 3])
    t, c, n = geo.tcn((F.lit(7e6), F.lit(1e5), F.lit(0.0)), (F.lit(0.0), F.lit(10.0), F.lit(7500.0)))
    row = frame.limit(1).select(geo.norm(t), geo.norm(c), geo.norm(n), geo.dot(t, c), geo.dot(t, n), geo.dot(c, n)).first()
    assert np.allclose(list(row), [1, 1, 1, 0, 0, 0], atol=1e-9)
    rotation, offset, radius = geo.sch_matrix(30.0, 40.0, 12.0)
    assert np.allclose(rotation @ rotation.T, np.eye(3)) and np.linalg.norm(offset) < 50_000 < radius


def test_grids_and_polygons():
    g = geo.Grid(100, 200, 10.0, 50.0, 0.01, -0.01)
    assert geo.Grid.from_rsc(g.to_rsc()) == g
    looks = g.looks(10, 20)
    assert (looks.rows, looks.cols) == (10, 10) and looks.lon_min == pytest.approx(10 + 9.5 * 0.01) and looks.lat_max == pytest.approx(50 - 4.5 * 0.01)
    u = g.union(geo.Grid(100, 200, 10.5, 50.2, 0.01, -0.01))
    assert (u.rows, u.cols, u.lon_min, u.lat_max) == (120, 250, 10.0, 50.2)
    assert g.geotransform()[0] == pytest.approx(9.995) and "<north>50.0</north>" in g.kml("a.png")
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    clipped = geo.clip_polygon(square, 1, 1, 9, 2)
    area = 0.5 * abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(clipped, clipped[1:] + clipped[:1], strict=True)))
    assert area == pytest.approx(3.0)
    assert geo.clip_polygon(square, 10, 10, 11, 11) == []


def long_form(spark, z):
    r, c = np.mgrid[0 : z.shape[0], 0 : z.shape[1]]
    rows = list(zip(r.ravel().tolist(), c.ravel().tolist(), z.real.ravel().tolist(), z.imag.ravel().tolist(), strict=True))
    return spark.createDataFrame(rows, "r long, c int, re double, im double")


def test_raster_algebra_against_numpy(spark):
    rng = np.random.default_rng(3)
    z = rng.normal(size=(23, 17)) + 1j * rng.normal(size=(23, 17))
    frame = long_form(spark, z)
    looks = z[:20, :15].reshape(4, 5, 5, 3)
    got = {(r["br"], r["bc"]): complex(r["re"], r["im"]) for r in raster.multilook(frame, 23, 17, (5, 3), ["re", "im"]).collect()}
    assert len(got) == 20 and all(np.isclose(v, looks.mean(axis=(1, 3))[k]) for k, v in got.items())
    amp = {(r["br"], r["bc"]): r["amp"] for r in raster.amplitude_looks(frame, 23, 17, (1, 1)).collect()}
    assert all(np.isclose(v, abs(z[k])) for k, v in amp.items())
    padded = np.pad(z.real, 3, mode="reflect")
    want = sum(padded[i : i + 23, j : j + 17] for i in range(7) for j in range(7)) / 49
    mean = {(r["r"], r["c"]): r["re"] for r in raster.box_mean(frame, 23, 17, 3, "re").collect()}
    assert len(mean) == z.size and all(np.isclose(v, want[k]) for k, v in mean.items())
    same = interferograms.form(frame, frame).collect()
    assert all(abs(r["im"]) < 1e-12 and r["re"] >= 0 for r in same)
    strip = raster.strips(frame.where("r in (1, 2, 3, 7, 9, 10)"), F.lit(True)).orderBy("top").collect()
    assert [(s["top"], s["bottom"], s["n_rows"]) for s in strip] == [(1, 4, 3), (7, 8, 1), (9, 11, 2)]
    again = {(r["br"], r["bc"]): r["re"] for r in raster.multilook(frame.repartition(9), 23, 17, (5, 3), ["re"]).collect()}
    assert all(np.isclose(again[k], got[k].real) for k in got)


def test_filter_keeps_a_constant_phase(spark):
    rng = np.random.default_rng(5)
    clean = np.full((48, 40), np.exp(0.7j))
    out = interferograms.goldstein(long_form(spark, clean), 48, 40, 16, 0.5).collect()
    assert len(out) == clean.size and all(abs(math.atan2(r["im"], r["re"]) - 0.7) < 1e-9 for r in out)
    noisy = clean * np.exp(1j * rng.normal(0, 0.8, clean.shape))
    angles = [math.atan2(r["im"], r["re"]) for r in interferograms.goldstein(long_form(spark, noisy), 48, 40, 16, 0.8).collect()]
    assert np.std(angles) < 0.8 * np.std(np.angle(noisy))


def test_unwrapping():
    r, c = np.mgrid[0:40, 0:50]
    plane = 0.9 * r + 0.7 * c
    wrap = lambda t: (t + np.pi) % (2 * np.pi) - np.pi
    out, charge = unwrapping.unwrap_array(wrap(plane))
    assert not charge.any() and np.allclose(out - out[0, 0], plane - plane[0, 0])
    noisy = 0.02 * ((r - 20) ** 2 + (c - 25) ** 2) + np.random.default_rng(0).normal(0, 0.7, r.shape)
    out, charge = unwrapping.unwrap_array(wrap(noisy))
    turns = np.rint((out - noisy) / (2 * np.pi) - np.median((out - noisy) / (2 * np.pi)))
    assert charge.any() and (turns != 0).mean() < 0.02
    assert np.allclose((out - wrap(noisy)) / (2 * np.pi), np.rint((out - wrap(noisy)) / (2 * np.pi)))
    vortex, charge = unwrapping.unwrap_array(np.arctan2(r - 19.5, c - 24.5))
    assert np.abs(charge).sum() == 1 and np.isfinite(vortex).all()
    for shape in ((1, 5), (5, 1), (2, 2)):
        assert unwrapping.unwrap_array(np.zeros(shape))[0].shape == shape


def test_components_of_a_tile():
    cost_c, cost_r = np.full((6, 7), 500.0), np.full((5, 8), 500.0)
    cost_c[:, 3] = 0
    join_c, join_r = unwrapping.joined_cells(cost_c, cost_r, 300)
    # Smoothing also cuts the columns next to the cheap one; the two strips in between are small.
    labels = unwrapping.components(join_c, join_r, 0.2)
    assert set(np.unique(labels).tolist()) == {0, 1, 2} and labels[0, 0] == 1 and labels[0, 7] == 2 and labels[0, 3] == 0
    assert unwrapping.components(join_c, join_r, 0.9).max() == 0


def test_unwrapping_frames(spark):
    r, c = np.mgrid[0:20, 0:16]
    plane = 0.8 * r - 0.5 * c
    rows = [(t, int(i), int(j), float((plane[i, j] + np.pi) % (2 * np.pi) - np.pi)) for t, a, z in ((1, 0, 12), (2, 8, 20)) for i in range(a, z) for j in range(16)]
    tiles = spark.createDataFrame(rows, "tile int, r int, c int, phase double")
    done = unwrapping.unwrap(tiles, ["tile"])
    whole = {(x["r"], x["c"]): x["unwrapped"] for x in unwrapping.level_tiles(done, "tile").collect()}
    assert len(whole) == plane.size
    assert all(np.isclose(v - whole[0, 0], plane[k] - plane[0, 0]) for k, v in whole.items())
    one = tiles.where("tile = 1").drop("tile")
    simple = {(x["r"], x["c"]): x["unwrapped"] for x in unwrapping.integrate(one).collect()}
    assert all(np.isclose(v - simple[0, 0], plane[k] - plane[0, 0]) for k, v in simple.items())
    assert unwrapping.residues(one).where("residue <> 0").count() == 0


def test_stitching_recovers_a_constant_offset(spark):
    r, c = np.mgrid[0:30, 0:8]
    field = np.exp(1j * (0.1 * r + 0.2 * c)) * (1 + 0.01 * r)
    second = field[12:] * np.exp(0.9j)
    pack = lambda z: (z.real.ravel().tolist(), z.imag.ravel().tolist())
    rows = [("p", 0, "a", 0, 0, 18, 8, *pack(field[:18])), ("p", 1, "b", 12, 0, 18, 8, *pack(second))]
    tiles = spark.createDataFrame(rows, "ifg string, ord int, acquisition string, top int, left int, height int, width int, re array<double>, im array<double>")
    got = {(x["r"], x["c"]): complex(x["re"], x["im"]) for x in interferograms.stitch_subswath(tiles, ["ifg"]).collect()}
    assert len(got) == field.size and all(np.isclose(v, field[k]) for k, v in got.items())
    same = tiles.withColumn("acquisition", F.lit("a"))
    kept = {(x["r"], x["c"]): complex(x["re"], x["im"]) for x in interferograms.stitch_subswath(same, ["ifg"]).collect()}
    assert np.isclose(kept[29, 0], second[-1, 0])


def test_spiral_offsets():
    offsets = similarity.spiral(2, 7)
    assert len(set(offsets)) == len(offsets) and {(-a, -b) for a, b in offsets} == set(offsets)
    assert all(2 < math.hypot(*o) < 7 for o in offsets)
    assert [round(math.hypot(*o)) for o in offsets] == sorted(round(math.hypot(*o)) for o in offsets)


def test_complex_columns(spark):
    frame = spark.createDataFrame([(x / 7,) for x in range(-60, 61)], "x double")
    out = frame.select("x", cplx.wrap(F.col("x")).alias("w"), cplx.wrap_positive(F.col("x")).alias("p"), cplx.wrap_once(F.col("x")).alias("o")).collect()
    for r in out:
        assert -math.pi < r["w"] <= math.pi + 1e-12 and 0 <= r["p"] < 2 * math.pi
        assert abs(math.sin(r["w"]) - math.sin(r["x"])) < 1e-9
        if abs(r["x"]) < 3 * math.pi:
            assert abs(r["o"]) <= math.pi + 1e-9
    turned = spark.range(1).select(*cplx.rotate((F.lit(1.0), F.lit(0.0)), F.lit(math.pi / 2)), cplx.coherence(F.lit(3.0), F.lit(1.0), F.lit(1.0), "clip"), cplx.coherence(F.lit(3.0), F.lit(1.0), F.lit(1.0), "hash")).first()
    assert abs(turned[0]) < 1e-12 and abs(turned[1] - 1) < 1e-12 and turned[2] == 1.0 and 0 <= turned[3] < 1


def test_pair_table_by_dates_and_baselines(spark):
    scenes = spark.createDataFrame([("2020-01-01", 0.0), ("2020-01-13", 120.0), ("2020-02-06", -250.0)], "date string, bperp double").withColumn("date", F.to_date("date"))
    got = {(str(r["date1"]), str(r["date2"])): (r["days"], r["bperp"]) for r in orbit.pair_table(scenes, scenes, (6, 40), (0.0, 300.0)).collect()}
    assert got == {("2020-01-01", "2020-01-13"): (12, 120.0), ("2020-01-01", "2020-02-06"): (36, -250.0)}


def test_plane_removal(spark):
    r, c = np.mgrid[0:9, 0:7]
    rows = [(k, int(i), int(j), float(3 + k * i - 2 * j)) for k in (1, 2) for i, j in zip(r.ravel(), c.ravel(), strict=True)]
    flat = raster.detrend_plane(spark.createDataFrame(rows, "img int, r int, c int, v double"), "v", ["img"]).collect()
    assert len(flat) == len(rows) and all(abs(x["v"]) < 1e-9 for x in flat)
    one = spark.createDataFrame([(1, 0, 0, 5.0)], "img int, r int, c int, v double")
    assert raster.detrend_plane(one, "v", ["img"]).first()["v"] == 0.0


def test_seasonal_and_other_models_share_tubes(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0, float("nan")])], "px int, u array<double>")
    got = timeseries.sbas_model(frame, ["px"], np.array([[1.0], [2.0], [5.0]])).first()
    assert got["x"] == pytest.approx([1.0])


def test_nearest_boxes_against_brute_force(spark):
    r = random.Random(3)
    boxes = [(i, i % 2, t := r.choice([r.randint(0, 60), r.randint(0, 60), r.randint(0, 5000)]), t + r.randint(1, 9)) for i in range(400)]
    boxes += [(1000 + i, 0, 7, 9) for i in range(30)] + [(2000, 5, 1, 2), (2001, 1, 90_000, -80_000), (2002, 0, None, 4)]
    frame = spark.createDataFrame(boxes, "k long, iw int, top long, bottom long")
    whole = [x for x in boxes if x[2] is not None]
    for other, ls, rs in ((True, whole, whole), (False, whole[:90], whole[90:])):
        want = {}
        for k, iw, top, bottom in ls:
            near = [(abs(top - y[2]) + abs(bottom - y[3]), y[0]) for y in rs if y[1] == iw and not (other and y[0] == k)]
            if near:
                want[k] = min(near)
        left, right = (frame.where(F.col("k").isin([x[0] for x in side])) for side in (ls, rs))
        got = joins.nearest_boxes(left if not other else frame, right if not other else frame, ["iw"], "k", "k", other).collect()
        assert {g["l_id"]: (g["distance"], g["r_id"]) for g in got} == want and len(got) == len(want)
        assert joins.nearest_boxes(left.limit(0), right, ["iw"], "k", "k", other).count() == 0
        assert joins.nearest_boxes(left, right.limit(0), ["iw"], "k", "k", other).count() == 0


def test_whole_job_queries_have_no_subset(spark, sf):
    from phasegrid.plans import bindings, queries

    assert queries.QUERIES["burst_match"](spark, sf).count() == spark.read.parquet(f"{sf}/part.parquet").count()
    assert queries.QUERIES["functions_in_sql"](spark, sf).count() == bindings.embedding_pixels(spark, sf).count()
