"""Sources, sinks, catalogues, configuration and streaming."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from phasegrid import config
from phasegrid.functions import names
from phasegrid.operators import catalog, joins, raster
from phasegrid.sources import binary, register, text
from phasegrid.streaming import incremental


@pytest.fixture(scope="module")
def source(spark):
    register(spark)
    return lambda path, **o: spark.read.format("raster").options(**{k: str(v) for k, v in o.items()}).load(str(path))


def test_flat_rasters(source, tmp_path):
    rng = np.random.default_rng(0)
    z = (rng.normal(size=(37, 11)) + 1j * rng.normal(size=(37, 11))).astype("<c8")
    z.tofile(tmp_path / "a.int")
    got = source(tmp_path / "a.int", dtype="c8", nrow=37, ncol=11, rows=10)
    assert got.rdd.getNumPartitions() == 4
    rows = got.collect()
    assert len(rows) == z.size and all(np.isclose(complex(r["re"], r["im"]), z[r["r"], r["c"]]) for r in rows)
    part = source(tmp_path / "a.int", dtype="c8", nrow=37, ncol=11, rows=10).where("r >= 20 and r < 23")
    assert part.count() == 33 and part.rdd.getNumPartitions() == 1  # the row range is pushed down
    window = source(tmp_path / "a.int", dtype="c8", nrow=37, ncol=11, window="5,7,2,4").collect()
    assert sorted((r["r"], r["c"]) for r in window) == [(5, 2), (5, 3), (6, 2), (6, 3)]


@pytest.mark.parametrize(("dtype", "kind"), [("f4", "<f4"), ("f8", "<f8"), ("i2", "<i2"), ("i4", "<i4"), ("u1", "u1")])
def test_real_types(source, tmp_path, dtype, kind):
    m = (np.arange(60).reshape(6, 10) * 3).astype(kind)
    m.tofile(tmp_path / "m.bin")
    assert all(r["v"] == m[r["r"], r["c"]] for r in source(tmp_path / "m.bin", dtype=dtype, nrow=6, ncol=10).collect())


def test_layouts_headers_and_short_complex(source, tmp_path):
    m = np.arange(24, dtype="<f4").reshape(4, 6)
    np.stack([m, -m], axis=1).tofile(tmp_path / "x.cc")
    for r in source(tmp_path / "x.cc", dtype="f4", layout="altline", nrow=4, ncol=6).collect():
        assert r["v"] == m[r["r"], r["c"]] == -r["v2"]
    np.stack([m, 2 * m], axis=2).tofile(tmp_path / "x.alt")
    for r in source(tmp_path / "x.alt", dtype="f4", layout="altsample", nrow=4, ncol=6).collect():
        assert r["v2"] == 2 * r["v"] == 2 * m[r["r"], r["c"]]
    np.stack([m, m + 1], axis=2).astype("<i2").tofile(tmp_path / "x.slc")
    for r in source(tmp_path / "x.slc", dtype="ci2", nrow=4, ncol=6).collect():
        assert (r["re"], r["im"]) == (m[r["r"], r["c"]], m[r["r"], r["c"]] + 1)
    box = binary.Box(60, 80, 7, 20, 13, 24)
    (tmp_path / "b").mkdir()
    for name in ("1.gslc", "2.gslc"):
        (tmp_path / "b" / name).write_bytes(box.header() + m.astype("<c8").tobytes())
    rows = source(tmp_path / "b", suffix=".gslc", header="true", dtype="c8").collect()
    assert len(rows) == 48 and {(r["r"], r["c"]) for r in rows} == {(i + 20, j + 7) for i in range(4) for j in range(6)}
    heads = source(tmp_path / "b" / "*.gslc", header="true", mode="header").collect()
    assert [(h["nrow"], h["left"], h["top"], h["right"], h["bottom"]) for h in heads] == [(60, 7, 20, 13, 24)] * 2
    with pytest.raises(Exception, match="ends before"):
        source(tmp_path / "x.cc", dtype="f8", nrow=40, ncol=6).count()


@pytest.mark.parametrize("header", ["false", "true"])
def test_write_and_read_back(spark, source, tmp_path, header):
    m = np.random.default_rng(1).normal(size=(12, 5)).astype("<f4")
    frame = spark.createDataFrame([(i, j, float(m[i, j])) for i in range(12) for j in range(5)], "r int, c int, v float")
    out = tmp_path / "out"
    frame.repartitionByRange(3, "r").write.format("raster").options(dtype="f4", nrow="12", ncol="5", header=header).mode("append").save(str(out))
    if header == "true":
        rows = source(out, suffix=".bin", header="true", dtype="f4").collect()
    else:
        binary.join_parts(str(out), str(tmp_path / "whole.bin"))
        rows = source(tmp_path / "whole.bin", dtype="f4", nrow=12, ncol=5).collect()
    assert len(rows) == 60 and all(r["v"] == m[r["r"], r["c"]] for r in rows)
    assert not [p for p in os.listdir(out) if p.startswith(".rows")]


def test_text_sources(spark, tmp_path):
    (tmp_path / "orbit.txt").write_text("2\n1.5 1 2 3 4 5 6 0 0 0\n2.5 1 2 3 4 5 6 0 0 0\nbad line\n")
    assert [r["t"] for r in text.orbits(spark, str(tmp_path / "orbit.txt")).orderBy("t").collect()] == [1.5, 2.5]
    (tmp_path / "poly.txt").write_text("1\n10 0.005 1 2 3\n")
    assert text.polynomials(spark, str(tmp_path / "poly.txt")).first()["c2"] == 3
    (tmp_path / "g.rsc").write_text("WIDTH 10\nFILE_LENGTH 5\n\n")
    assert {r["key"]: r["value"] for r in text.rsc(spark, str(tmp_path / "g.rsc")).collect()} == {"WIDTH": "10", "FILE_LENGTH": "5"}
    (tmp_path / "pairs.txt").write_text("20200101 20200113 12 -35.5\njunk\n")
    pairs = text.pair_list(spark, str(tmp_path / "pairs.txt")).where("date2 is not null").collect()
    assert [(str(p["date1"]), p["days"], p["bperp"]) for p in pairs] == [("2020-01-01", 12, -35.5)]
    (tmp_path / "tasks.txt").write_text("a b c\nmalformed line\nd e f\n")
    assert text.task_list(spark, str(tmp_path / "tasks.txt")).count() == 2
    corners = spark.createDataFrame([(0.0, 1.0, 0.0, 1.0, 5.0, 5.0, 4.0, 4.0)] * 3, "lon_ul double, lon_ur double, lon_ll double, lon_lr double, lat_ul double, lat_ur double, lat_ll double, lat_lr double")
    g = text.grid_from_corners(corners).first()
    assert (g["ncol"], g["nrow"]) == (7200, 7200)


def test_catalogue_files(spark, tmp_path):
    def feature(name, url, kind="Polygon"):
        ring = [[0, 0], [2, 0], [2, 3], [0, 0]]
        return {"type": "Feature", "geometry": {"type": kind, "coordinates": [ring] if kind == "Polygon" else [[ring], [ring]]}, "properties": {"sceneName": name, "fileID": f"{name}-id", "url": url}}

    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature("s1", "u1"), feature("s2", "u2", "MultiPolygon")]}))
    (tmp_path / "b.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature("s1", "other"), feature("", "u3")]}))
    (tmp_path / "c.geojson").write_text(json.dumps(feature("s4", "u4")))
    scenes = text.merged_scenes(text.geojson(spark, str(tmp_path / "*.geojson")))
    got = {r["scene"]: r for r in scenes.collect()}
    assert set(got) == {"s1", "s2", "", "s4"} and json.loads(got["s1"]["properties"])["url"] == "u1" and len(got["s2"]["rings"]) == 2
    box = catalog.footprint(scenes, ["scene"], "rings").where("scene = 's1'").first()
    assert (box["west"], box["south"], box["east"], box["north"]) == (0, 0, 2, 3)
    assert json.loads(text.to_geojson(scenes).first()["value"])["type"] == "Feature"
    (tmp_path / "m1.xml").write_text('<metalink xmlns="urn:x"><files><file name="f1"><resources><url>http://a/f1</url></resources><size>5</size></file></files></metalink>')
    (tmp_path / "m2.xml").write_text('<metalink><files><file name="f1"><resources><url>http://b/f1</url></resources></file><file name="f2"><resources><url>http://b/f2</url></resources></file></files></metalink>')
    links = text.metalink(spark, str(tmp_path / "m*.xml"))
    found = {r["name"]: r["url"] for r in links.collect()}
    assert found == {"f1": "http://a/f1", "f2": "http://b/f2"}
    assert text.to_metalink(links).count() == 2 and "<size>5</size>" in text.to_metalink(links.where("name = 'f1'")).first()["value"]
    (tmp_path / "o.xml").write_text("<Orbit><List>" + "".join(f"<OSV><UTC>UTC=2020-01-01T00:{m:02d}:00.5</UTC><X>1</X><Y>2</Y><Z>3</Z><VX>4</VX><VY>5</VY><VZ>6</VZ></OSV>" for m in range(30)) + "</List></Orbit>")
    osv = text.precise_orbit(spark, str(tmp_path / "o.xml"), F.lit("2020-01-01 00:10:00").cast("timestamp"), F.lit("2020-01-01 00:12:00").cast("timestamp"))
    assert osv.count() == 3


def test_names(spark):
    one = spark.range(1)
    p = one.select(names.product_parts(F.lit("S1A_IW_SLC__1SDV_20200102T030405_20200102T030432_030639_0382D5_DE12.zip")).alias("p")).first()["p"]
    assert (p["mission"], p["product"], p["level"], p["class"], p["polarisation"], p["date"], p["unique_id"]) == ("S1A", "SLC", "1", "S", "DV", "20200102", "DE12")
    q = one.select(names.burst_parts(F.lit("/x/20200102_S1A_DE12_iw3_burst_7.gslc")).alias("p")).first()["p"]
    assert (q["date"], q["iw"], q["burst"]) == ("20200102", 3, 7)
    v = one.select(names.orbit_validity(F.lit("S1A_OPER_AUX_POEORB_V20200101T225942_20200103T005942.EOF")).alias("v")).first()["v"]
    assert str(v["start"]) == "2020-01-01 22:59:42"
    lines = one.select(names.invalid_lines(F.lit("-1 -1 5 7 9 -1")).alias("l")).first()["l"]
    assert (lines["first"], lines["last"], lines["middle"]) == (2, 1, 7)
    kinds = spark.createDataFrame([("12",), ("1.5",), ("1e3",), ("abc",)], "v string").select(names.number_kind(F.col("v"))).collect()
    assert [k[0] for k in kinds] == ["int", "float", "float", "string"]
    url = one.select(names.query_url("http://h/q", {"a": F.lit("x y"), "b": F.lit(None), "c": F.lit(3)})).first()[0]
    assert url == "http://h/q?a=x+y&c=3"


def test_joins_and_catalogue_edges(spark):
    a = spark.createDataFrame([(1, 5.0), (2, 15.0), (3, None)], "id int, t double")
    b = spark.createDataFrame([(10, 0.0, 6.0), (11, 4.0, 20.0), (12, 9.0, 8.0)], "k int, lo double, hi double")
    for width in (1.0, 7.0, 1000.0):
        got = joins.band_join(a, b, F.col("t"), F.col("lo"), F.col("hi"), width)
        assert {(r["id"], r["k"]) for r in got.collect()} == {(1, 10), (1, 11), (2, 11)}
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert list(catalog.split_ranges(lambda s, e: e - s, 0, 10, 3)) == [(0, 2), (2, 5), (5, 7), (7, 10)]
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "name string, target string")
    assert {r["name"] for r in catalog.linked(links, spark.createDataFrame([("a",)], "name string")).collect()} == {"a", "b", "c"}
    with pytest.raises(ValueError):
        catalog.by_path(spark.createDataFrame([(1, 2)], "path int, frame int"), 5)
    layers = spark.createDataFrame([(0, 0, 1, 0.0), (0, 0, 2, 5.0), (0, 0, 3, 7.0)], "r int, c int, p int, v double")
    assert raster.mosaic(layers, "p", ["v"], F.col("v") != 0).first()["v"] == 5.0
    assert raster.mosaic(layers, "p", ["v"], F.col("v") != 0, last_wins=True).first()["v"] == 7.0


def test_configuration(tmp_path):
    path = tmp_path / "c.yml"
    path.write_text("io: {output: out}\nlooks: {rows: 3}\ntimeseries: {method: l1, mad_scale: 2}\n")
    got = config.load(str(path))
    assert got.looks.rows == 3 and got.looks.cols == 20 and got.timeseries.mad_scale == 2.0
    assert got.io.output == str(tmp_path / "out") and got.io.corrected == ""
    config.save(got, str(tmp_path / "d.yml"))
    assert config.load(str(tmp_path / "d.yml")) == got
    for bad in ("nothing: 1", "looks: {rows: x}", "timeseries: {method: magic}", "looks: 3"):
        path.write_text(bad)
        with pytest.raises(ValueError):
            config.load(str(path))


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def arrive(name, *days):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps({"scene": f"s{d}", "at": f"2020-01-{d:02d}T00:00:00", "date": f"2020-01-{d:02d}"}) for d in days))
        scenes = incremental.arriving(spark, str(tmp_path / "in"))
        incremental.extend_pairs(scenes, str(tmp_path / "dates"), str(tmp_path / "pairs"), str(tmp_path / "check"), (6, 12)).awaitTermination()

    arrive("1.json", 1, 7, 7)
    arrive("2.json", 13, 19)
    pairs = spark.read.parquet(str(tmp_path / "pairs"))
    found = {(r["date1"].day, r["date2"].day) for r in pairs.collect()}
    assert found == {(1, 7), (1, 13), (7, 13), (7, 19), (13, 19)} and pairs.count() == 5
    obs = spark.createDataFrame([(1, 10, 0.5), (1, 20, 1.0)], "px int, days int, u double")
    assert incremental.running_velocity(obs, ["px"]).first()["n"] == 2


def test_multi_strip_rasters(spark, source, tmp_path):
    m = np.arange(40, dtype="<f4").reshape(8, 5)
    binary.write_strips(str(tmp_path / "s.bin"), 100, 50, 7, [(10, m[:3]), (40, m[3:])])
    rows = source(tmp_path / "s.bin", header="strips", dtype="f4", rows=2).collect()
    want = {(10 + i, 7 + j): m[i, j] for i in range(3) for j in range(5)} | {(37 + i, 7 + j): m[i, j] for i in range(3, 8) for j in range(5)}
    assert {(r["r"], r["c"]): r["v"] for r in rows} == want
    heads = source(tmp_path / "s.bin", header="strips", mode="header").collect()
    assert [(h["top"], h["bottom"]) for h in heads] == [(10, 13), (40, 45)]


def test_tiff_and_archives(spark, tmp_path):
    import io
    import zipfile

    from phasegrid.sources import archive, tiff

    z = (np.arange(60).reshape(12, 5) - 30 + 1j * np.arange(60).reshape(12, 5)).astype(np.complex64)
    for data, deflate in ((z, True), (z.real.astype(np.float32), False), (z.real.astype(np.int16), True), (z.real.astype(np.float64), True)):
        out = io.BytesIO()
        tiff.write(out, data, (10.0, 0.5, 0, 50.0, 0, -0.5), "nan", 5, deflate)
        back = tiff.Tiff.open(io.BytesIO(out.getvalue()))
        assert back.shape == (12, 5) and np.array_equal(back.rows(0, 12), data) and np.array_equal(back.rows(4, 11), data[4:11])
        assert back.tags[tiff.TIEPOINT][3:5] == (10.0, 50.0)
    assert tiff.shifted((10.0, 0.5, 0, 50.0, 0, -0.5), True) == (10.25, 49.75)
    out = io.BytesIO()
    tiff.write(out, z, rows_per_strip=4)
    with zipfile.ZipFile(tmp_path / "scene.zip", "w") as f:
        f.writestr("S/measurement/a-iw1-VV.tiff", out.getvalue())
        f.writestr("S/annotation/a-iw1-vv.xml", "<p><prf>1.5</prf></p>")
    zips = archive.archives(spark, str(tmp_path / "*.zip"))
    assert archive.members(zips).count() == 2
    found = catalog.zip_members(archive.members(zips), "member", "annotation", ".xml", "VV")
    assert found.count() == 1
    text_row = archive.member_texts(zips, "annotation", ".xml").select(names.tag_text(F.col("text"), "prf").alias("p")).first()
    assert text_row["p"] == "1.5"
    pixels = archive.burst_pixels(archive.bursts(zips, "vv", 6), ["burst"]).collect()
    assert len(pixels) == 60 and all(complex(p["re"], p["im"]) == z[p["burst"] * 6 + p["r"], p["c"]] for p in pixels)


def test_annotation(spark):
    from phasegrid.sources import annotation

    def document(fm):
        orbits = "".join(f"<orbit><time>2020-01-02T03:04:0{i}.5</time><position><x>{i}</x><y>2</y><z>3</z></position><velocity><x>4</x><y>5</y><z>6</z></velocity></orbit>" for i in range(4))
        burst = "<burst><azimuthTime>2020-01-02T03:04:05.25</azimuthTime><byteOffset>{}</byteOffset><firstValidSample count=\"5\">-1 7 9 8 -1</firstValidSample></burst>"
        dc = "<dcEstimate><azimuthTime>2020-01-02T03:04:05</azimuthTime><t0>0.005</t0><dataDcPolynomial count=\"3\">1 2 3</dataDcPolynomial></dcEstimate>"
        return (
            "<product><missionId>S1A</missionId><pass>Ascending</pass><radarFrequency>5.405e9</radarFrequency><slantRangeTime>0.005</slantRangeTime>"
            "<productFirstLineUtcTime>2020-01-02T03:04:05.0</productFirstLineUtcTime><azimuthTimeInterval>0.002</azimuthTimeInterval><numberOfLines>1001</numberOfLines>"
            f"<swathTiming><burstList count=\"2\">{burst.format(10)}{burst.format(20)}</burstList></swathTiming><orbitList>{orbits}</orbitList>"
            f"<azimuthFmRateList><azimuthFmRate><azimuthTime>2020-01-02T03:04:05</azimuthTime><t0>0.006</t0>{fm}</azimuthFmRate></azimuthFmRateList><dcEstimateList>{dc}</dcEstimateList></product>"
        )

    docs = spark.createDataFrame(
        [("a", document("<azimuthFmRatePolynomial>-2300 4 5</azimuthFmRatePolynomial>")), ("b", document("<c0>-2300</c0><c1>4</c1><c2>5</c2>"))], "scene string, xml string"
    )
    p = annotation.parameters(docs, ["scene"]).where("scene = 'a'").first()
    assert p["mission"] == "S1A" and p["lines"] == 1001 and p["prf"] is None
    assert p["near_range"] == pytest.approx(0.005 * 299792458 / 2) and p["wavelength"] == pytest.approx(0.0554657, abs=1e-6)
    assert (p["end_time"] - p["start_time"]).total_seconds() == pytest.approx(2.0)
    assert annotation.long_parameters(docs, ["scene"]).where("scene = 'a' and name = 'direction'").first()["value"] == "Ascending"
    b = annotation.bursts(docs, ["scene"]).where("scene = 'a'").orderBy("burst").collect()
    assert [(x["byte_offset"], x["invalid_first"], x["invalid_last"], x["first_sample"]) for x in b] == [(10, 1, 1, 9), (20, 1, 1, 9)]
    assert annotation.state_vectors(docs, ["scene"]).where("scene = 'b'").count() == 4
    polys = annotation.polynomials(docs, ["scene"]).collect()
    assert {(x["scene"], x["kind"], x["c0"], x["c1"], x["c2"]) for x in polys} == {(s, *k) for s in "ab" for k in (("fm", -2300.0, 4.0, 5.0), ("dc", 1.0, 2.0, 3.0))}
