"""Queries over sources and sinks: tables are written to the shared folder and read back."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phasegrid.functions import geo, names
from phasegrid.operators import catalog, raster
from phasegrid.plans import bindings as b
from phasegrid.plans.bindings import r6, table
from phasegrid.session import shared_folder
from phasegrid.sources import register, text


def fresh(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str, **options: object) -> DataFrame:
    """``frame(r, c, values)`` through the raster sink and back; every part is a headered crop."""
    spark = frame.sparkSession
    register(spark)
    path = fresh(spark, name)
    path = urlparse(path).path if path.startswith("file:") else path
    given = {k: str(v) for k, v in options.items()}
    sink = {k: v for k, v in given.items() if k in ("dtype", "layout", "nrow", "ncol")}
    frame.repartitionByRange("r").write.format("raster").options(header="true", **sink).mode("append").save(path)
    source = {k: v for k, v in given.items() if k not in ("nrow", "ncol")}
    return spark.read.format("raster").options(header="true", suffix=".bin", **source).load(path)


def lines(frame: DataFrame, name: str, *columns: Column) -> str:
    """One line of text per row, fields separated by spaces; the path."""
    path = fresh(frame.sparkSession, name)
    frame.select(F.concat_ws(" ", *columns)).write.text(path)
    return path


def documents(elements: DataFrame, name: str, root: str, parts: int = 16) -> str:
    """XML documents of the elements in ``value``, dealt over ``parts`` files; the path."""
    path = fresh(elements.sparkSession, name)
    dealt = elements.groupBy(F.pmod(F.xxhash64("value"), F.lit(parts)).alias("part")).agg(F.array_join(F.sort_array(F.collect_list("value")), "").alias("v"))
    made = dealt.select("part", F.concat(F.lit(f"<{root}>"), "v", F.lit(f"</{root}>")).alias("value"))
    made.repartition("part").write.partitionBy("part").text(path)
    return f"{path}/part=*"


def add(query) -> None:
    """Register the queries with ``query`` of ``plans.queries``."""

    @query(f"WITH {b.PX} SELECT r::INTEGER AS r, c, v FROM px")
    def raster_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
        px = b.embedding_pixels(spark, sf_dir)
        back = written(px, "real", dtype="f8", nrow=b.rows_of(spark, sf_dir), ncol=b.COLS)
        return back.select("r", "c", "v")

    @query(f"WITH {b.Z} SELECT r::INTEGER AS r, c, round(re, 6) + 0e0 AS re, round(im, 6) + 0e0 AS im FROM z WHERE r >= 10 AND r < 60 AND c >= 3 AND c < 20")
    def raster_complex_window(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A window of a complex raster, as source options."""
        back = written(b.embedding_complex(spark, sf_dir), "complex", dtype="c8", nrow=b.rows_of(spark, sf_dir), ncol=32, window="10,60,3,20")
        return back.select("r", "c", r6(F.col("re").cast("double")).alias("re"), r6(F.col("im").cast("double")).alias("im"))

    @query(f"WITH {b.PX} SELECT r::INTEGER AS r, c, v FROM px WHERE r >= 100 AND r < 103")
    def raster_pushdown(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Comparisons of the row are pushed into the byte ranges that are read."""
        back = written(b.embedding_pixels(spark, sf_dir), "rows", dtype="f8", nrow=b.rows_of(spark, sf_dir), ncol=b.COLS)
        return back.where("r >= 100 and r < 103").select("r", "c", "v")

    for layout in ("altline", "altsample"):

        @query(f"WITH {b.PX} SELECT r::INTEGER AS r, c, v, -2 * v AS v2 FROM px", f"raster_{layout}")
        def two_bands(spark: SparkSession, sf_dir: str, layout: str = layout) -> DataFrame:
            px = b.embedding_pixels(spark, sf_dir).withColumn("v2", -2 * F.col("v"))
            return written(px, layout, dtype="f8", layout=layout, nrow=b.rows_of(spark, sf_dir), ncol=b.COLS).select("r", "c", "v", "v2")

    @query(f"WITH {b.Z} SELECT r::INTEGER AS r, c, trunc(re * 10000)::INTEGER AS re, trunc(im * 10000)::INTEGER AS im FROM z")
    def raster_short_complex(spark: SparkSession, sf_dir: str) -> DataFrame:
        z = b.embedding_complex(spark, sf_dir).select("r", "c", *[(F.col(n) * 10000).cast("int").alias(n) for n in ("re", "im")])
        back = written(z, "short", dtype="ci2", nrow=b.rows_of(spark, sf_dir), ncol=32)
        return back.select("r", "c", F.col("re").cast("int").alias("re"), F.col("im").cast("int").alias("im"))

    @query(f"WITH {b.PX}, q AS (SELECT r::INTEGER AS r, c, trunc(v * 1000)::INTEGER AS v FROM px) SELECT r, c, v AS i4, v AS i2, (abs(v) % 256)::INTEGER AS u1 FROM q")
    def raster_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
        px = b.embedding_pixels(spark, sf_dir).select("r", "c", (F.col("v") * 1000).cast("int").alias("v"))
        size = {"nrow": b.rows_of(spark, sf_dir), "ncol": b.COLS}
        kinds = {"i4": px, "i2": px, "u1": px.withColumn("v", F.abs("v") % 256)}
        read = [written(f, k, dtype=k, **size).select("r", "c", F.col("v").cast("int").alias(k)) for k, f in kinds.items()]
        return read[0].join(read[1], ["r", "c"]).join(read[2], ["r", "c"])

    @query(f"SELECT {b.N_ROWS}::INTEGER AS nrow, 64 AS ncol, 0 AS \"left\", 64 AS \"right\", 0 AS top, {b.N_ROWS}::INTEGER AS bottom")
    def raster_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The extents of the parts, read from their headers alone, cover the raster."""
        rows = b.rows_of(spark, sf_dir)
        heads = written(b.embedding_pixels(spark, sf_dir), "heads", dtype="f8", nrow=rows, ncol=b.COLS, mode="header")
        return heads.groupBy("nrow", "ncol", "left", "right").agg(F.min("top").alias("top"), F.max("bottom").alias("bottom"))

    @query("SELECT c_custkey::DOUBLE AS t, c_acctbal AS x, c_custkey * 2e0 AS vz FROM customer")
    def orbit_text(spark: SparkSession, sf_dir: str) -> DataFrame:
        c, zero = table(spark, sf_dir, "customer"), F.lit("0")
        path = lines(c, "orbit", F.col("c_custkey").cast("string"), F.col("c_acctbal").cast("string"), zero, zero, zero, zero, (F.col("c_custkey") * 2).cast("string"))
        return text.orbits(spark, path).select("t", "x", "vz")

    @query("SELECT s_suppkey::DOUBLE AS t, 0.005e0 AS t0, s_acctbal AS c0, s_nationkey::DOUBLE AS c1, -1e0 AS c2 FROM supplier")
    def polynomial_text(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = table(spark, sf_dir, "supplier")
        path = lines(s, "poly", F.col("s_suppkey").cast("string"), F.lit("0.005"), F.col("s_acctbal").cast("string"), F.col("s_nationkey").cast("string"), F.lit("-1"))
        return text.polynomials(spark, path).drop("file")

    @query("SELECT 'KEY_' || n_nationkey AS key, n_regionkey::VARCHAR AS value FROM nation")
    def rsc_sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = lines(table(spark, sf_dir, "nation"), "rsc", F.concat(F.lit("KEY_"), F.col("n_nationkey").cast("string")), F.col("n_regionkey").cast("string"))
        return text.rsc(spark, path).select("key", "value")

    @query(
        "WITH d AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS date FROM orders) "
        "SELECT a.date AS date1, b.date AS date2, (b.date - a.date)::INTEGER AS days, (b.date - a.date) * -0.5e0 AS bperp FROM d a JOIN d b ON b.date - a.date BETWEEN 6 AND 100"
    )
    def pair_list_file(spark: SparkSession, sf_dir: str) -> DataFrame:
        pairs = b.month_pairs(spark, sf_dir).select("date1", "date2", F.datediff("date2", "date1").alias("days"))
        day = lambda c: F.date_format(c, "yyyyMMdd")
        path = lines(pairs, "pairs", day("date1"), day("date2"), F.col("days").cast("string"), (F.col("days") * -0.5).cast("string"))
        return text.pair_list(spark, path)

    @query("SELECT 's' || s_suppkey AS ref, 'n' || s_nationkey AS sec, 'out' || (s_suppkey % 7) AS out FROM supplier WHERE s_suppkey % 3 <> 0")
    def task_list_file(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Every third line has a field too few and is dropped."""
        k = F.col("s_suppkey")
        third = F.when(k % 3 != 0, F.concat(F.lit("out"), (k % 7).cast("string")))
        path = lines(table(spark, sf_dir, "supplier"), "tasks", F.concat(F.lit("s"), k.cast("string")), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")), third)
        return text.task_list(spark, path)

    @query(
        "SELECT 'scene' || (c_custkey % 40) AS scene, min(c_custkey) AS first_key, min(c_custkey) % 100 - 50e0 AS west, min(c_custkey) % 100 - 48e0 AS east FROM customer GROUP BY 1"
    )
    def geojson_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Features through the GeoJSON sink and source; the first of a scene stays, with its box."""
        k = F.col("c_custkey")
        west = k % 100 - F.lit(50.0)
        point = lambda dx, dy: F.array(west + dx, F.lit(0.0) + dy)
        name = F.concat(F.lit("scene"), (k % 40).cast("string"))
        props = F.to_json(F.struct(name.alias("sceneName"), F.concat(name, F.lit("-id")).alias("fileID"), k.alias("key")))
        features = table(spark, sf_dir, "customer").select(k, F.array(F.array(point(0, 0), point(2, 0), point(2, 1), point(0, 0))).alias("rings"), props.alias("properties"))
        path = fresh(spark, "scenes")
        listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "value"))), lambda x: x["value"]), ",")
        made = text.to_geojson(features).withColumn("c_custkey", F.get_json_object("value", "$.properties.key").cast("long"))
        whole = made.agg(listed.alias("l")).select(F.concat(F.lit('{"type": "FeatureCollection", "features": ['), "l", F.lit("]}")))
        whole.write.text(path)
        scenes = text.merged_scenes(text.geojson(spark, path))
        boxes = catalog.footprint(scenes, ["scene"], "rings").select("scene", "west", "east")
        keys = scenes.select("scene", F.get_json_object("properties", "$.key").cast("long").alias("first_key"))
        return keys.join(boxes, "scene")

    @query("SELECT 'p' || p_partkey || '&co' AS name, 'http://host/' || p_size AS url, md5(p_brand) AS md5, p_size::BIGINT AS size FROM part")
    def metalink_links(spark: SparkSession, sf_dir: str) -> DataFrame:
        p = table(spark, sf_dir, "part")
        rows = p.select(
            F.concat(F.lit("p"), F.col("p_partkey").cast("string"), F.lit("&co")).alias("name"), F.concat(F.lit("http://host/"), F.col("p_size").cast("string")).alias("url"),
            F.md5("p_brand").alias("md5"), F.col("p_size").cast("long").alias("size"),
        )
        path = documents(text.to_metalink(rows), "links", "files")
        return text.metalink(spark, path).select("name", "url", "md5", "size")

    @query(
        "WITH t AS (SELECT c_custkey AS k, TIMESTAMP '2020-01-01 00:00:00' + INTERVAL (c_custkey * 10) SECOND AS tt FROM customer) "
        "SELECT k::DOUBLE AS x, k * 2e0 AS vz FROM t WHERE tt BETWEEN TIMESTAMP '2020-01-01 00:09:50' AND TIMESTAMP '2020-01-01 00:20:10'"
    )
    def precise_orbit_window(spark: SparkSession, sf_dir: str) -> DataFrame:
        """State vectors of an orbit file within a scene's time and ten seconds around it."""
        k = F.col("c_custkey")
        at = F.date_format(F.timestamp_seconds(F.lit(1577836800) + k * 10), "'UTC='yyyy-MM-dd'T'HH:mm:ss")
        field = lambda n, v: F.concat(F.lit(f"<{n}>"), v.cast("string"), F.lit(f"</{n}>"))
        one = F.concat(F.lit("<OSV>"), field("UTC", at), *[field(n, k * (2 if n == "VZ" else 1)) for n in ("X", "Y", "Z", "VX", "VY", "VZ")], F.lit("</OSV>"))
        path = documents(table(spark, sf_dir, "customer").select(one.alias("value")), "eof", "List")
        stamp = lambda t: F.lit(f"2020-01-01 {t}").cast("timestamp")
        return text.precise_orbit(spark, path, stamp("00:10:00"), stamp("00:20:00")).select("x", "vz")

    @query(
        "WITH n AS (SELECT s_suppkey AS k, DATE '2020-01-01' + (s_suppkey % 300)::INTEGER AS d FROM supplier) "
        "SELECT k, d + INTERVAL 82782 SECOND AS start, d + INTERVAL (2 * 86400 + 3600) SECOND AS stop, 'S1A' AS mission, strftime(d, '%Y%m%d') AS date, (k % 3 + 1)::INTEGER AS iw, (k % 9)::INTEGER AS burst FROM n"
    )
    def name_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Validity times of orbit file names, fields of product and burst names."""
        k = F.col("s_suppkey")
        day = lambda plus: F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (k % 300).cast("int") + plus), "yyyyMMdd")
        s = table(spark, sf_dir, "supplier").select(
            k.alias("k"), F.concat(F.lit("S1A_OPER_AUX_POEORB_V"), day(0), F.lit("T225942_"), day(2), F.lit("T010000.EOF")).alias("eof"),
            F.concat(F.lit("S1A_IW_SLC__1SDV_"), day(0), F.lit("T030405_"), day(0), F.lit("T030432_030639_0382D5_DE12.zip")).alias("product"),
            F.concat(F.lit("/x/"), day(0), F.lit("_S1A_DE12_iw"), (k % 3 + 1).cast("string"), F.lit("_burst_"), (k % 9).cast("string"), F.lit(".gslc")).alias("burst"),
        )
        files = text.orbit_files(s, "eof").withColumnRenamed("eof", "e")
        made = s.join(files.distinct(), s["eof"] == files["e"])
        p, q = names.product_parts(F.col("product")), names.burst_parts(F.col("burst"))
        wall = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
        return made.select("k", wall("start"), wall("stop"), p["mission"].alias("mission"), p["date"].alias("date"), q["iw"].alias("iw"), q["burst"].alias("burst"))

    @query(
        "WITH g AS (SELECT s_suppkey AS k, (s_suppkey % 20)::INTEGER AS a, (s_suppkey % 13)::INTEGER AS o FROM supplier) "
        "SELECT k, round(45 - a * 0.25e0, 6) AS lat, round(7 + o * 0.5e0, 6) AS lon, a AS row_, o AS col_, a < 12 AND o < 9 AS inside, round(45 + (2 - 1) / 2e0 * -0.25 - (a // 2) * 0.5, 6) + 0e0 AS looked_lat FROM g"
    )
    def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A grid through its side-car: cells to places and back, and the grid of its looks."""
        grid = geo.Grid.from_rsc(geo.Grid(12, 9, 7.0, 45.0, 0.5, -0.25).to_rsc())
        looks = grid.looks(2, 1)
        k = F.col("s_suppkey")
        cell = table(spark, sf_dir, "supplier").select(k.alias("k"), (k % 20).cast("int").alias("a"), (k % 13).cast("int").alias("o"))
        lat, lon = grid.lat(F.col("a")), grid.lon(F.col("o"))
        row, col = grid.row(lat), grid.col(lon)
        return cell.select(
            "k", r6(lat).alias("lat"), r6(lon).alias("lon"), row.alias("row_"), col.alias("col_"), grid.inside(row, col).alias("inside"),
            r6(looks.lat(F.floor(F.col("a") / 2))).alias("looked_lat"),
        )

    @query(
        "WITH c AS (SELECT c_custkey % 10 AS g, c_custkey % 100 - 50e0 AS w, c_custkey % 60 + 0e0 AS s FROM customer) "
        "SELECT round(least(median(w), median(w)), 6) + 0e0 AS west, round(median(w) + 0.5, 6) + 0e0 AS east, 3600 AS ncol, 1800 AS nrow FROM c"
    )
    def corner_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The grid of scene corners by their medians."""
        k = F.col("c_custkey")
        w, s = k % 100 - F.lit(50.0), k % 60 + F.lit(0.0)
        corners = table(spark, sf_dir, "customer").select(
            w.alias("lon_ul"), (w + 0.5).alias("lon_ur"), w.alias("lon_ll"), (w + 0.5).alias("lon_lr"),
            (s + 0.25).alias("lat_ul"), (s + 0.25).alias("lat_ur"), s.alias("lat_ll"), s.alias("lat_lr"),
        )
        grid = text.grid_from_corners(corners)
        return grid.select(r6(F.col("west")).alias("west"), r6(F.col("east")).alias("east"), "ncol", "nrow")

    @query(
        f"WITH {b.PX} SELECT r // 50 AS img, count(*) AS n, round(sum(v), 6) + 0e0 AS total, 'embedding' AS kind FROM px GROUP BY ALL"
    )
    def image_store(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A stack in a store partitioned by image, with its attributes in a side-car."""
        px = b.embedding_pixels(spark, sf_dir).withColumn("img", F.expr("r div 50"))
        path = fresh(spark, "store")
        raster.write_store(px, path, "img", {"kind": "embedding", "posting": 0.5})
        read, attributes = raster.read_store(spark, path)
        return read.groupBy("img").agg(F.count("*").alias("n"), r6(F.sum("v")).alias("total")).withColumn("kind", F.lit(attributes["kind"]))

    @query(f"WITH {b.PX} SELECT (r - 20)::INTEGER AS r, (c - 40)::INTEGER AS c, v FROM px WHERE r >= 20 AND r < 30 AND c >= 40 UNION ALL SELECT x.i::INTEGER, y.i::INTEGER, 0e0 FROM range(10) x(i), range(24, 40) y(i)")
    def zero_filled_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A crop that reaches beyond the raster: cells without data are 0."""
        return raster.crop_filled(b.embedding_pixels(spark, sf_dir), 20, 30, 40, 80, "v")

    @query(
        "WITH d AS (SELECT doc_id, 'f' || (doc_id % 97) AS stem FROM documents), p AS (SELECT DISTINCT 'f' || (page_id % 61) AS stem FROM pages) "
        "SELECT doc_id, d.stem AS stem, p.stem IS NOT NULL AS present FROM d LEFT JOIN p ON p.stem = d.stem"
    )
    def catalog_files(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Catalogue rows and the files that lie in a folder, by the name without folder and suffix."""
        docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("f"), (F.col("doc_id") % 97).cast("string")).alias("stem"))
        files = table(spark, sf_dir, "pages").select(F.concat(F.lit("/data/x/f"), (F.col("page_id") % 61).cast("string"), F.lit(".zip")).alias("path"))
        return catalog.with_files(docs, "stem", files, "path").select("doc_id", "stem", F.col("path").isNotNull().alias("present"))
