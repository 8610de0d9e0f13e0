"""One registered query per relational operator, next to the SQL that gives the same rows."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phasegrid.functions import cplx, geo, names
from phasegrid.functions import sql as sql_functions
from phasegrid.operators import catalog, interferograms, joins, orbit, raster, similarity, timeseries, unwrapping
from phasegrid.plans import bindings as b
from phasegrid.plans import drivers, network, source_queries
from phasegrid.plans.bindings import r6, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
LAMBDA = timeseries.WAVELENGTH
PX = ["px"]
LOOKS = (10, 4)


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE[name or f.__name__] = sql
        return f

    return add


# ---- networks and time series -------------------------------------------------------------------


@query(f"""WITH {b.KEPT}
SELECT p.px, coalesce(n, 0) AS n, round(coalesce(u / (bl + 1e-6) * ({LAMBDA!r}::DOUBLE / (4 * pi()) * 365.25::DOUBLE), 0), 6) + 0e0 AS velocity
FROM (SELECT DISTINCT px FROM unw) p LEFT JOIN (SELECT px, count(*) AS n, sum(u) AS u, sum(days::DOUBLE) AS bl FROM kept GROUP BY px) k ON k.px = p.px""")
def stack_velocity_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = timeseries.stack_velocity(b.observations(spark, sf_dir), PX, scale=3.0)
    return out.select("px", F.col("n").cast("long").alias("n"), r6(F.col("velocity")).alias("velocity"))


@query(f"WITH {b.VEL} SELECT px, k, round(v, 9) + 0e0 AS v FROM vel")
def interval_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = timeseries.interval_velocity(b.observations(spark, sf_dir), PX)
    return out.select("px", "k", (F.round("v", 9) + 0.0).alias("v"))


@query(f"WITH {b.MAD} SELECT px, k, dev, mad, outlier FROM mad")
def mad_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    velocity = timeseries.interval_velocity(b.observations(spark, sf_dir), PX)
    return timeseries.mad_outliers(velocity, PX, 3.0).select("px", "k", "dev", "mad", "outlier")


@query(f"WITH {b.KEPT} SELECT px, date1, date2, round(u, 9) + 0e0 AS u FROM kept")
def screened_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeseries.screened(b.observations(spark, sf_dir), PX, 3.0).select("px", "date1", "date2", (F.round("u", 9) + 0.0).alias("u"))


@query(f"WITH {b.UNW} SELECT px, round(sum(days::DOUBLE * u) / sum(days::DOUBLE * days), 9) + 0e0 AS rate FROM unw GROUP BY px")
def sbas_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = timeseries.sbas_linear(b.observations(spark, sf_dir), PX)
    return out.select("px", (F.round("rate", 9) + 0.0).alias("rate"))


def _seasonal_sql() -> str:
    m = {f"{i}{j}": f"sum(g{i} * g{j})" + (" + 1e-3" if i == j else "") for i in range(3) for j in range(i, 3)}
    parts = ", ".join(f"{v} AS m{k}" for k, v in m.items()) + ", " + ", ".join(f"sum(g{i} * u) AS d{i}" for i in range(3))
    at = [[f"m{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]

    def det(x: list[list[str]]) -> str:
        p, q, r = x
        return f"({p[0]} * ({q[1]} * {r[2]} - {q[2]} * {r[1]}) - {p[1]} * ({q[0]} * {r[2]} - {q[2]} * {r[0]}) + {p[2]} * ({q[0]} * {r[1]} - {q[1]} * {r[0]}))"

    solved = [det([[f"d{i}" if j == k else at[i][j] for j in range(3)] for i in range(3)]) for k in range(3)]
    columns = ", ".join(f"round({s} / {det(at)}, 6) + 0e0 AS {n}" for s, n in zip(solved, ("rate", "sine", "cosine"), strict=True))
    turn = repr(2 * math.pi / 365.25)
    return f"""WITH {b.UNW}, g AS (SELECT px, u, (t2 - t1) / 365.25::DOUBLE AS g0, sin(t2 * {turn}::DOUBLE) - sin(t1 * {turn}::DOUBLE) AS g1,
  cos(t2 * {turn}::DOUBLE) - cos(t1 * {turn}::DOUBLE) AS g2 FROM unw), m AS (SELECT px, {parts} FROM g GROUP BY px)
SELECT px, {columns} FROM m"""


@query(_seasonal_sql())
def sbas_seasonal_k1(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = b.months(spark, sf_dir)
    obs = b.observations(spark, sf_dir)
    obs = obs.join(days.select(F.col("date").alias("date1"), F.col("days").alias("t1")), "date1").join(
        days.select(F.col("date").alias("date2"), F.col("days").alias("t2")), "date2"
    )
    out = timeseries.sbas_seasonal(obs, PX, F.col("t1"), F.col("t2"))
    return out.select("px", *[r6(F.col(c)).alias(c) for c in ("rate", "sine", "cosine")])


@query(f"""WITH {b.VEL} SELECT px, (k + 1)::INTEGER AS idx, round(sum(v * dt) OVER (PARTITION BY px ORDER BY k), 6) + 0e0 AS disp FROM vel JOIN steps USING (k)""")
def cumulative_displacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    velocity = timeseries.interval_velocity(b.observations(spark, sf_dir), PX)
    out = timeseries.cumulative(velocity, network.intervals(b.months(spark, sf_dir)), PX)
    return out.select("px", "idx", r6(F.col("disp")).alias("disp"))


DAYS = "days AS (SELECT DISTINCT o_orderdate::DATE AS date FROM orders)"


@query(f"WITH {DAYS} SELECT (row_number() OVER (ORDER BY date) - 1)::INTEGER AS idx, date FROM days")
def date_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.date_index(b.order_days(spark, sf_dir)).select("idx", "date")


@query(f"WITH {DAYS} SELECT date, (date - min(date) OVER ())::INTEGER AS days FROM days")
def days_since_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.date_index(b.order_days(spark, sf_dir)).select("date", "days")


@query(f"WITH {DAYS}, s AS (SELECT date AS start, lead(date) OVER (ORDER BY date) AS stop FROM days) SELECT start, stop, (stop - start)::INTEGER AS dt FROM s WHERE stop IS NOT NULL")
def date_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.intervals(network.date_index(b.order_days(spark, sf_dir))).select("start", F.col("end").alias("stop"), "dt")


@query(f"WITH {DAYS} SELECT a.date AS date1, b.date AS date2, (b.date - a.date)::INTEGER AS days FROM days a JOIN days b ON b.date - a.date BETWEEN 6 AND 60")
def slc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.pairs_within(b.order_days(spark, sf_dir), "date", 6, 60)


@query(f"WITH {b.PAIRS} SELECT date1, date2, i1 AS idx, -1 AS sign FROM pairs UNION ALL SELECT date1, date2, i2, 1 FROM pairs")
def design_matrix_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.incidence(b.month_pairs(spark, sf_dir))


@query(f"WITH {b.PAIRS} SELECT date1, date2, k, dt FROM (SELECT date1, date2, unnest(range(i1, i2))::INTEGER AS k FROM pairs) JOIN steps USING (k)")
def design_matrix_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.integration(b.month_pairs(spark, sf_dir), network.intervals(b.months(spark, sf_dir)))


@query(f"WITH {b.PAIRS} SELECT sum(dt::BIGINT * dt)::BIGINT AS scale FROM (SELECT unnest(range(i1, i2))::INTEGER AS k FROM pairs) JOIN steps USING (k)")
def reg_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.regularisation_scale(network.integration(b.month_pairs(spark, sf_dir), network.intervals(b.months(spark, sf_dir))))


# ---- raster algebra -----------------------------------------------------------------------------


@query(f"""WITH {b.PX} SELECT r // 10 AS br, (c // 4)::INTEGER AS bc, round(sum(v) / 40.0::DOUBLE, 6) + 0e0 AS v
FROM px WHERE r < {b.N_ROWS} // 10 * 10 GROUP BY ALL""")
def multilook_real(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = raster.multilook(b.embedding_pixels(spark, sf_dir), b.rows_of(spark, sf_dir), 64, LOOKS, ["v"])
    return out.select("br", "bc", r6(F.col("v")).alias("v"))


@query(f"""WITH {b.PX} SELECT r // 10 AS br, (c // 4)::INTEGER AS bc, trunc(round(sum(trunc(v * 10000)::BIGINT) / 40.0::DOUBLE, 6))::INTEGER AS v
FROM px WHERE r < {b.N_ROWS} // 10 * 10 GROUP BY ALL""")
def multilook_dem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heights are the embedding values in steps of 1/10000."""
    heights = b.embedding_pixels(spark, sf_dir).withColumn("v", (F.col("v") * 10000).cast("long"))
    return raster.multilook_short(heights, b.rows_of(spark, sf_dir), 64, LOOKS, "v").withColumn("v", F.col("v").cast("int"))


@query(f"""WITH {b.Z} SELECT r // 10 AS br, (c // 4)::INTEGER AS bc, round(sum(re) / 40.0::DOUBLE, 6) + 0e0 AS re, round(sum(im) / 40.0::DOUBLE, 6) + 0e0 AS im
FROM z WHERE r < {b.N_ROWS} // 10 * 10 GROUP BY ALL""")
def multilook_complex(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = raster.multilook(b.embedding_complex(spark, sf_dir), b.rows_of(spark, sf_dir), 32, LOOKS, ["re", "im"])
    return out.select("br", "bc", r6(F.col("re")).alias("re"), r6(F.col("im")).alias("im"))


@query(f"""WITH {b.Z} SELECT r // 10 AS br, (c // 4)::INTEGER AS bc, round(sum(re * re + im * im) / 40.0::DOUBLE, 6) + 0e0 AS power
FROM z WHERE r < {b.N_ROWS} // 10 * 10 GROUP BY ALL""")
def power_looks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = raster.power_looks(b.embedding_complex(spark, sf_dir), b.rows_of(spark, sf_dir), 32, LOOKS)
    return out.select("br", "bc", r6(F.col("power")).alias("power"))


@query(f"""WITH {b.Z} SELECT r // 10 AS br, (c // 4)::INTEGER AS bc, round(sqrt(sum(re * re + im * im) / 40.0::DOUBLE), 6) + 0e0 AS amp
FROM z WHERE r < {b.N_ROWS} // 10 * 10 GROUP BY ALL""")
def amp_looks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = raster.amplitude_looks(b.embedding_complex(spark, sf_dir), b.rows_of(spark, sf_dir), 32, LOOKS)
    return out.select("br", "bc", r6(F.col("amp")).alias("amp"))


IFG_SQL = b.Z + ", ifg AS (SELECT x.r // 2 AS r, x.c, x.re * y.re + x.im * y.im AS re, x.re * y.im - x.im * y.re AS im FROM z x JOIN z y ON y.r = x.r + 1 AND y.c = x.c WHERE x.r % 2 = 0)"


def _ifg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image row 2r against row 2r + 1."""
    z = b.embedding_complex(spark, sf_dir)
    half = z.withColumn("half", F.col("r") % 2).withColumn("r", F.expr("r div 2"))
    return interferograms.form(half.where("half = 0").drop("half"), half.where("half = 1").drop("half"))


@query(f"WITH {IFG_SQL} SELECT r, c, round(re, 6) + 0e0 AS re, round(im, 6) + 0e0 AS im FROM ifg")
def interferogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ifg(spark, sf_dir).select("r", "c", r6(F.col("re")).alias("re"), r6(F.col("im")).alias("im"))


@query(f"""WITH {b.Z}, a AS (SELECT r // 2 AS r, c, re, im FROM z WHERE r % 2 = 0 AND c < 24), d AS (SELECT r // 2 AS r, c, re, im FROM z WHERE r % 2 = 1 AND c >= 8)
SELECT r, c, round(coalesce(a.re, 0) * coalesce(d.re, 0) + coalesce(a.im, 0) * coalesce(d.im, 0), 6) + 0e0 AS re,
  round(coalesce(a.re, 0) * coalesce(d.im, 0) - coalesce(a.im, 0) * coalesce(d.re, 0), 6) + 0e0 AS im FROM a FULL JOIN d USING (r, c)""")
def interferogram_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = b.embedding_complex(spark, sf_dir).withColumn("half", F.col("r") % 2).withColumn("r", F.expr("r div 2"))
    out = interferograms.form_union(z.where("half = 0 and c < 24"), z.where("half = 1 and c >= 8"))
    return out.select("r", "c", r6(F.col("re")).alias("re"), r6(F.col("im")).alias("im"))


@query(f"""WITH {IFG_SQL}, l AS (SELECT r // 5 AS br, (c // 4)::INTEGER AS bc, sum(re) / 20.0::DOUBLE AS re, sum(im) / 20.0::DOUBLE AS im
  FROM ifg WHERE r < {b.N_ROWS} // 2 // 5 * 5 GROUP BY ALL) SELECT br, bc, round(atan2(im, re), 6) + 0e0 AS phase FROM l""")
def interferogram_looks_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = interferograms.looked(_ifg(spark, sf_dir), b.rows_of(spark, sf_dir) // 2, 32, (5, 4), phase_only=True)
    return out.select("br", "bc", r6(F.col("phase")).alias("phase"))


@query(f"""WITH {b.Z}, img AS (SELECT (r % 10)::INTEGER AS d, r // 10 AS r, c, re, im FROM z), p AS (SELECT x.d AS date1, y.d AS date2, x.r, x.c, x.re * y.re + x.im * y.im AS re, x.re * y.im - x.im * y.re AS im
  FROM img x JOIN img y ON y.d = x.d + 1 AND y.r = x.r AND y.c = x.c),
 l AS (SELECT date1, date2, r // 5 AS br, (c // 4)::INTEGER AS bc, sum(re) / 20.0::DOUBLE AS re, sum(im) / 20.0::DOUBLE AS im FROM p WHERE r < {b.N_ROWS} // 10 // 5 * 5 GROUP BY ALL),
 a AS (SELECT d, r // 5 AS br, (c // 4)::INTEGER AS bc, sqrt(sum(re * re + im * im) / 20.0::DOUBLE) AS amp FROM img WHERE r < {b.N_ROWS} // 10 // 5 * 5 GROUP BY ALL),
 q AS (SELECT date1, date2, l.br, l.bc, x.amp * y.amp AS amp, sqrt(re * re + im * im) / (x.amp + 1e-12) / (y.amp + 1e-12) AS coh
  FROM l JOIN a x ON x.d = date1 AND x.br = l.br AND x.bc = l.bc JOIN a y ON y.d = date2 AND y.br = l.br AND y.bc = l.bc)
SELECT date1, date2, br, bc, round(amp, 6) + 0e0 AS amp, CASE WHEN coh <= 1 THEN round(coh, 6) + 0e0 END AS coherence FROM q""")
def coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten images: row modulo 10 is the date."""
    img = b.embedding_complex(spark, sf_dir).withColumn("d", (F.col("r") % 10).cast("int")).withColumn("r", F.expr("r div 10"))
    n = b.rows_of(spark, sf_dir) // 10
    first = img.withColumn("date1", F.col("d")).withColumn("date2", F.col("d") + 1).drop("d")
    second = img.withColumn("date1", F.col("d") - 1).withColumn("date2", F.col("d")).drop("d")
    ifg = interferograms.form(first, second, ["date1", "date2", "r", "c"])
    ifg = interferograms.looked(ifg, n, 32, (5, 4), keys=["date1", "date2"])
    amps = raster.amplitude_looks(img.withColumnRenamed("d", "date"), n, 32, (5, 4), ["date"])
    out = interferograms.coherence(ifg, amps, keys=["br", "bc"])
    return out.select("date1", "date2", "br", "bc", r6(F.col("amp")).alias("amp"), r6(F.col("coherence")).alias("coherence"))


def _layers_sql(pick: str) -> str:
    return f"WITH {b.PX}, l AS (SELECT r // 100 AS layer, (r % 100)::INTEGER AS r, c, v FROM px WHERE v > 0.1) SELECT r, c, {pick}(v, layer) AS v FROM l GROUP BY ALL"


def _layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = b.embedding_pixels(spark, sf_dir)
    return px.withColumn("layer", F.expr("r div 100")).withColumn("r", (F.col("r") % 100).cast("int"))


@query(_layers_sql("min_by"))
def priority_mosaic_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.mosaic(_layers(spark, sf_dir), "layer", ["v"], F.col("v") > 0.1)


@query(_layers_sql("max_by"))
def priority_mosaic_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.mosaic(_layers(spark, sf_dir), "layer", ["v"], F.col("v") > 0.1, last_wins=True)


@query(f"WITH {b.PX} SELECT (r % 7)::INTEGER AS img, min(r) AS top, max(r) AS bottom, count(DISTINCT r) AS n_rows FROM px WHERE v > 0.3 GROUP BY ALL")
def valid_row_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.row_extent(b.embedding_pixels(spark, sf_dir).withColumn("img", (F.col("r") % 7).cast("int")), F.col("v") > 0.3, ["img"])


@query(f"""WITH {b.PX}, k AS (SELECT DISTINCT r // 250 AS img, r FROM px WHERE v > 0.3), i AS (SELECT img, r, r - row_number() OVER (PARTITION BY img ORDER BY r) AS g FROM k)
SELECT img, min(r) AS top, max(r) + 1 AS bottom, count(*) AS n_rows FROM i GROUP BY img, g""")
def strip_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.strips(b.embedding_pixels(spark, sf_dir).withColumn("img", F.expr("r div 250")), F.col("v") > 0.3, ["img"])


@query("""WITH n AS (SELECT ts::DATE AS day, count(*) FILTER (WHERE value > 20) AS n FROM events GROUP BY ALL), m AS (SELECT median(n) AS med FROM n)
SELECT day, n, med, round((med - n) / med, 6) + 0e0 AS lost, (med - n) > med * 0.1::DOUBLE AS flagged FROM n, m""")
def integrity_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "value")
    out = raster.completeness(days, "day", F.col("value") > 20, 0.1)
    return out.withColumn("lost", r6(F.col("lost")))


@query("""WITH n AS (SELECT user_id AS r, hour(ts)::INTEGER AS c, count(*) FILTER (WHERE value > 20) AS n FROM events GROUP BY ALL), m AS (SELECT median(n) AS med FROM n WHERE n > 0)
SELECT r, c, n, n > med AS valid FROM n, m""")
def validity_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "events").select(F.col("user_id").alias("r"), F.hour("ts").alias("c"), "value")
    return raster.validity_mask(cells, F.col("value") > 20)


@query(f"""WITH {b.PX} SELECT r // 50 AS img, round(sum(CASE WHEN v > 0 THEN v ELSE 0 END) / count(*), 6) + 0e0 AS ref
FROM px WHERE r % 50 >= 16 AND r % 50 < 25 AND c >= 28 AND c < 37 GROUP BY ALL""")
def reference_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = b.embedding_pixels(spark, sf_dir).withColumn("img", F.expr("r div 50")).withColumn("r", F.col("r") % 50)
    out = raster.reference_phase(stack, "img", "v", F.col("v") > 0, (20, 32), (9, 9), (50, 64))
    return out.select("img", r6(F.col("ref")).alias("ref"))


DELAYS_SQL = ", delays AS (SELECT n_nationkey AS date, n_nationkey * 0.001::DOUBLE + n_regionkey * 0.0003::DOUBLE AS delay FROM nation)"
WRAPPED_SQL = f"WITH {IFG_SQL}{DELAYS_SQL}, i AS (SELECT r, c, (r % 24)::INTEGER AS date1, (r % 24)::INTEGER + 1 AS date2, re, im FROM ifg), p AS (SELECT i.*, (x.delay - y.delay) / {LAMBDA!r}::DOUBLE * 4 * pi() AS ph FROM i JOIN delays x ON x.date = date1 JOIN delays y ON y.date = date2)"


def _delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.select(F.col("n_nationkey").alias("date"), (F.col("n_nationkey") * F.lit(0.001) + F.col("n_regionkey") * F.lit(0.0003)).alias("delay"))


def _dated_ifg(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = _ifg(spark, sf_dir).withColumn("date1", (F.col("r") % 24).cast("int"))
    return dated.withColumn("date2", F.col("date1") + 1)


@query(f"{WRAPPED_SQL} SELECT r, c, round(re * cos(-ph) - im * sin(-ph), 6) + 0e0 AS re, round(re * sin(-ph) + im * cos(-ph), 6) + 0e0 AS im FROM p")
def tropo_correct_wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = interferograms.correct_wrapped(_dated_ifg(spark, sf_dir), _delays(spark, sf_dir), LAMBDA, keys=[])
    return out.select("r", "c", r6(F.col("re")).alias("re"), r6(F.col("im")).alias("im"))


@query(f"{WRAPPED_SQL} SELECT r, c, round(atan2(im, re) - ph, 6) + 0e0 AS phase FROM p")
def tropo_correct_unwrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    phase = _dated_ifg(spark, sf_dir).withColumn("phase", cplx.angle(cplx.pair())).drop("re", "im")
    out = interferograms.correct_unwrapped(phase, _delays(spark, sf_dir), "phase", LAMBDA, keys=[])
    return out.select("r", "c", r6(F.col("phase")).alias("phase"))


@query(f"WITH {b.Z} SELECT r, c, CASE WHEN (CASE WHEN re > 0 THEN re ELSE 0 END) = 0 AND (CASE WHEN im > 0 THEN im ELSE 0 END) = 0 THEN 0 ELSE round(re + im, 6) + 0e0 END AS v FROM z")
def zero_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amplitude data is what is positive; negative values are no data."""
    z = b.embedding_complex(spark, sf_dir)
    values = z.select("r", "c", r6(F.col("re") + F.col("im")).alias("v"))
    positive = z.select("r", "c", F.greatest("re", F.lit(0.0)).alias("re"), F.greatest("im", F.lit(0.0)).alias("im"))
    return raster.zero_mask(values, positive, "v")


@query(f"WITH {b.PX} SELECT round(quantile_cont(v, 0.02), 6) + 0e0 AS low, round(quantile_cont(v, 0.98), 6) + 0e0 AS high FROM px")
def percentile_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = raster.stretch(b.embedding_pixels(spark, sf_dir), "v", 0.02, 0.98)
    return out.select(r6(F.col("low")).alias("low"), r6(F.col("high")).alias("high"))


@query(f"""WITH {b.PX}, o AS (SELECT a.i AS dr, e.i AS dc FROM range(-3, 4) a(i), range(-3, 4) e(i)), n AS (SELECT {b.N_ROWS} AS n),
 t AS (SELECT p.r, p.c, p.r + dr AS rr, p.c + dc AS cc, n FROM px p, o, n),
 m AS (SELECT r, c, CASE WHEN rr < 0 THEN -rr WHEN rr >= n THEN 2 * (n - 1) - rr ELSE rr END AS rr, CASE WHEN cc < 0 THEN -cc WHEN cc >= 64 THEN 126 - cc ELSE cc END AS cc FROM t)
SELECT m.r, m.c, round(avg(p.v), 6) + 0e0 AS v FROM m JOIN px p ON p.r = rr AND p.c = cc GROUP BY ALL""")
def box_mean_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = raster.box_mean(b.embedding_pixels(spark, sf_dir), b.rows_of(spark, sf_dir), 64, 3, "v")
    return out.select("r", "c", r6(F.col("v")).alias("v"))


@query(f"WITH {b.PX} SELECT r, c // 2 AS pixel, count(*) AS n, round(sum(v * (c % 2 + 1)), 6) + 0e0 AS weighted FROM px GROUP BY ALL")
def pixel_tubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tubes of two values each, read back by position."""
    px = b.embedding_pixels(spark, sf_dir).select("r", F.expr("c div 2").cast("int").alias("pixel"), (F.col("c") % 2).alias("k"), "v")
    tubes = raster.tubes(px, "k", "v", ["r", "pixel"])
    total = F.aggregate(F.transform("u", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return tubes.select("r", "pixel", F.size("u").cast("long").alias("n"), r6(total).alias("weighted"))


@query(f"""WITH {b.PX}, s AS (SELECT trunc(r / 3.0::DOUBLE)::INTEGER AS r2, trunc(c / 2.0::DOUBLE)::INTEGER AS c2, v, r * 64 + c AS ord FROM px)
SELECT r2, c2, max_by(v, ord) AS v FROM s GROUP BY ALL""")
def reproject_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = b.embedding_pixels(spark, sf_dir).withColumn("ord", F.col("r") * 64 + F.col("c"))
    return raster.reproject(px, F.col("r") / 3.0, F.col("c") / 2.0, "v", "ord", 1 << 30, 32)


@query(f"WITH {DAYS}, o AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n FROM days) SELECT DISTINCT date FROM o, range(8) t(j) WHERE i = (j * (n - 1)) // 7")
def evenly_spaced_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.evenly_spaced(b.order_days(spark, sf_dir), "date", 8)


@query(f"""WITH {b.PX}, g AS (SELECT r // 50 AS img, r, c, v FROM px), m AS (SELECT img, avg(r) AS r0, avg(c) AS c0, avg(v) AS v0 FROM g GROUP BY img),
 x AS (SELECT g.*, r - r0 AS x, c - c0 AS y, v0 FROM g JOIN m USING (img)), s AS (SELECT img, sum(x * x) AS xx, sum(x * y) AS xy, sum(y * y) AS yy, sum(x * v) AS xv, sum(y * v) AS yv FROM x GROUP BY img)
SELECT img, r, c, round(v - v0 - (xv * yy - yv * xy) / (xx * yy - xy * xy) * x - (yv * xx - xv * xy) / (xx * yy - xy * xy) * y, 6) + 0e0 AS v FROM x JOIN s USING (img)""")
def detrend_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = b.embedding_pixels(spark, sf_dir).withColumn("img", F.expr("r div 50"))
    return raster.detrend_plane(stack, "v", ["img"]).select("img", "r", "c", r6(F.col("v")).alias("v"))


# ---- complex and geodetic functions -------------------------------------------------------------


@query(f"""WITH {b.Z}, f AS (SELECT r, c, re, im, sqrt(re * re + im * im) AS m, 40 * re AS x FROM z)
SELECT r, c, round(CASE WHEN m > 1e-8 THEN re / m ELSE 0 END, 6) + 0e0 AS unit_re, round(CASE WHEN m > 1e-8 THEN im / m ELSE 0 END, 6) + 0e0 AS unit_im,
 round(x - 2 * pi() * floor(x / (2 * pi())), 6) + 0e0 AS positive, round(re - floor(re + 0.5::DOUBLE), 6) + 0e0 AS cycles,
 round(greatest(0, re - 0.1::DOUBLE) - greatest(0, -re - 0.1::DOUBLE), 6) + 0e0 AS soft, round(re * {LAMBDA!r}::DOUBLE / (4 * pi()), 9) + 0e0 AS metres FROM f""")
def complex_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = b.embedding_complex(spark, sf_dir)
    unit = cplx.unit(cplx.pair())
    re = F.col("re")
    return z.select(
        "r", "c", r6(unit[0]).alias("unit_re"), r6(unit[1]).alias("unit_im"), r6(cplx.wrap_positive(40 * re)).alias("positive"),
        r6(cplx.wrap_cycles(re)).alias("cycles"), r6(cplx.soft_threshold(re, 0.1)).alias("soft"), (F.round(cplx.displacement(re, LAMBDA), 9) + 0.0).alias("metres"),
    )


LLH_SQL = "p AS (SELECT c_custkey AS k, (c_custkey % 161) - 80 + 0.25::DOUBLE AS lat, (c_custkey % 353) - 176 + 0.5::DOUBLE AS lon, c_custkey % 9000 * 1.0::DOUBLE AS h FROM customer)"
XYZ_SQL = f"""{LLH_SQL}, n AS (SELECT *, {geo.MAJOR!r}::DOUBLE / sqrt(1 - {geo.E2!r}::DOUBLE * sin(radians(lat)) * sin(radians(lat))) AS e FROM p),
 x AS (SELECT *, (e + h) * cos(radians(lat)) * cos(radians(lon)) AS x, (e + h) * cos(radians(lat)) * sin(radians(lon)) AS y, (e * (1 - {geo.E2!r}::DOUBLE) + h) * sin(radians(lat)) AS z FROM n)"""


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("k"), ((k % 161) - 80 + F.lit(0.25)).alias("lat"), ((k % 353) - 176 + F.lit(0.5)).alias("lon"), (k % 9000).cast("double").alias("h"))


@query(f"WITH {XYZ_SQL} SELECT k, round(x, 4) + 0e0 AS x, round(y, 4) + 0e0 AS y, round(z, 4) + 0e0 AS z FROM x")
def llh_to_xyz(spark: SparkSession, sf_dir: str) -> DataFrame:
    xyz = geo.llh_to_xyz(F.col("lat"), F.col("lon"), F.col("h"))
    return _places(spark, sf_dir).select("k", *[(F.round(v, 4) + 0.0).alias(n) for v, n in zip(xyz, "xyz", strict=True)])


@query(f"WITH {LLH_SQL} SELECT k, round(lat, 6) + 0e0 AS lat, round(lon, 6) + 0e0 AS lon, round(h, 3) + 0e0 AS h FROM p")
def xyz_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = geo.xyz_to_llh(*geo.llh_to_xyz(F.col("lat"), F.col("lon"), F.col("h")))
    return _places(spark, sf_dir).select("k", *[(F.round(v, d) + 0.0).alias(n) for v, n, d in zip(back, ("lat", "lon", "h"), (6, 6, 3), strict=True)])


@query(f"""WITH {LLH_SQL}, s AS (SELECT *, sin(radians(lat)) AS s, radians(h % 360) AS hd FROM p), q AS (SELECT *, {geo.MAJOR!r}::DOUBLE / sqrt(1 - {geo.E2!r}::DOUBLE * s * s) AS e,
  {geo.MAJOR!r}::DOUBLE * (1 - {geo.E2!r}::DOUBLE) / pow(1 - {geo.E2!r}::DOUBLE * s * s, 1.5::DOUBLE) AS n FROM s)
SELECT k, round(e, 3) AS east, round(n, 3) AS north, round(e * n / (e * cos(hd) * cos(hd) + n * sin(hd) * sin(hd)), 3) AS along FROM q""")
def radii(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat = F.col("lat")
    made = (geo.radius_east(lat), geo.radius_north(lat), geo.radius_along(lat, F.col("h") % 360))
    return _places(spark, sf_dir).select("k", *[F.round(v, 3).alias(n) for v, n in zip(made, ("east", "north", "along"), strict=True)])


GRID = geo.Grid(1800, 3600, -180.0, 90.0, 0.1, -0.1)


@query(f"""WITH {LLH_SQL}, g AS (SELECT k, trunc((lat - 90.0::DOUBLE) / -0.1::DOUBLE)::INTEGER AS row, trunc((lon - -180.0::DOUBLE) / 0.1::DOUBLE)::INTEGER AS col FROM p)
SELECT k, row, col, row >= 0 AND row < 1800 AND col >= 0 AND col < 3600 AS inside FROM g""")
def latlon_to_rowcol(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _places(spark, sf_dir).select("k", GRID.row(F.col("lat")).alias("row"), GRID.col(F.col("lon")).alias("col"))
    return out.withColumn("inside", GRID.inside(F.col("row"), F.col("col")))


@query(f"""WITH {LLH_SQL}, q AS (SELECT a.k, radians(a.lat) AS a, radians(b.lat) AS b, radians(b.lon - a.lon) AS d FROM p a JOIN p b ON b.k = a.k + 1)
SELECT k, round(degrees(atan2(sin(d) * cos(b), cos(a) * sin(b) - sin(a) * cos(b) * cos(d))), 6) + 0e0 AS heading FROM q""")
def geodesic_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _places(spark, sf_dir)
    z = a.select((F.col("k") - 1).alias("k"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    return a.join(z, "k").select("k", r6(geo.heading(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))).alias("heading"))


def _vincenty_sql(rounds: int) -> str:
    """Each round of the longitude difference as one more table."""
    flat = f"{1 - math.sqrt(1 - geo.E2)!r}::DOUBLE"
    east, north = "c2 * sin(lon)", "(c1 * s2 - s1 * c2 * cos(lon))"
    out = f"""v AS (SELECT a.k, atan((1 - {flat}) * tan(radians(a.lat))) AS u, atan((1 - {flat}) * tan(radians(b.lat))) AS w, radians(b.lon - a.lon) AS d FROM p a JOIN p b ON b.k = a.k + 1),
 v0 AS (SELECT k, sin(u) AS s1, cos(u) AS c1, sin(w) AS s2, cos(w) AS c2, atan2(sin(d), cos(d)) AS apart, atan2(sin(d), cos(d)) AS lon FROM v)"""
    for i in range(rounds):
        out += f""", x{i} AS (SELECT *, sqrt(pow({east}, 2) + pow({north}, 2)) AS si, s1 * s2 + c1 * c2 * cos(lon) AS co FROM v{i}),
 y{i} AS (SELECT *, CASE WHEN si > 0 THEN c1 * {east} / si ELSE 0 END AS tilt FROM x{i}), z{i} AS (SELECT *, 1 - tilt * tilt AS rest FROM y{i}),
 m{i} AS (SELECT *, CASE WHEN rest > 1e-12 THEN co - 2 * s1 * s2 / rest ELSE 0 END AS mid, {flat} / 16 * rest * (4 + {flat} * (4 - 3 * rest)) AS sh FROM z{i}),
 v{i + 1} AS (SELECT k, s1, c1, s2, c2, apart, apart + (1 - sh) * {flat} * tilt * (atan2(si, co) + sh * si * (mid + sh * co * (2 * mid * mid - 1))) AS lon FROM m{i})"""
    return f"{out} SELECT k, round(degrees(atan2({east}, {north})), 6) + 0e0 AS heading FROM v{rounds}"


@query(f"WITH {LLH_SQL}, {_vincenty_sql(6)}")
def geodesic_heading_ellipsoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _places(spark, sf_dir)
    z = a.select((F.col("k") - 1).alias("k"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    return a.join(z, "k").select("k", r6(geo.heading_ellipsoid(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"), 6)).alias("heading"))


@query("""WITH q AS (SELECT s_suppkey AS k, (s_suppkey % 50) + 0.37::DOUBLE AS x, (s_suppkey % 30) + 0.41::DOUBLE AS y, (s_suppkey % 4) + 3.156::DOUBLE AS a, (s_suppkey % 3) + 2.253::DOUBLE AS b FROM supplier),
 pts AS (SELECT k, x - a AS lon, y AS lat FROM q UNION ALL SELECT k, x + a, y FROM q UNION ALL SELECT k, x, y - b FROM q UNION ALL SELECT k, x, y + b FROM q
  UNION ALL SELECT k, w, y + s * b * (1 - abs(w - x) / a) FROM q, (VALUES (20.0::DOUBLE), (40.0::DOUBLE)) u(w), (VALUES (1), (-1)) t(s) WHERE abs(w - x) <= a
  UNION ALL SELECT k, x + s * a * (1 - abs(n - y) / b), n FROM q, (VALUES (10.0::DOUBLE), (20.0::DOUBLE)) u(n), (VALUES (1), (-1)) t(s) WHERE abs(n - y) <= b
  UNION ALL SELECT k, w, n FROM q, (VALUES (20.0::DOUBLE), (40.0::DOUBLE)) u(w), (VALUES (10.0::DOUBLE), (20.0::DOUBLE)) t(n) WHERE abs(w - x) / a + abs(n - y) / b <= 1),
 e AS (SELECT k, min(lon) AS west, max(lon) AS east, min(lat) AS south, max(lat) AS north FROM pts WHERE lon BETWEEN 20 AND 40 AND lat BETWEEN 10 AND 20 GROUP BY k)
SELECT k, trunc(round((north - 20) / -0.1, 6))::INTEGER AS top, least(100, trunc(round((south - 20) / -0.1, 6))::INTEGER + 1) AS bottom,
 trunc(round((west - 20) / 0.1, 6))::INTEGER AS "left", least(200, trunc(round((east - 20) / 0.1, 6))::INTEGER + 1) AS "right" FROM e""")
def clipped_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of the part of each diamond that lies on the grid."""
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(k.alias("k"), ((k % 50) + 0.37).alias("x"), ((k % 30) + 0.41).alias("y"), ((k % 4) + 3.156).alias("a"), ((k % 3) + 2.253).alias("b"))
    x, y, a, z = (F.col(n) for n in ("x", "y", "a", "b"))
    ring = F.array(F.array(x - a, y), F.array(x, y - z), F.array(x + a, y), F.array(x, y + z))
    out = catalog.clipped_boxes(s.select("k", ring.alias("ring")), "ring", geo.Grid(100, 200, 20.0, 20.0, 0.1, -0.1))
    return out.drop("ring").where("top is not null")


@query("""WITH x AS (SELECT s_suppkey AS k, (s_suppkey % 50) * 1.0::DOUBLE AS w, (s_suppkey % 30) * 1.0::DOUBLE AS s FROM supplier),
 q AS (SELECT k, greatest(w, 20) AS west, greatest(s, 10) AS south, least(w + 5, 40) AS east, least(s + 5, 20) AS north FROM x)
SELECT k, west, south, east, north FROM q WHERE west < east AND south < north""")
def bbox_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), (F.col("s_suppkey") % 50).cast("double").alias("w"), (F.col("s_suppkey") % 30).cast("double").alias("s"))
    fixed = tuple(F.lit(float(v)) for v in (20, 10, 40, 20))
    box = geo.intersect((F.col("w"), F.col("s"), F.col("w") + 5, F.col("s") + 5), fixed)
    return s.select("k", box.alias("b")).where("b is not null").select("k", "b.*")


@query(f"""WITH {b.PX}, q AS (SELECT r, c, v, v * 20 AS x FROM px)
SELECT r, c, round(x - 2 * pi() * ceil((x - pi()) / (2 * pi())), 6) + 0e0 AS wrapped, round(v - floor(v + 0.5::DOUBLE), 6) + 0e0 AS cycles,
 round(greatest(0, v - 0.1::DOUBLE) - greatest(0, -v - 0.1::DOUBLE), 6) + 0e0 AS soft, trunc((v - 0.5::DOUBLE) / -0.01::DOUBLE)::INTEGER AS row_ FROM q""")
def functions_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query in SQL text over the registered functions."""
    sql_functions.register(spark)
    return spark.sql(
        """SELECT r, c, round(pg_wrap(v * 20), 6) + 0D AS wrapped, round(pg_wrap_cycles(v), 6) + 0D AS cycles,
        round(pg_soft_threshold(v, 0.1D), 6) + 0D AS soft, pg_row(v, 0.5D, -0.01D) AS row_ FROM {px}""",
        px=b.embedding_pixels(spark, sf_dir),
    )


# ---- joins and catalogues -----------------------------------------------------------------------


@query("""WITH w AS (SELECT n_nationkey AS file, TIMESTAMP '2024-01-01' + INTERVAL (n_nationkey * 30) HOUR AS lo, TIMESTAMP '2024-01-01' + INTERVAL (n_nationkey * 30 + 50) HOUR AS hi FROM nation)
SELECT event_id, min(file) AS file FROM events JOIN w ON ts BETWEEN lo AND hi GROUP BY event_id""")
def orbit_interval_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event gets the first orbit file whose validity holds its time."""
    base = 1704067200.0
    files = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("file"))
    files = files.withColumns({"lo": base + F.col("file") * 108000.0, "hi": base + F.col("file") * 108000.0 + 180000.0})
    events = table(spark, sf_dir, "events").select("event_id", (b.epoch_micros("ts") / 1e6).alias("at"))
    joined = joins.band_join(events, files, F.col("at"), F.col("lo"), F.col("hi"), 180000.0)
    return joins.first_match(joined, ["event_id"], ["file"], ["file"])


@query("""WITH b AS (SELECT p_partkey AS k, (p_partkey % 500)::BIGINT AS top, (p_partkey % 500)::BIGINT + p_size AS bottom, (p_partkey % 3)::INTEGER AS iw FROM part),
 d AS (SELECT x.iw, x.k AS l_id, min((abs(x.top - y.top) + abs(x.bottom - y.bottom), y.k)) AS m FROM b x JOIN b y ON y.iw = x.iw WHERE y.k <> x.k GROUP BY ALL)
SELECT iw, l_id, m[2] AS r_id, m[1] AS distance FROM d""")
def burst_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every box and the nearest other box of its subswath."""
    k = F.col("p_partkey")
    boxes = table(spark, sf_dir, "part").select(k.alias("k"), (k % 500).alias("top"), ((k % 500) + F.col("p_size")).alias("bottom"), (k % 3).cast("int").alias("iw"))
    return joins.nearest_boxes(boxes, boxes, ["iw"], "k", "k", other=True)


@query("""WITH d AS (SELECT epoch(ts::DATE)::DOUBLE + 43200 AS t, avg(value) AS v FROM events GROUP BY ts::DATE), e AS (SELECT event_id, epoch_us(ts) / 1e6 AS tt FROM events),
 k AS (SELECT t AS t0, lead(t) OVER (ORDER BY t) AS t1, v AS v0, lead(v) OVER (ORDER BY t) AS v1 FROM d), f AS (SELECT min(t) AS a, max(t) AS z, min_by(v, t) AS va, max_by(v, t) AS vz FROM d)
SELECT event_id, round(CASE WHEN tt <= a THEN va WHEN tt >= z THEN vz ELSE v0 + (tt - t0) / (t1 - t0) * (v1 - v0) END, 6) + 0e0 AS v
FROM e CROSS JOIN f LEFT JOIN k ON tt >= t0 AND tt < t1 AND tt > a AND tt < z""")
def nearest_bracket_interp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means at noon, interpolated at each event."""
    events = table(spark, sf_dir, "events")
    days = events.groupBy(F.to_date("ts").alias("day")).agg(F.avg("value").alias("v"))
    days = days.select((F.datediff("day", F.lit("1970-01-01").cast("date")) * 86400.0 + 43200.0).alias("t"), "v")
    points = events.select("event_id", (b.epoch_micros("ts") / 1e6).alias("at"))
    return joins.interpolate(points, "at", days, "t", "v", 86400.0).select("event_id", r6(F.col("v")).alias("v"))


@query("""WITH u AS (SELECT doc_id % 300 AS name, lang, doc_id AS pos, 0 AS file FROM documents UNION ALL SELECT page_id % 200, split_part(url, '/', 4), page_id, 1 FROM pages),
 n AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY file, pos) AS i FROM u) SELECT name, lang, pos, file FROM n WHERE i = 1""")
def catalog_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select((F.col("doc_id") % 300).alias("name"), "lang", F.col("doc_id").alias("pos"), F.lit(0).alias("file"))
    pages = table(spark, sf_dir, "pages").select((F.col("page_id") % 200).alias("name"), F.split_part("url", F.lit("/"), F.lit(4)).alias("lang"), F.col("page_id").alias("pos"), F.lit(1).alias("file"))
    return catalog.dedup(docs.unionByName(pages), F.col("name"), ["file", "pos"])


@query("""SELECT source AS path, string_agg(DISTINCT lang, ',' ORDER BY lang) AS frames, count(*) AS n_scenes, min_by(lang, doc_id) AS direction FROM documents GROUP BY source""")
def path_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    scenes = table(spark, sf_dir, "documents").select(F.col("source").alias("path"), F.col("lang").alias("frame"), F.col("lang").alias("direction"), "doc_id")
    return catalog.path_summary(scenes, "path", "frame", "direction", "doc_id")


@query("""SELECT event_id, coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k'))::INTEGER AS k FROM events""")
def json_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", catalog.json_field(F.col("props"), "$.missing", "$.k").cast("int").alias("k"))


@query("SELECT page_id, regexp_extract(html, '<title(?:\\s[^>]*)?>([^<]*)', 1) AS title, md5(coalesce(html, '')) AS digest FROM pages")
def tag_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", names.tag_text(F.col("html"), "title").alias("title"), F.md5(F.coalesce("html", F.lit(""))).alias("digest"))


NAME_SQL = "format('S1A_IW_SLC__1SDV_{}T010203_{}T010230_{:06d}_{:06X}_AB12.zip', strftime(o_orderdate, '%Y%m%d'), strftime(o_orderdate, '%Y%m%d'), o_orderkey % 1000000, o_custkey)"


@query(f"""WITH n AS (SELECT o_orderkey AS k, regexp_split_to_array(regexp_replace({NAME_SQL}, '\\.[A-Za-z]+$', ''), '[_.]+') AS p FROM orders)
SELECT k, p[1] AS mission, p[2] AS mode, p[3] AS product, substr(p[4], 1, 1) AS level, substr(p[4], 3, 2) AS polarisation, substr(p[5], 1, 8) AS date, p[7] AS orbit, p[8] AS mission_id, p[9] AS unique_id FROM n""")
def name_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd")
    name = F.format_string("S1A_IW_SLC__1SDV_%sT010203_%sT010230_%06d_%06X_AB12.zip", day, day, F.col("o_orderkey") % 1000000, F.col("o_custkey"))
    parts = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), names.product_parts(name).alias("p"))
    return parts.select("k", *[F.col(f"p.{n}").alias(n) for n in ("mission", "mode", "product", "level", "polarisation", "date", "orbit", "mission_id", "unique_id")])


@query("""SELECT event_id, ts + INTERVAL 10 SECOND AS later, hour(ts)::INTEGER AS hour, round((epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1e6, 6) AS seconds,
 make_timestamp(((epoch_us(ts) + epoch_us(ts + INTERVAL 27 SECOND)) // 2)::BIGINT) AS middle FROM events""")
def time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", (ts + F.expr("interval 10 seconds")).alias("later"), F.hour(ts).alias("hour"), F.round(names.seconds_of_day(ts), 6).alias("seconds"),
        names.middle(ts, ts + F.expr("interval 27 seconds")).alias("middle"),
    )


@query("""WITH y AS (SELECT o_orderkey AS k, o_orderdate::DATE AS a, o_orderdate::DATE + 500 AS z FROM orders), s AS (SELECT k, a, z, unnest(range(year(a), year(z) + 1)) AS y FROM y)
SELECT k, greatest(a, make_date(y, 1, 1)) AS start, least(z, make_date(y, 12, 31)) AS stop FROM s""")
def year_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.to_date("o_orderdate")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.explode(names.year_ranges(a, F.date_add(a, 500))).alias("y"))
    return rows.select("k", F.col("y.from").alias("start"), F.col("y.to").alias("stop"))


@query("""WITH p AS (SELECT c_custkey AS k, c_acctbal AS s, -c_acctbal / 7 AS w FROM customer)
SELECT k, concat(CASE WHEN s < 0 THEN 'S' ELSE 'N' END, abs(trunc(s)::INTEGER), '_', CASE WHEN s + 3 < 0 THEN 'S' ELSE 'N' END, abs(trunc(s + 3)::INTEGER), '_',
 CASE WHEN w < 0 THEN 'W' ELSE 'E' END, abs(trunc(w)::INTEGER), '_', CASE WHEN w + 4 < 0 THEN 'W' ELSE 'E' END, abs(trunc(w + 4)::INTEGER)) AS tag FROM p""")
def area_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, w = F.col("c_acctbal"), -F.col("c_acctbal") / 7
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), names.area_tag(s, s + 3, w, w + 4).alias("tag"))


@query("""WITH p AS (SELECT n_nationkey AS n, c_custkey % 360 - 180.0::DOUBLE AS lon, c_custkey % 170 - 85.0::DOUBLE AS lat FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT n, min(lon) AS west, min(lat) AS south, max(lon + 1) AS east, max(lat + 1) AS north FROM p GROUP BY n""")
def footprint_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One square polygon per customer."""
    lon, lat = F.col("c_custkey") % 360 - F.lit(180.0), F.col("c_custkey") % 170 - F.lit(85.0)
    point = lambda dx, dy: F.array(lon + dx, lat + dy)
    ring = F.array(point(0, 0), point(1, 0), point(1, 1), point(0, 1), point(0, 0))
    return catalog.footprint(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n"), F.array(ring).alias("rings")), ["n"], "rings")


@query("SELECT p_partkey AS k, p_size AS size, p_retailprice AS price, NULL::INTEGER AS brand FROM part")
def param_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").cast("string").alias("size"), F.col("p_retailprice").cast("string").alias("price"), F.col("p_brand").alias("brand"))
    params = part.unpivot("k", ["size", "price", "brand"], "name", "value")
    return catalog.wide(params, ["k"], {"size": "int", "price": "double", "brand": "int"})


@query("""SELECT user_id, event_type, max_by(value, event_id) AS value, max_by(props, event_id) AS props FROM events GROUP BY ALL""")
def param_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "value", "props", "event_id")
    return catalog.upsert(rows, ["user_id", "event_type"], "event_id").drop("event_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def incremental_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return catalog.todo(table(spark, sf_dir, "orders").select("o_orderkey"), done, ["o_orderkey"])


@query("SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src3') AND lang IN ('en', 'de') AND doc_id IN (SELECT doc_id FROM labels)")
def scene_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters by path, frame and a list of names."""
    docs = table(spark, sf_dir, "documents").where(F.col("source").isin("src1", "src3") & F.col("lang").isin("en", "de")).select("doc_id", "source")
    return docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")


# ---- similarity and unwrapping ------------------------------------------------------------------

#: The octant cells of the rings 1 to 5, worked out by hand.
OCTANT = ((1, 0), (1, 1), (2, 0), (2, 1), (3, 0), (3, 1), (2, 2), (4, 0), (4, 1), (3, 2), (4, 2), (3, 3), (5, 0), (5, 1), (5, 2), (4, 3))


def spiral_sql(first: int, last: int) -> str:
    """o(ord, dr, dc) from the octant cells first .. last − 1: the axis points, or the mirror images."""
    cells = ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(OCTANT[first:last]))
    return f"""oct(i, x, y) AS (VALUES {cells}), img(j, swap, sx, sy) AS (VALUES (0, 0, 1, 1), (1, 0, -1, -1), (2, 0, 1, -1), (3, 0, -1, 1), (4, 1, 1, 1), (5, 1, -1, -1), (6, 1, 1, -1), (7, 1, -1, 1)),
 every AS (SELECT i, j, CASE WHEN y = 0 THEN CASE j WHEN 0 THEN x WHEN 1 THEN -x ELSE 0 END WHEN swap = 1 THEN sx * y ELSE sx * x END AS dr,
   CASE WHEN y = 0 THEN CASE j WHEN 2 THEN x WHEN 3 THEN -x ELSE 0 END WHEN swap = 1 THEN sy * x ELSE sy * y END AS dc FROM oct, img WHERE j < 4 OR (y > 0 AND x <> y)),
 o AS (SELECT (row_number() OVER (ORDER BY i, j) - 1)::INTEGER AS ord, dr, dc FROM every)"""


SIM_SQL = f"""WITH {b.Z}, u AS (SELECT r AS ifg, (c // 4)::INTEGER AS r, (c % 4)::INTEGER AS c, CASE WHEN sqrt(re * re + im * im) > 1e-8 THEN re / sqrt(re * re + im * im) ELSE 0 END AS re,
  CASE WHEN sqrt(re * re + im * im) > 1e-8 THEN im / sqrt(re * re + im * im) ELSE 0 END AS im FROM z), g AS (SELECT DISTINCT r, c, CASE WHEN (r + c) % 2 = 0 THEN 1 ELSE 0 END AS ps FROM u),
 {spiral_sql(0, 4)},
 n AS (SELECT g.r, g.c, ord, h.r AS nr, h.c AS nc, row_number() OVER (PARTITION BY g.r, g.c ORDER BY ord) AS k FROM g, o JOIN g h ON h.ps = 1 AND h.r = g.r + dr AND h.c = g.c + dc),
 s AS (SELECT n.r, n.c, n.ord, sum(x.re * y.re + x.im * y.im) / count(*) AS sim FROM n JOIN u x ON x.r = n.r AND x.c = n.c JOIN u y ON y.r = n.nr AND y.c = n.nc AND y.ifg = x.ifg WHERE k <= 10 GROUP BY ALL)"""


def _cube(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(ifg, r, c, re, im) on a grid of 8 × 4 and its (r, c, ps)."""
    z = b.embedding_complex(spark, sf_dir)
    cube = z.select(F.col("r").alias("ifg"), F.expr("cast(c div 4 as int)").alias("r"), (F.col("c") % 4).alias("c"), "re", "im")
    grid = geo.Grid(8, 4, 0, 0, 1, -1).cells(spark).select(F.col("row").alias("r"), F.col("col").alias("c"))
    return cube, grid.withColumn("ps", F.when((F.col("r") + F.col("c")) % 2 == 0, 1).otherwise(0))


def _pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    cube, grid = _cube(spark, sf_dir)
    return similarity.pair_similarity(cube, grid.where("ps = 1"), similarity.offsets(spark, 0, 3), 8, 4, 10), grid


@query(f"{SIM_SQL} SELECT g.r, g.c, round(coalesce(list_sort(list(sim))[len(list(sim)) // 2 + 1], 0), 6) + 0e0 AS sim FROM g LEFT JOIN s ON s.r = g.r AND s.c = g.c GROUP BY ALL")
def phase_similarity_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, grid = _pairs(spark, sf_dir)
    return similarity.median_similarity(pairs, grid).withColumn("sim", r6(F.col("sim")))


@query(f"{SIM_SQL} SELECT g.r, g.c, CASE WHEN ps = 1 THEN 1e0 ELSE round(coalesce(max(sim), 0), 6) + 0e0 END AS sim FROM g LEFT JOIN s ON s.r = g.r AND s.c = g.c GROUP BY g.r, g.c, ps")
def phase_similarity_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, grid = _pairs(spark, sf_dir)
    return similarity.max_similarity(pairs, grid).withColumn("sim", r6(F.col("sim")))


@query(f"""{SIM_SQL}, m AS (SELECT g.r, g.c, ps, round(coalesce(list_sort(list(sim))[len(list(sim)) // 2 + 1], 0), 6) AS sim FROM g LEFT JOIN s ON s.r = g.r AND s.c = g.c GROUP BY ALL)
SELECT r, c, CASE WHEN sim >= 0.02 THEN 1 ELSE 0 END AS replaced, CASE WHEN sim >= 0.02 THEN 1 ELSE ps END AS raised FROM m""")
def ps_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, grid = _pairs(spark, sf_dir)
    both = similarity.median_similarity(pairs, grid).join(grid, ["r", "c"]).withColumn("sim", F.round("sim", 6))
    change = lambda overwrite: similarity.updated(F.col("ps"), F.col("sim"), 0.02, overwrite)
    return both.select("r", "c", change(True).alias("replaced"), change(False).alias("raised"))


#: The pixels that pass the first threshold, and their similarity with one another.
CHAIN_SQL = f"""{SIM_SQL}, m AS (SELECT g.r, g.c, coalesce(list_sort(list(sim))[len(list(sim)) // 2 + 1], 0) AS median FROM g LEFT JOIN s ON s.r = g.r AND s.c = g.c GROUP BY ALL),
 w AS (SELECT r, c, median, CASE WHEN round(median, 6) >= 0.02 THEN 1 ELSE 0 END AS ps FROM m),
 n2 AS (SELECT g.r, g.c, ord, h.r AS nr, h.c AS nc, row_number() OVER (PARTITION BY g.r, g.c ORDER BY ord) AS k FROM w g, o JOIN w h ON h.ps = 1 AND h.r = g.r + dr AND h.c = g.c + dc),
 s2 AS (SELECT n.r, n.c, n.ord, sum(x.re * y.re + x.im * y.im) / count(*) AS sim FROM n2 n JOIN u x ON x.r = n.r AND x.c = n.c JOIN u y ON y.r = n.nr AND y.c = n.nc AND y.ifg = x.ifg WHERE k <= 10 GROUP BY ALL),
 t AS (SELECT w.r, w.c, median, ps, CASE WHEN ps = 1 THEN 1.0::DOUBLE ELSE coalesce(max(sim), 0) END AS best FROM w LEFT JOIN s2 ON s2.r = w.r AND s2.c = w.c GROUP BY w.r, w.c, median, ps)"""


@query(f"{CHAIN_SQL} SELECT r, c, round(median, 6) + 0e0 AS median, ps, round(best, 6) + 0e0 AS max, CASE WHEN round(best, 6) >= 0.04 THEN 1 ELSE ps END AS selected FROM t")
def scatterer_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median similarity, threshold, largest similarity with what is left."""
    cube, grid = _cube(spark, sf_dir)
    out = drivers.scatterers(cube, grid, 8, 4, 10, (0, 3), 0.02, 0.04)
    return out.withColumns({"median": r6(F.col("median")), "max": r6(F.col("max"))})


PHASE_SQL = b.PX + ", ph AS (SELECT r // 50 AS img, r, c, 6 * pi() * v - 2 * pi() * ceil((6 * pi() * v - pi()) / (2 * pi())) AS phase FROM px)"
GRAD_SQL = PHASE_SQL + """, g0 AS (SELECT img, r, c, phase, (lead(phase) OVER (PARTITION BY img, r ORDER BY c) - phase) / (2 * pi()) AS x, (lead(phase) OVER (PARTITION BY img, c ORDER BY r) - phase) / (2 * pi()) AS y FROM ph),
 g AS (SELECT img, r, c, phase, x - floor(x + 0.5::DOUBLE) AS dc, y - floor(y + 0.5::DOUBLE) AS dr FROM g0)"""


def _phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of 50 rows; values times 6π, wrapped."""
    px = b.embedding_pixels(spark, sf_dir)
    return px.select(F.expr("r div 50").alias("img"), "r", "c", cplx.wrap(F.col("v") * (6 * math.pi)).alias("phase"))


@query(f"WITH {GRAD_SQL} SELECT img, r, c, round(dc, 6) + 0e0 AS dc, round(dr, 6) + 0e0 AS dr FROM g")
def wrapped_gradients(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = unwrapping.gradients(_phases(spark, sf_dir), ["img"])
    return out.select("img", "r", "c", r6(F.col("dc")).alias("dc"), r6(F.col("dr")).alias("dr"))


@query(f"""WITH {GRAD_SQL}, l AS (SELECT img, r, c, dc + lead(dr) OVER (PARTITION BY img, r ORDER BY c) - lead(dc) OVER (PARTITION BY img, c ORDER BY r) - dr AS x FROM g)
SELECT img, r, c, round(x)::INTEGER AS residue FROM l WHERE x IS NOT NULL""")
def residues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unwrapping.residues(_phases(spark, sf_dir), ["img"])


@query(f"""WITH {GRAD_SQL}, s AS (SELECT img, r, c, phase, coalesce(sum(dc) OVER (PARTITION BY img, r ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rs,
  coalesce(sum(dr) OVER (PARTITION BY img, c ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cs FROM g)
SELECT img, r, c, round(first(phase) OVER (PARTITION BY img ORDER BY r, c) + 2 * pi() * (cs + first(rs) OVER (PARTITION BY img, c ORDER BY r)), 6) + 0e0 AS unwrapped FROM s""")
def integrate_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = unwrapping.integrate(_phases(spark, sf_dir), ["img"])
    return out.select("img", "r", "c", r6(F.col("unwrapped")).alias("unwrapped"))


@query(f"""WITH {GRAD_SQL}, q AS (SELECT img, r, c, round(dc, 6) AS d, round(avg(dc) OVER (PARTITION BY img, r ORDER BY c ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 6) AS m, (c % 5) / 5.0::DOUBLE AS rho FROM g WHERE dc IS NOT NULL)
SELECT img, r, c, round_even(200.0::DOUBLE * (d - CASE WHEN rho > 0 THEN m ELSE 0.5::DOUBLE * m END), 0)::INTEGER AS offset_, ceil(round((pow(1 - rho, 0.5::DOUBLE) / 6.0::DOUBLE + 0.05::DOUBLE) * 40000.0::DOUBLE, 6))::INTEGER AS variance FROM q""")
def smooth_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    grads = unwrapping.gradients(_phases(spark, sf_dir), ["img"]).where("dc is not null")
    near = Window.partitionBy("img", "r").orderBy("c").rowsBetween(-3, 3)
    made = grads.select("img", "r", "c", F.round("dc", 6).alias("d"), F.round(F.avg("dc").over(near), 6).alias("m"), ((F.col("c") % 5) / F.lit(5.0)).alias("rho"))
    out = unwrapping.smooth_costs(made, "m", "d", "rho")
    return out.select("img", "r", "c", F.col("offset").alias("offset_"), "variance")


@query(f"""WITH {b.Z}, l AS (SELECT (r % 10)::INTEGER AS label, re, im FROM z), m AS (SELECT label, atan2(avg(im), avg(re)) AS mean FROM l GROUP BY label),
 x AS (SELECT label, mean, atan2(re * sin(-mean) + im * cos(-mean), re * cos(-mean) - im * sin(-mean)) AS rest FROM l JOIN m USING (label))
SELECT label, round(any_value(mean) + median(rest), 6) + 0e0 AS off FROM x GROUP BY label""")
def phasor_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = b.embedding_complex(spark, sf_dir).withColumn("label", (F.col("r") % 10).cast("int"))
    return interferograms.phase_offset(z, ["label"]).select("label", r6(F.col("offset")).alias("off"))


@query("""WITH n AS (SELECT s_nationkey AS nation, s_suppkey AS k, s_acctbal AS b, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS i, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier)
SELECT nation, k, b FROM n WHERE i = n // 2 + 1""")
def middle_orbit(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("b"))
    return catalog.middle(s, ["nation"], "b", "k")


@query("""WITH c AS (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS p, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events)
SELECT user_id, event_id, i > 1 AND event_type IS DISTINCT FROM p AS changed FROM c""")
def acquisition_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return catalog.changes(rows, ["user_id"], "event_id", ["event_type"]).drop("event_type")


@query(f"WITH {b.PX} SELECT r // 50 AS img, round(min(v) * 1000 - 100, 6) + 0e0 AS low, round(max(v) * 1000 + 100, 6) + 0e0 AS high FROM px GROUP BY ALL")
def dem_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = b.embedding_pixels(spark, sf_dir).groupBy(F.expr("r div 50").alias("img"))
    return px.agg(r6(F.min("v") * 1000 - 100).alias("low"), r6(F.max("v") * 1000 + 100).alias("high"))


@query("""SELECT p_partkey AS k, (ceil((p_partkey % 500) / 10.0::DOUBLE) * 10)::BIGINT AS top, (floor((p_partkey % 500 + p_size) / 10.0::DOUBLE) * 10)::BIGINT AS bottom,
 (ceil((p_partkey % 90) / 20.0::DOUBLE) * 20)::BIGINT AS left_, (floor((p_partkey % 90 + 3 * p_size) / 20.0::DOUBLE) * 20)::BIGINT AS right_ FROM part""")
def snapped_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    box = interferograms.snapped_box(k % 500, k % 500 + size, k % 90, k % 90 + 3 * size, (10, 20))
    boxes = table(spark, sf_dir, "part").select(k.alias("k"), box.alias("b"))
    return boxes.select("k", "b.top", "b.bottom", F.col("b.left").alias("left_"), F.col("b.right").alias("right_"))


@query(f"""WITH {XYZ_SQL}, v AS (SELECT k, x, y, z, -y / 1e3 AS vx, x / 1e3 AS vy, 5e3 + lat AS vz, sqrt(x * x + y * y + z * z) AS n FROM x),
 d AS (SELECT *, -x / n AS dx, -y / n AS dy, -z / n AS dz FROM v), s0 AS (SELECT *, dy * vz - dz * vy AS sx0, dz * vx - dx * vz AS sy0, dx * vy - dy * vx AS sz0 FROM d),
 s AS (SELECT *, sx0 / sqrt(sx0 * sx0 + sy0 * sy0 + sz0 * sz0) AS sx, sy0 / sqrt(sx0 * sx0 + sy0 * sy0 + sz0 * sz0) AS sy, sz0 / sqrt(sx0 * sx0 + sy0 * sy0 + sz0 * sz0) AS sz FROM s0)
SELECT k, round(dx, 6) + 0e0 AS nadir_x, round(sy, 6) + 0e0 AS side_y, round(sy * dz - sz * dy, 6) + 0e0 AS along_x, round(sx * dy - sy * dx, 6) + 0e0 AS along_z FROM s""")
def tcn_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    xyz = geo.llh_to_xyz(F.col("lat"), F.col("lon"), F.col("h"))
    p = _places(spark, sf_dir).select("k", "lat", *[v.alias(n) for v, n in zip(xyz, "xyz", strict=True)])
    along, side, down = geo.tcn((F.col("x"), F.col("y"), F.col("z")), (-F.col("y") / 1e3, F.col("x") / 1e3, F.lit(5e3) + F.col("lat")))
    return p.select("k", r6(down[0]).alias("nadir_x"), r6(side[1]).alias("side_y"), r6(along[0]).alias("along_x"), r6(along[2]).alias("along_z"))


@query(f"""WITH {LLH_SQL}, r AS (SELECT k, radians(lat) AS a, radians(lon) AS o, h FROM p)
SELECT k, round(-sin(o) * 1 - sin(a) * cos(o) * 2 + cos(a) * cos(o) * h, 4) + 0e0 AS x, round(cos(o) * 1 - sin(a) * sin(o) * 2 + cos(a) * sin(o) * h, 4) + 0e0 AS y, round(cos(a) * 2 + sin(a) * h, 4) + 0e0 AS z FROM r""")
def enu_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    xyz = geo.enu_to_xyz(F.col("lat"), F.col("lon"), (F.lit(1.0), F.lit(2.0), F.col("h")))
    return _places(spark, sf_dir).select("k", *[(F.round(v, 4) + 0.0).alias(n) for v, n in zip(xyz, "xyz", strict=True)])


@query("""WITH q AS (SELECT p_partkey AS k, -2300 - p_size * 0.5::DOUBLE + 3 * (p_partkey % 7) + 0.1::DOUBLE * (p_partkey % 7) * (p_partkey % 7) AS ka, 2 * 7600.0::DOUBLE * 5.405e9 / 299792458.0::DOUBLE * 1.6::DOUBLE * (pi() / 180) AS ks, p_size * 0.01::DOUBLE AS eta FROM part)
SELECT k, round(ka * ks / (ka - ks), 6) + 0e0 AS kt, round(-pi() * (ka * ks / (ka - ks)) * (eta - 0.25::DOUBLE) * (eta - 0.25::DOUBLE), 6) + 0e0 AS phase FROM q""")
def deramp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FM rate polynomial, total Doppler rate and the ramp's phase."""
    k, size = F.col("p_partkey"), F.col("p_size")
    ka = cplx.quadratic(F.lit(-2300.0) - size * 0.5, F.lit(3.0), F.lit(0.1), (k % 7).cast("double"))
    kt = cplx.doppler_rate(ka, F.lit(1.6), F.lit(7600.0), 5.405e9)
    return table(spark, sf_dir, "part").select(k.alias("k"), r6(kt).alias("kt"), r6(cplx.deramp_phase(kt, size * 0.01, F.lit(0.25))).alias("phase"))


@query(r"""WITH v AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN value::VARCHAR || 'e0' WHEN 2 THEN event_type ELSE '-' || (user_id::VARCHAR) END AS v FROM events)
SELECT event_id, CASE WHEN regexp_matches(v, '^\s*[+-]?\d+\s*$') THEN 'int' WHEN try_cast(v AS DOUBLE) IS NOT NULL THEN 'float' ELSE 'string' END AS kind FROM v""")
def number_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    v = F.when(i % 4 == 0, i.cast("string")).when(i % 4 == 1, F.concat(F.col("value").cast("string"), F.lit("e0"))).when(i % 4 == 2, F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", names.number_kind(v.otherwise(F.concat(F.lit("-"), F.col("user_id").cast("string")))).alias("kind"))


@query("""SELECT n_nationkey AS k, 'http://catalog/q?name=' || replace(n_name, ' ', '+') || '&region=' || n_regionkey AS url FROM nation""")
def query_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    url = names.query_url("http://catalog/q", {"name": F.col("n_name"), "none": F.lit(None).cast("string"), "region": F.col("n_regionkey")})
    return nation.select(F.col("n_nationkey").alias("k"), url.alias("url"))


@query(f"""WITH {b.Z}, s AS (SELECT (r % 3)::INTEGER + 1 AS iw, r // 5 AS r, c, re, im FROM z WHERE re > -0.05), m AS (SELECT r, c, max(iw) AS iw FROM s GROUP BY ALL)
SELECT m.r, m.c, m.iw AS source, n.n FROM m JOIN (SELECT r, c, count(DISTINCT iw) AS n FROM s GROUP BY ALL) n ON n.r = m.r AND n.c = m.c""")
def stitch_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The highest subswath with data wins; the frame tells which one it was."""
    z = b.embedding_complex(spark, sf_dir).where("re > -0.05").withColumn("iw", (F.col("r") % 3).cast("int") + 1).withColumn("r", F.expr("r div 5"))
    frame = interferograms.stitch_frame(z.select("iw", "r", "c", F.col("iw").cast("double").alias("re"), F.lit(0.0).alias("im")))
    counts = z.groupBy("r", "c").agg(F.count_distinct("iw").alias("n"))
    return frame.join(counts, ["r", "c"]).select("r", "c", F.col("re").cast("int").alias("source"), "n")


@query("""WITH q AS (SELECT p_partkey AS k, (p_partkey * 7919 % 10000) / 10000.0::DOUBLE * 480 AS y, (p_partkey * 104729 % 10000) / 10000.0::DOUBLE * 62 AS x FROM part),
 f AS (SELECT k, floor(y)::BIGINT AS r, floor(x)::INTEGER AS c, y - floor(y) AS a, x - floor(x) AS b FROM q), e AS (SELECT vec_id::BIGINT AS r, embedding AS v FROM embeddings)
SELECT k, round(p.v[c + 1]::DOUBLE * (1 - a) * (1 - b) + p.v[c + 2]::DOUBLE * (1 - a) * b + t.v[c + 1]::DOUBLE * a * (1 - b) + t.v[c + 2]::DOUBLE * a * b, 6) + 0e0 AS v
FROM f JOIN e p ON p.r = f.r JOIN e t ON t.r = f.r + 1""")
def bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    points = table(spark, sf_dir, "part").select(k.alias("k"), ((k * 7919 % 10000) / 10000.0 * 480).alias("y"), ((k * 104729 % 10000) / 10000.0 * 62).alias("x"))
    return raster.bilinear(points, b.embedding_pixels(spark, sf_dir), "k", "y", "x", ["v"]).withColumn("v", r6(F.col("v")))


@query("""WITH n AS (SELECT max(vec_id) AS n FROM embeddings), q AS (SELECT p_partkey AS k, n, least(greatest((p_partkey * 7919 % 10000) / 10000.0::DOUBLE * (n + 20) - 10, 0), n) AS y,
  least(greatest((p_partkey * 104729 % 10000) / 10000.0::DOUBLE * 80 - 8, 0), 63) AS x FROM part, n), f AS (SELECT k, n, floor(y)::BIGINT AS r, floor(x)::INTEGER AS c, y - floor(y) AS a, x - floor(x) AS b FROM q),
 e AS (SELECT vec_id::BIGINT AS r, embedding AS v FROM embeddings)
SELECT k, round((p.v[c + 1]::DOUBLE * (1 - b) + p.v[least(c + 2, 64)]::DOUBLE * b) * (1 - a) + (t.v[c + 1]::DOUBLE * (1 - b) + t.v[least(c + 2, 64)]::DOUBLE * b) * a, 6) + 0e0 AS v
FROM f JOIN e p ON p.r = f.r JOIN e t ON t.r = least(f.r + 1, n)""")
def bilinear_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places around the raster as well, which take its edge."""
    k, n = F.col("p_partkey"), b.rows_of(spark, sf_dir)
    points = table(spark, sf_dir, "part").select(k.alias("k"), ((k * 7919 % 10000) / 10000.0 * (n + 19) - 10).alias("y"), ((k * 104729 % 10000) / 10000.0 * 80 - 8).alias("x"))
    return raster.bilinear(points, b.embedding_pixels(spark, sf_dir), "k", "y", "x", ["v"], (n, 64)).withColumn("v", r6(F.col("v")))


# ---- operators without SQL ----------------------------------------------------------------------


def _tubes(spark: SparkSession, sf_dir: str):
    """Tubes of all pixels, and the graph on the driver (some hundred rows)."""
    graph = b.month_pairs(spark, sf_dir)
    pairs = [tuple(r) for r in graph.select("i1", "i2").orderBy("i1", "i2").collect()]
    days = [r["days"] for r in b.months(spark, sf_dir).orderBy("idx").collect()]
    return timeseries.pair_tubes(b.monthly_phases(spark, sf_dir), graph, PX), pairs, days


@query()
def sbas_ls(spark: SparkSession, sf_dir: str) -> DataFrame:
    tubes, pairs, days = _tubes(spark, sf_dir)
    _, design = network.matrices(pairs, days)
    solved = timeseries.sbas_ls(tubes, PX, design, 1e-6 * float((design**2).sum()))
    return timeseries.interval_series(solved, PX, [y - x for x, y in zip(days, days[1:], strict=False)])


@query()
def sbas_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    tubes, pairs, days = _tubes(spark, sf_dir)
    _, design = network.matrices(pairs, days)
    solved = timeseries.sbas_l1(tubes, PX, design, 1e-6 * float((design**2).sum()))
    return timeseries.interval_series(solved, PX, [y - x for x, y in zip(days, days[1:], strict=False)])


@query()
def sbas_seasonal_k2(spark: SparkSession, sf_dir: str) -> DataFrame:
    tubes, pairs, days = _tubes(spark, sf_dir)
    return timeseries.sbas_model(tubes, PX, network.seasonal_design(pairs, days, 2), 1e-3)


@query()
def goldstein_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interferograms.goldstein(b.embedding_complex(spark, sf_dir), b.rows_of(spark, sf_dir), 32, 16, 0.5)


def circular_orbit(radius: float = 7_071_000.0, inclination: float = 98.2, step: float = 10.0, count: int = 17) -> orbit.Orbit:
    """State vectors of a circular orbit, for the queries and tests."""
    import numpy as np

    rate, tilt, t = math.sqrt(3.986004418e14 / radius**3), math.radians(inclination), np.arange(count) * step
    u = rate * t
    x = radius * np.stack([np.cos(u), np.sin(u) * math.cos(tilt), np.sin(u) * math.sin(tilt)], axis=1)
    v = radius * rate * np.stack([-np.sin(u), np.cos(u) * math.cos(tilt), np.cos(u) * math.sin(tilt)], axis=1)
    return orbit.Orbit(t, x, v)


def _ground(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("k"), (3.0 + (k % 40) / 10.0).alias("lat"), (2.0 + (k % 30) / 10.0).alias("lon"), (k % 900).cast("double").alias("height"))


@query()
def zero_doppler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orbit.zero_doppler(_ground(spark, sf_dir), circular_orbit())


@query()
def line_of_sight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orbit.line_of_sight(_ground(spark, sf_dir), circular_orbit())


@query()
def geocoded_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 120 rows are a date of two bursts over the same ground, geocoded on a grid and mosaicked."""
    vectors = [[float(t), *map(float, x), *map(float, v)] for t, x, v in zip(*(getattr(circular_orbit(), n) for n in "txv"), strict=True)]
    z = b.embedding_complex(spark, sf_dir).select(F.expr("r div 120").alias("date"), F.expr("cast(r % 120 div 60 as int)").alias("burst"), "r", "c", "re", "im")
    rows = z.groupBy("date", "burst").agg(F.array_sort(F.collect_list(F.struct("r", "c", "re", "im"))).alias("z"))
    rows = rows.withColumn("start", 80.0 + F.col("burst") * 0.1)
    fixed = {"iw": 1, "samples": 32, "line_time": 0.002, "near": 850_000.0, "range_step": 10.0, "wavelength": 0.0555, "steering": 1.6}
    rows = rows.withColumns({n: F.lit(v) for n, v in fixed.items()})
    rows = rows.withColumns({
        "ka": F.array(*map(F.lit, (0.0, -2300.0, 0.0, 0.0))), "dc": F.array(*map(F.lit, (0.0, 0.0, 0.0, 0.0))),
        "valid": F.array(F.lit(0), F.expr("size(z) div 32 - 1").cast("int"), F.lit(0), F.lit(31)),
        "vectors": F.lit(vectors), "re": F.col("z.re"), "im": F.col("z.im"),
    })
    corner = orbit.range_to_llh(circular_orbit(), 80.1, 850_160.0, 0.0)
    grid = geo.Grid(120, 60, float(corner[1]) - 0.003, float(corner[0]) + 0.006, 0.0001, -0.0001)
    terrain = grid.cells(spark).select(F.col("row").alias("r"), F.col("col").alias("c"), F.lit(0.0).alias("height"))
    return drivers.frames(drivers.geocode_scenes(terrain, rows.drop("z"), grid, heights=(-100.0, 100.0)))


@query()
def unwrap_mst(spark: SparkSession, sf_dir: str) -> DataFrame:
    phases = b.embedding_pixels(spark, sf_dir).select(F.expr("r div 50").alias("img"), "r", "c", cplx.wrap(F.col("v") * (2 * math.pi)).alias("phase"))
    return unwrapping.unwrap(phases, ["img"])


@query(f"WITH {b.PX} SELECT r // 50 AS img, r, c, round(0.7::DOUBLE * (r % 50) - 0.9::DOUBLE * c + 0.004::DOUBLE * (r % 50) * c, 6) + 0e0 AS unwrapped FROM px")
def unwrap_tiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A smooth field, wrapped: overlapping tiles give it back, each image on its own level."""
    px = b.embedding_pixels(spark, sf_dir)
    row = F.col("r") % 50
    field = 0.7 * row - 0.9 * F.col("c") + 0.004 * row * F.col("c")
    phases = px.select(F.expr("r div 50").alias("img"), "r", "c", cplx.wrap(field).alias("phase"), (0.5 + 0.5 * F.abs("v") / (1 + F.abs("v"))).alias("coh"))
    local = phases.withColumn("r", (F.col("r") % 50).cast("int"))
    out = unwrapping.tiled_unwrap(local, ["img"], (50, 64), (2, 3), (10, 8), coherence="coh")
    return out.select("img", (F.col("img") * 50 + F.col("r")).alias("r"), "c", r6(F.col("unwrapped")).alias("unwrapped"))


@query(f"WITH {spiral_sql(2, 16)} SELECT ord, dr, dc FROM o")
def spiral_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.offsets(spark, 1, 6)


@query()
def stitch_subswath(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bursts of 40 embedding rows every 30 rows, one acquisition each."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("r"), "embedding")
    hits = F.filter(F.array(F.expr("cast(r div 30 as int)"), F.expr("cast(r div 30 - 1 as int)")), lambda i: (i >= 0) & (i * 30 + 40 > F.col("r")))
    rows = rows.select((F.col("r") % 5).cast("int").alias("iw"), F.explode(hits).alias("ord"), "r", "embedding")
    pixel = F.struct("r", F.col("embedding").alias("e"))
    tiles = rows.groupBy("iw", "ord").agg(F.array_sort(F.collect_list(pixel)).alias("p"))
    part = lambda odd: F.flatten(F.transform("p", lambda x: F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.get(x["e"], 2 * i + odd).cast("double"))))
    tiles = tiles.select(
        "iw", "ord", F.col("ord").cast("string").alias("acquisition"), F.expr("cast(p[0].r div 5 as int)").alias("top"), F.lit(0).alias("left"),
        F.size("p").alias("height"), F.lit(32).alias("width"), part(0).alias("re"), part(1).alias("im"),
    )
    return interferograms.stitch_subswath(tiles, ["iw"])


#: The phase between two dates, twelve days apart or more, on a grid of 32 columns.
FIELD = "0.002 * d * (r % 300) + 0.003 * d * c"


@query(f"""WITH p AS (SELECT vec_id::BIGINT AS r, unnest(range(32))::INTEGER AS c, 1 + (vec_id % 7) / 10.0::DOUBLE AS amp FROM embeddings),
 q AS (SELECT d1, d2, r // 300 AS frame, (r % 300) // 10 AS r, c // 4 AS c, amp * amp * cos({FIELD}) AS re, amp * amp * sin({FIELD}) AS im
  FROM p, (SELECT i AS d1, j AS d2, (j - i)::DOUBLE AS d FROM range(3) a(i), range(3) b(j) WHERE i < j))
SELECT d1::INTEGER AS date1, d2::INTEGER AS date2, frame, r, c::INTEGER AS c, round(sum(re) / 40, 6) + 0e0 AS re, round(sum(im) / 40, 6) + 0e0 AS im FROM q GROUP BY ALL""")
def interfere_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of 300 rows in bursts of 40 rows every 30 and two subswaths that overlap by 4 columns. The
    phase jumps with each acquisition of three bursts; the stitched frame has no jumps."""
    ids = F.col("vec_id")
    rows = table(spark, sf_dir, "embeddings").select(F.expr("vec_id div 300").alias("frame"), (ids % 300).cast("int").alias("r"), (1 + (ids % 7) / 10.0).alias("amp"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("c"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("date"))
    hits = F.filter(F.array(F.expr("r div 30"), F.expr("r div 30 - 1")), lambda i: (i >= 0) & (i * 30 + 40 > F.col("r")))
    swaths = F.filter(F.array(F.lit(1), F.lit(2)), lambda i: F.when(i == 1, F.col("c") < 18).otherwise(F.col("c") >= 14))
    pixels = rows.withColumn("burst", F.explode(hits)).withColumn("iw", F.explode(swaths)).withColumn("burst", F.col("burst").cast("int"))
    jump = F.expr("burst div 3") * F.col("date") * 0.7
    phase = F.col("date") * (0.002 * F.col("r") + 0.003 * F.col("c")) + jump
    pixels = pixels.select("frame", "date", "iw", "burst", "r", "c", (F.col("amp") * F.cos(phase)).alias("re"), (F.col("amp") * F.sin(phase)).alias("im"))
    bursts = pixels.groupBy("frame", "date", "iw", "burst").agg(F.min("r").alias("top"), F.max("r").alias("bottom"))
    bursts = bursts.withColumn("acquisition", F.expr("cast(burst div 3 as string)"))
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "date1 int, date2 int")
    out = drivers.interfere_bursts(bursts, pixels, pairs, 300, 32, (10, 4), keys=["frame"])
    return out.select("date1", "date2", "frame", F.col("r").cast("long").alias("r"), "c", r6(F.col("re")).alias("re"), r6(F.col("im")).alias("im"))


source_queries.add(query)
