"""Product annotation as DataFrames: scalar parameters, bursts, state vectors and polynomials.

Input rows hold one document each (key columns and ``xml``), as ``archive.member_texts`` or
``spark.read.text(wholetext=True)`` give them. Everything is XPath and string expressions in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasegrid.functions.names import invalid_lines, tag_text

LIGHT = 299792458.0
#: Parameter, element, type.
SCALARS = (
    ("mission", "missionId", "string"), ("polarisation", "polarisation", "string"), ("swath", "swath", "string"), ("direction", "pass", "string"),
    ("start_time", "productFirstLineUtcTime", "timestamp"), ("range_sampling_rate", "rangeSamplingRate", "double"), ("frequency", "radarFrequency", "double"),
    ("steering_rate", "azimuthSteeringRate", "double"), ("slant_range_time", "slantRangeTime", "double"), ("line_interval", "azimuthTimeInterval", "double"),
    ("prf", "azimuthFrequency", "double"), ("range_spacing", "rangePixelSpacing", "double"), ("azimuth_spacing", "azimuthPixelSpacing", "double"),
    ("samples", "numberOfSamples", "int"), ("lines", "numberOfLines", "int"), ("lines_per_burst", "linesPerBurst", "int"), ("samples_per_burst", "samplesPerBurst", "int"),
)


def _texts(path: str) -> Column:
    return F.xpath("xml", F.lit(f"{path}/text()"))


def parameters(documents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One typed row per document, with near range, wavelength and the time of the last line."""
    found = documents.select(*keys, *[tag_text(F.col("xml"), tag).try_cast(kind).alias(name) for name, tag, kind in SCALARS])
    last = F.timestamp_micros((F.unix_micros("start_time") + F.round((F.col("lines") - 1) * F.col("line_interval") * 1e6)).cast("long"))
    return found.withColumns({
        "near_range": F.col("slant_range_time") * LIGHT / 2, "wavelength": F.try_divide(F.lit(LIGHT), F.col("frequency")), "end_time": last,
    })


def long_parameters(documents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same as (keys, name, value) texts, for a parameter store."""
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), tag_text(F.col("xml"), t).alias("value")) for n, t, _ in SCALARS])
    return documents.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.*").where("value <> ''")


def bursts(documents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, burst, azimuth_time, byte_offset, first and last invalid lines, first valid sample)."""
    path = "//swathTiming/burstList/burst"
    zipped = F.arrays_zip(
        _texts(f"{path}/azimuthTime").alias("azimuth_time"), _texts(f"{path}/byteOffset").alias("byte_offset"), _texts(f"{path}/firstValidSample").alias("first_valid")
    )
    rows = documents.select(*keys, F.posexplode(zipped).alias("burst", "b"))
    valid = invalid_lines(F.col("b.first_valid"))
    return rows.select(
        *keys, "burst", F.col("b.azimuth_time").try_cast("timestamp").alias("azimuth_time"), F.col("b.byte_offset").try_cast("long").alias("byte_offset"),
        valid["first"].alias("invalid_first"), valid["last"].alias("invalid_last"), valid["middle"].alias("first_sample"),
    )


def state_vectors(documents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, t, x, y, z, vx, vy, vz) with full timestamps."""
    parts = {"t": "time", "x": "position/x", "y": "position/y", "z": "position/z", "vx": "velocity/x", "vy": "velocity/y", "vz": "velocity/z"}
    zipped = F.arrays_zip(*[_texts(f"//orbitList/orbit/{p}").alias(n) for n, p in parts.items()])
    rows = documents.select(*keys, F.explode(zipped).alias("o"))
    return rows.select(*keys, F.col("o.t").try_cast("timestamp").alias("t"), *[F.col(f"o.{n}").try_cast("double").alias(n) for n in parts if n != "t"])


def polynomials(documents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, kind, t, t0, c0, c1, c2) of FM rates (either spelling) and Doppler centroids."""
    fm, dc = "//azimuthFmRateList/azimuthFmRate", "//dcEstimateList/dcEstimate"

    def listed(kind: str, path: str, time: str, poly: str) -> DataFrame:
        # One text of three numbers, or else three elements of one number each.
        texts = F.transform(_texts(f"{path}/{poly}"), lambda x: F.split(F.trim(x), r"\s+"))
        apart = F.transform(
            F.arrays_zip(*[_texts(f"{path}/{c}").alias(c) for c in ("c0", "c1", "c2")]), lambda x: F.array(x["c0"], x["c1"], x["c2"])
        )
        zipped = F.arrays_zip(
            _texts(f"{path}/{time}").alias("t"), _texts(f"{path}/t0").alias("t0"), F.when(F.size(texts) > 0, texts).otherwise(apart).alias("c")
        )
        rows = documents.select(*keys, F.explode(zipped).alias("p"))
        number = [F.get("p.c", F.lit(i)).try_cast("double").alias(f"c{i}") for i in range(3)]
        return rows.select(*keys, F.lit(kind).alias("kind"), F.col("p.t").try_cast("timestamp").alias("t"), F.col("p.t0").try_cast("double").alias("t0"), *number)

    return listed("fm", fm, "azimuthTime", "azimuthFmRatePolynomial").unionByName(listed("dc", dc, "azimuthTime", "dataDcPolynomial"))
