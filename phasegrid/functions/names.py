"""Names, tags, times and typed values as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def product_parts(name: Column) -> Column:
    """The fields of a Sentinel-1 style product name, as a struct."""
    p = F.split(F.regexp_replace(name, r"\.[A-Za-z]+$", ""), "[_.]+")
    at = lambda i: F.get(p, F.lit(i))
    # A level-0 to -2 product has "1SDV": level, class and polarisation in one field.
    return F.struct(
        at(0).alias("mission"), at(1).alias("mode"), at(2).alias("product"),
        F.substring(at(3), 1, 1).alias("level"), F.substring(at(3), 2, 1).alias("class"), F.substring(at(3), 3, 2).alias("polarisation"),
        at(4).alias("start"), at(5).alias("stop"), at(6).alias("orbit"), at(7).alias("mission_id"), at(8).alias("unique_id"),
        F.substring(at(4), 1, 8).alias("date"),
    )


def burst_parts(path: Column) -> Column:
    """date, mission, unique id, subswath and number of ``{date}_{mission}_{unique}_iw{n}_burst_{i}``."""
    stem = F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)
    pattern = r"^(\d{8})_([^_]+)_([^_]+)_iw(\d)_burst_(\d+)"
    group = lambda i: F.regexp_extract(stem, pattern, i)
    return F.struct(
        group(1).alias("date"), group(2).alias("mission"), group(3).alias("unique_id"),
        F.try_to_number(group(4), F.lit("9")).cast("int").alias("iw"), group(5).try_cast("int").alias("burst"),
    )


def orbit_validity(name: Column) -> Column:
    """(start, stop) of ``..._V<start>_<stop>.EOF`` as timestamps."""
    start, stop = (F.regexp_extract(name, r"_V(\d{8}T\d{6})_(\d{8}T\d{6})", i) for i in (1, 2))
    return F.struct(parse_stamp(start).alias("start"), parse_stamp(stop).alias("stop"))


def parse_stamp(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyyMMdd'T'HHmmss"))


def parse_day(text: Column) -> Column:
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd")))


def middle(start: Column, stop: Column) -> Column:
    """The instant halfway; works with and without a time zone."""
    return start + (stop - start) / 2


def seconds_of_day(at: Column) -> Column:
    return F.hour(at) * 3600.0 + F.minute(at) * 60.0 + F.extract(F.lit("SECOND"), at).cast("double")


def tag_text(text: Column, tag: str) -> Column:
    """What stands between the tag and the next ``<``, at its first occurrence."""
    return F.regexp_extract(text, rf"<{tag}(?:\s[^>]*)?>([^<]*)", 1)


def area_tag(south: Column, north: Column, west: Column, east: Column) -> Column:
    """S/N and W/E letters with whole degrees, for file names."""

    def one(value: Column, low: str, high: str) -> Column:
        return F.concat(F.when(value < 0, low).otherwise(high), F.abs(value.cast("int")).cast("string"))

    return F.concat_ws("_", one(south, "S", "N"), one(north, "S", "N"), one(west, "W", "E"), one(east, "W", "E"))


def number_kind(text: Column) -> Column:
    """``int``, ``float`` or ``string``: how a parameter's text is read."""
    whole = text.rlike(r"^\s*[+-]?\d+\s*$")
    real = text.try_cast("double").isNotNull()
    return F.when(whole, "int").when(real, "float").otherwise("string")


def query_url(base: str, parameters: dict[str, Column]) -> Column:
    pairs = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}="), F.url_encode(v.cast("string")))) for k, v in parameters.items()]
    return F.concat(F.lit(f"{base}?"), F.concat_ws("&", *pairs))


def year_ranges(start: Column, end: Column) -> Column:
    """The parts of [start, end] that fall into each calendar year, as array<struct<from, to>>."""
    return F.transform(
        F.sequence(F.year(start), F.year(end)),
        lambda y: F.struct(F.greatest(start, F.make_date(y, F.lit(1), F.lit(1))).alias("from"), F.least(end, F.make_date(y, F.lit(12), F.lit(31))).alias("to")),
    )


def invalid_lines(samples: Column) -> Column:
    """From a space-separated list with −1 for invalid lines: counts in both halves and the middle."""
    items = F.split(F.trim(samples), r"\s+")
    half = F.floor(F.size(items) / 2).cast("int")
    count = lambda part: F.size(F.filter(part, lambda x: x == "-1"))
    return F.struct(
        count(F.slice(items, F.lit(1), half)).alias("first"), count(F.slice(items, half + 1, F.size(items))).alias("last"),
        F.get(items, half).try_cast("int").alias("middle"),
    )
