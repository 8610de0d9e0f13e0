"""The scalar functions as SQL functions: their bodies are expanded into the plan, so a query in SQL
text stays within Catalyst."""

from __future__ import annotations

from pyspark.sql import SparkSession

from phasegrid.functions.geo import E2, MAJOR

FUNCTIONS = {
    "pg_wrap(x DOUBLE) RETURNS DOUBLE": "x - 2 * pi() * ceil((x - pi()) / (2 * pi()))",
    "pg_wrap_positive(x DOUBLE) RETURNS DOUBLE": "x - 2 * pi() * floor(x / (2 * pi()))",
    "pg_wrap_cycles(x DOUBLE) RETURNS DOUBLE": "x - floor(x + 0.5D)",
    "pg_soft_threshold(x DOUBLE, k DOUBLE) RETURNS DOUBLE": "greatest(0D, x - k) - greatest(0D, -x - k)",
    "pg_displacement(phase DOUBLE, wavelength DOUBLE) RETURNS DOUBLE": "phase * wavelength / (4 * pi())",
    "pg_ifg_re(are DOUBLE, aim DOUBLE, bre DOUBLE, bim DOUBLE) RETURNS DOUBLE": "are * bre + aim * bim",
    "pg_ifg_im(are DOUBLE, aim DOUBLE, bre DOUBLE, bim DOUBLE) RETURNS DOUBLE": "are * bim - aim * bre",
    "pg_row(lat DOUBLE, lat_max DOUBLE, dlat DOUBLE) RETURNS INT": "cast((lat - lat_max) / dlat AS INT)",
    "pg_col(lon DOUBLE, lon_min DOUBLE, dlon DOUBLE) RETURNS INT": "cast((lon - lon_min) / dlon AS INT)",
    "pg_radius_east(lat DOUBLE) RETURNS DOUBLE": f"{MAJOR!r}D / sqrt(1 - {E2!r}D * sin(radians(lat)) * sin(radians(lat)))",
    "pg_date(name STRING) RETURNS DATE": "to_date(try_to_timestamp(substring(name, 1, 8), 'yyyyMMdd'))",
}


def register(spark: SparkSession) -> list[str]:
    """Create the temporary functions and return their names."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.partition("(")[0] for head in FUNCTIONS]
