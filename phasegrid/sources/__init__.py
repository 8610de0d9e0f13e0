"""Sources and sinks: binary rasters, side-cars, orbits, catalogues."""

from phasegrid.sources.binary import PushingSource, RasterSource

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def register(spark) -> None:
    """Make ``spark.read.format("raster")`` and ``df.write.format("raster")`` known to a session.

    Filter pushdown is turned on where the session has no setting of its own; one that has it off
    reads whole files and filters the rows afterwards."""
    if PUSHDOWN not in spark.conf.getAll:
        spark.conf.set(PUSHDOWN, "true")
    pushes = spark.conf.get(PUSHDOWN).lower() == "true"
    spark.dataSource.register(PushingSource if pushes else RasterSource)
