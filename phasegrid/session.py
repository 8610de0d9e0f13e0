"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators are written for. Partition counts are left to AQE beyond a start value.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(partitions))
    builder = builder.config("spark.driver.memory", memory).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a session on one machine may do without and gets a temporary one."""
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        path = tempfile.mkdtemp(prefix="phasegrid-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
