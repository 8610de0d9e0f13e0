"""Incremental processing of arriving scenes: an extension, since the batch runs are only restarted.

``new_pairs`` is a stateless micro-batch step over a table of known dates; ``running_velocity`` keeps
two sums per pixel.
"""

from __future__ import annotations

import math
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasegrid.operators.joins import pairs_within
from phasegrid.operators.timeseries import SMALL, WAVELENGTH, YEAR


def arriving(spark: SparkSession, path: str, watermark: str = "7 days") -> DataFrame:
    """Scenes (scene string, at timestamp, date date) as JSON files arrive, each scene once."""
    stream = spark.readStream.schema("scene string, at timestamp, date date").json(path)
    return stream.withWatermark("at", watermark).dropDuplicatesWithinWatermark(["scene"])


def extend_pairs(scenes: DataFrame, dates_path: str, pairs_path: str, checkpoint: str, days: tuple[int, int] = (6, 100)):
    """Start a query that appends each batch's dates and the pairs they form with known ones. A batch
    that is replayed writes the same files again (one folder per batch id)."""
    spark = scenes.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        new = batch.select("date").distinct()
        new.write.mode("overwrite").parquet(os.path.join(dates_path, f"batch={number}"))
        every = spark.read.parquet(dates_path).where(F.col("batch") <= number).select("date").distinct()
        new = spark.read.parquet(os.path.join(dates_path, f"batch={number}"))
        earlier = spark.read.parquet(dates_path).where(F.col("batch") < number).select("date").distinct()
        fresh = new.join(earlier, "date", "left_anti")
        pairs = pairs_within(every, "date", *days)
        touched = pairs.join(fresh.select(F.col("date").alias("date1")), "date1", "left_semi").unionByName(
            pairs.join(fresh.select(F.col("date").alias("date2")), "date2", "left_semi")
        )
        touched.distinct().write.mode("overwrite").parquet(os.path.join(pairs_path, f"batch={number}"))

    return scenes.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_velocity(observations: DataFrame, px: list[str], wavelength: float = WAVELENGTH) -> DataFrame:
    """Stack velocity per pixel of a stream of (px, days, u), as two running sums."""
    sums = observations.groupBy(*px).agg(F.sum("u").alias("u"), F.sum(F.col("days").cast("double")).alias("bl"), F.count("*").alias("n"))
    return sums.select(*px, "n", (F.col("u") / (F.col("bl") + SMALL) * (wavelength / (4 * math.pi) * YEAR)).alias("velocity"))
