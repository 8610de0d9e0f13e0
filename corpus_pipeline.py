"""The training-corpus pipeline: quality, exact copies, near copies, benchmark leaks, mixing.

Each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept. The
driver of the stages writes each result as Parquet and rereads it for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasegrid.llm import exact_dedup, jaccard_join, mixing, quality, tiling
from phasegrid.llm.shared import shared_path, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.7 or more stay."""
    return quality.quality_filter(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the document with the least doc_id stays."""
    return jaccard_join.near_dedup(docs)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates stay."""
    return tiling.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document and the training position of each of its copies, in the
    order of the first; documents that aren't taken come last."""
    mixed = mixing.with_positions(mixing.mix(docs, schedules=mixing.CURRICULUM))
    out = mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken", "position", "positions", "h")
    return out.orderBy(F.col("position").asc_nulls_last(), "h").drop("h")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("decontamination", leak_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        if name == STAGES[-1][0]:
            return out
        path = shared_path(spark, "stage")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    raise ValueError("STAGES is empty")


#: A trained model and a forest of signatures have no SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None
