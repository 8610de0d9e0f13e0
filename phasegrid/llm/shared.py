"""Small helpers that several training-data operators use."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from phasegrid.session import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: White space as the contracts define it: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of rows after which a batch for Python is closed; a longer row is one of its own.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only where it is unset and
    the session is local (tests) a temporary folder is made and set."""
    return shared_folder(spark)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def in_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with batches of about ``BATCH_BYTES``, where the session has no setting of its own:
    batches are held in the executor's native memory, its heap and the Python worker at once."""
    if BATCH not in df.sparkSession.conf.getAll:
        df.sparkSession.conf.set(BATCH, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def listed(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table of the driver's as part of the plan. From a list Spark makes an RDD, whose rows pass
    through Python workers that stay in the executors' memory."""
    kinds = StructType.fromDDL(schema)
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(kinds.names, r, strict=True)) for r in rows], schema=to_arrow_schema(kinds)), schema=kinds)


def regrouped(df: DataFrame, key: str) -> DataFrame:
    """The same rows, without the planner knowing that an aggregate has dealt them by ``key``. A join
    then exchanges this (small) side by itself, both sides of it are plain exchanges, and AQE can
    split the other side at a hot key."""
    same = F.substring(key, 1, 1 << 20) if dict(df.dtypes)[key] == "binary" else F.shiftleft(key, 0)
    return df.withColumn(key, same)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the fast path; others go letter by letter."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores before it until no column has it (names ignore case)."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def schema_of(df: DataFrame, *more: str) -> str:
    """The DDL of a frame's columns and of those that are added."""
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + list(more))


def stay(docs: DataFrame, kept: DataFrame, digest: Column) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, digest of the text) is in ``kept(doc_id, digest)``, with
    their columns; of repeated rows one. Texts are shuffled once, by id and digest together."""
    key, own = fresh("__key", docs.columns), fresh("__digest", docs.columns)
    number = fresh("__number", docs.columns)
    ids = kept.select(F.xxhash64(F.col("doc_id").cast("long")).alias(key), F.col("digest").alias(own)).distinct()
    rows = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"))).withColumn(own, digest).join(ids, [key, own], "left_semi")
    once = Window.partitionBy(key, own).orderBy(key)
    return rows.withColumn(number, F.row_number().over(once)).where(F.col(number) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
