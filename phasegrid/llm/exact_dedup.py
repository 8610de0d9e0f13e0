"""Exact dedup over an extendible-hash index that lies on shared files.

1. One reading of the texts gives a light row for each document: the 64-bit key and the SHA-256 of
   its normalised text. Different keys are counted by their leading bits, and the directory is grown
   from these counts: it starts with one slot and doubles while a bucket holds more than
   ``bucket_entries`` keys. A bucket that isn't overfull keeps its shorter local depth and is pointed
   to by several slots. Keys whose leading ``MAX_DEPTH`` bits agree share a bucket, however many.
2. Each text goes to the owner of its key. Copies are merged within a map task first, so a group with
   a third of all rows reaches its owner as one row per task. The owner chains the different texts
   that share a key, comparing them byte by byte. A link of a chain has the SHA-256 of its text.
3. Entries (bucket, key, place in the chain, digest, row that stays, number of copies) are written to
   the index files, each file a range of keys.
4. Documents probe the index: the directory gives the bucket of a key, and the digest the link of its
   chain. What isn't in the bucket that the directory names isn't found.

Null texts count as empty. The row with the largest ``doc_id`` stays; null ids lose to any id, and a
group of null ids only keeps one row. Of repeated rows with that id one stays. A text of any length
is one value and is hashed and compared whole. An empty table gives an empty result. Extra columns
of the input are ignored by ``exact_groups``. The index stays on the shared files for later probes
(``build_index`` names its folder).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasegrid.llm.shared import cut, fold_ascii, listed, shared_path, stay, text_or_empty

MAX_DEPTH, FIRST_BITS = 16, 8
INDEX = "bucket int, key long, link int, digest string, keep_id long, group_size long"


@dataclass(frozen=True)
class Directory:
    """``buckets[slot]`` for each of the 2**depth leading-bit patterns of a key."""

    depth: int
    buckets: list[int]
    local_depths: list[int]


def slot_of(key: Column, depth: int) -> Column:
    if depth == 0:
        return F.lit(0)
    return F.shiftrightunsigned(key, 64 - depth).cast("int")


def grow_directory(keys: DataFrame, bucket_entries: int, max_depth: int = MAX_DEPTH) -> Directory:
    """Split overfull buckets, doubling the directory where a bucket is as deep as the directory, until
    none is overfull or ``max_depth`` is reached. ``keys(key)`` are distinct; the driver sees one
    count per leading-bit pattern, of ``max_depth`` bits only where fewer bits don't suffice."""
    for bits in (min(FIRST_BITS, max_depth), max_depth):
        sums = np.zeros((1 << bits) + 1, dtype=np.int64)
        for row in keys.groupBy(slot_of(F.col("key"), bits).alias("slot")).agg(F.count("*").alias("n")).collect():
            sums[1 + row["slot"]] = row["n"]
        if sums.max() <= bucket_entries:
            break
    sums, max_depth = np.cumsum(sums), bits
    depth, leaves, open_buckets = 0, [], [(0, 0)]
    while open_buckets:
        local, prefix = open_buckets.pop()
        low, high = prefix << (max_depth - local), (prefix + 1) << (max_depth - local)
        if sums[high] - sums[low] <= bucket_entries or local == max_depth:
            leaves.append((low, local))
            continue
        depth = max(depth, local + 1)
        open_buckets += [(local + 1, 2 * prefix), (local + 1, 2 * prefix + 1)]
    leaves.sort()
    local_depths = [local for _, local in leaves]
    buckets = np.repeat(np.arange(len(leaves)), [1 << (depth - local) for local in local_depths])
    return Directory(depth, buckets.tolist(), local_depths)


def with_bucket(df: DataFrame, directory: Directory) -> DataFrame:
    """Look the bucket up in the directory, a broadcast table of 2**MAX_DEPTH rows at most."""
    if directory.depth == 0:
        return df.withColumn("bucket", F.lit(0))
    slots = listed(df.sparkSession, list(enumerate(directory.buckets)), "slot int, bucket int")
    return df.withColumn("slot", slot_of(F.col("key"), directory.depth)).join(F.broadcast(slots), "slot").drop("slot")


def probes(docs: DataFrame) -> DataFrame:
    """(doc_id, key, digest, n_bytes) of ``docs(doc_id, text)``."""
    norm = fold_ascii(F.col("text"))
    return docs.select("doc_id", F.xxhash64(norm).alias("key"), F.sha2(norm, 256).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"))


def chains(docs: DataFrame, directory: Directory) -> DataFrame:
    """(bucket, key, link, digest): the different texts that share a key, in byte order. The texts of a
    key meet in its owner task, merged per map task before."""
    rows = with_bucket(docs.select(fold_ascii(F.col("text")).alias("norm")).withColumn("key", F.xxhash64("norm")), directory)
    chained = rows.groupBy("bucket", "key").agg(F.array_sort(F.collect_set("norm")).alias("chain"))
    digests = F.transform("chain", lambda text: F.sha2(text, 256))
    return chained.select("bucket", "key", F.posexplode(digests).alias("link", "digest"))


def build_index(docs: DataFrame, rows: DataFrame, bucket_entries: int = 2_000) -> tuple[DataFrame, Directory]:
    """Write the index of ``docs(doc_id, text)``, whose ``probes`` are ``rows``, and return it with its
    directory."""
    spark = docs.sparkSession
    directory = grow_directory(rows.select("key").distinct(), bucket_entries)
    members = with_bucket(rows, directory).groupBy("bucket", "key", "digest")
    members = members.agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    entries = chains(docs, directory).join(members, ["bucket", "key", "digest"])
    path = shared_path(spark, "index")
    by_range = entries.repartitionByRange("bucket").sortWithinPartitions("bucket", "key", "link")
    by_range.select("bucket", "key", "link", "digest", "keep_id", "group_size").write.parquet(path)
    return spark.read.schema(INDEX).parquet(path), directory


def exact_groups(docs: DataFrame, bucket_entries: int = 2_000) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_bytes."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = cut(probes(ids))
    index, directory = build_index(ids, rows, bucket_entries)
    found = with_bucket(rows, directory).join(index, ["bucket", "key", "digest"])
    # By id and digest, not by key: the probe's exchange stays free for AQE to split a hot group.
    same = Window.partitionBy("doc_id", "digest").orderBy("n_bytes")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(same) == 1)
    return found.select(
        "doc_id", "keep_id", "group_size", stays.alias("kept"), F.col("digest").alias("text_sha256"), "n_bytes"
    )


def exact_dedup(docs: DataFrame, bucket_entries: int = 2_000) -> DataFrame:
    """The documents that stay, with all their columns. Ids are taken to be unique but for repeated
    rows; of those with equal id and text one stays."""
    kept = exact_groups(docs, bucket_entries).where("kept").select("doc_id", F.col("text_sha256").alias("digest"))
    return stay(docs, kept, F.sha2(fold_ascii(text_or_empty()), 256))
