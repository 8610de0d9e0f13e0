"""Connected components of an edge table by minimum-label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasegrid.llm.shared import cut


#: Edges per file of a checkpoint: a small table isn't written as one file per shuffle partition.
FILE_EDGES = 20_000
#: Up to so many edges the table of least neighbours (at most two rows of some 50 bytes per edge) is
#: broadcast; beyond, it is materialised, so that AQE can split the join at a node with many edges.
SMALL_EDGES = 100_000


def components(edges: DataFrame, max_rounds: int = 60, small_edges: int = SMALL_EDGES) -> DataFrame:
    """(node, label) for all nodes of ``edges(a, b)``; the label is the component's least node.

    Large-star and small-star rounds alternate: each node links its larger neighbours to its least
    one, then its smaller ones. Edges never outnumber the input's, paths shorten geometrically, and
    after each round the edge table is checkpointed, so a lost executor costs one round. Only the
    counts reach the driver."""
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = cut(both)
    before, count = None, now.count()

    def side(least: DataFrame) -> DataFrame:
        return F.broadcast(least) if count <= small_edges else cut(least)

    for _ in range(max_rounds):
        sides = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = side(sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")))
        large = sides.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = side(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        joined = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = cut(joined.coalesce(count // FILE_EDGES + 1))
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, count = state, state[0]
    else:
        raise RuntimeError("components did not settle")
    labels = now.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label")
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
