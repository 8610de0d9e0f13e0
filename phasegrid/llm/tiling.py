"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs free of white space and ASCII punctuation. Hashes of all ``k``-word runs
of the documents are joined with those of the benchmark items (the seeds). For each pair of a
document and an item that share a seed, running Karp-Rabin finds matches of a search length, the
longest free ones are marked first as tiles, and the search length falls until ``k``. The tiles don't
overlap in either text and may stand in any order, so a reordered passage is covered like a plain
one. A pair is contaminated if the tiles cover ``coverage`` of the item's words or more.

The seeds of the benchmark are looked up within the task that reads a document, so documents aren't
shuffled. What travels with the task is bounded: items are taken in chunks of ``chunk_words`` words,
and each chunk is one pass over the documents; a longer item is a chunk of its own.

Items of fewer than ``k`` words can't be told from chance and are left out. Null texts count as
empty; documents and items of any length are read whole. Empty tables give empty results, or documents that all stay. Repeated rows and items are each
judged by themselves. Extra columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phasegrid.llm import tokens
from phasegrid.llm.shared import WORD, cut, fresh, in_arrow, schema_of, text_or_empty


#: Pairs of places with equal hashes that are listed at once.
PAIRS = 1 << 21


def _rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``width`` ids."""
    sums = np.zeros(len(ids) + 1, dtype=np.uint64)
    np.cumsum(ids * tokens.powers(len(ids)), out=sums[1:])
    return (sums[width:] - sums[:-width]) * tokens.powers(len(ids) + 1, inverse=True)[: len(ids) - width + 1]


def _all_free(free: np.ndarray, width: int) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(free)))
    return sums[width:] - sums[:-width] == width


def _matches(low: np.ndarray, high: np.ndarray, p: np.ndarray, order: np.ndarray, width: int) -> np.ndarray:
    """Rows (length, place in doc, place in item) of the maximal matches of ``width`` or more, from the
    places ``p`` of equal hashes order[low:high]. Consecutive places on a diagonal are one match, so a
    word that both texts repeat costs a row per diagonal, and pairs are listed ``PAIRS`` at a time."""
    counts = high - low
    runs = np.zeros((0, 3), dtype=np.int64)  # diagonal, first place, last place
    ends = np.cumsum(counts)
    at = 0
    while at < len(p):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        n = counts[at:to]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        t, place = order[np.repeat(low[at:to], n) + inner], np.repeat(p[at:to], n)
        place, t = place.astype(np.int64), t.astype(np.int64)
        new = np.concatenate((runs, np.stack([place - t, place, place], axis=1)))
        new = new[np.lexsort((new[:, 1], new[:, 0]))]
        first = np.concatenate(([True], (new[1:, 0] != new[:-1, 0]) | (new[1:, 1] != new[:-1, 2] + 1))) if len(new) else np.zeros(0, bool)
        begin = np.flatnonzero(first)
        last = np.concatenate((begin[1:] - 1, [len(new) - 1])) if len(new) else begin
        runs = np.stack([new[begin, 0], new[begin, 1], new[last, 2]], axis=1)
        at = to
    return np.stack([runs[:, 2] - runs[:, 1] + width, runs[:, 1], runs[:, 1] - runs[:, 0]], axis=1)


def tile(doc: np.ndarray, item: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Tiles (place in doc, place in item, length >= k), longest first."""
    free_d, free_t = np.ones(len(doc), dtype=bool), np.ones(len(item), dtype=bool)
    out: list[tuple[int, int, int]] = []
    width = min(len(item), len(doc), 4 * k)
    if width < k:
        return out
    while True:
        of_doc, of_item = _rolling(doc, width), _rolling(item, width)
        ok_d, ok_t = np.flatnonzero(_all_free(free_d, width)), np.flatnonzero(_all_free(free_t, width))
        order = ok_t[np.argsort(of_item[ok_t], kind="stable")]
        keys = of_item[order]
        low, high = np.searchsorted(keys, of_doc[ok_d], "left"), np.searchsorted(keys, of_doc[ok_d], "right")
        found = _matches(low[high > low], high[high > low], ok_d[high > low], order, width)
        longest = int(found[:, 0].max()) if len(found) else 0
        if longest > 2 * width:
            width = longest
            continue
        by_length: dict[int, list[tuple[int, int]]] = {}
        for length, p, t in found[np.lexsort((found[:, 2], found[:, 1]))].tolist():
            by_length.setdefault(length, []).append((p, t))
        for length in range(longest, width - 1, -1):
            for p, t in by_length.pop(length, ()):
                good = free_d[p : p + length] & free_t[t : t + length]
                if good.all():
                    free_d[p : p + length] = free_t[t : t + length] = False
                    out.append((p, t, length))
                else:  # what a longer tile left of it goes back to the queue
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], good.view(np.int8), [0]))))
                    for a, b in zip(edge[::2], edge[1::2], strict=True):
                        if b - a >= width:
                            by_length.setdefault(int(b - a), []).append((p + int(a), t + int(a)))
        if width == k:
            return out
        width = max(k, width // 2)


def chunks(benchmark: DataFrame, k: int, chunk_words: int) -> Iterator[list[tuple[int, str]]]:
    """Items of at least ``k`` words, in runs of about ``chunk_words`` words; one run at a time
    reaches the driver."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower(text_or_empty()).alias("text"))
    items = items.withColumn("n", F.regexp_count("text", F.lit(WORD)).cast("long")).where(F.col("n") > 0)
    total = items.agg(F.sum("n")).first()[0] or 0
    if total <= chunk_words:
        if rows := items.select("item_id", "text").collect():
            yield [tuple(r) for r in rows]
        return
    # Buckets by hash keep the running sum off the rows: each holds about a sixteenth of a chunk.
    parts = int(16 * (total // chunk_words + 1))
    dealt = cut(items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))))
    sums = dealt.groupBy("part").agg(F.sum("n").alias("n"))
    run = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    ends = {r["part"]: (r["e"] - r["n"]) // chunk_words for r in sums.withColumn("e", F.sum("n").over(run)).collect()}
    for number in range(max(ends.values()) + 1):
        own = [p for p, c in ends.items() if c == number]
        if own:
            yield [tuple(r) for r in dealt.where(F.col("part").isin(own)).select("item_id", "text").collect()]


def mark(docs: DataFrame, items: list[tuple[int, str]], k: int, coverage: float) -> tuple[DataFrame, str]:
    """All columns of ``docs`` and ``hits``: array<struct<item_id, coverage, tiles>> of the items of
    one chunk that contaminate the document."""
    names = docs.columns
    out = fresh("hits", names)
    lower = fresh("__lower", names)
    ids = [i for i, _ in items]
    seeds: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    item_words: list[np.ndarray] = []
    for at, end, data, offsets in tokens.blocks(pa.array([t for _, t in items], pa.large_string())):
        hashes, _, _, first = tokens.words(data, offsets, ignore_marks=True)
        item_words += [hashes[first[r] : first[r + 1]] for r in range(end - at)]
        sh, start, _ = tokens.shingles(hashes, first, k)
        owner = np.searchsorted(first, start, side="right") - 1
        long = np.diff(first)[owner] >= k
        seeds.append(sh[long])
        owners.append(owner[long] + at)
    every, owner = np.concatenate(seeds), np.concatenate(owners)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = np.zeros(1 << 22, dtype=bool)
        sieve[every >> np.uint64(42)] = True
        for batch in batches:
            for at, end, data, offsets in tokens.blocks(batch.column(len(names))):
                hashes, _, _, first = tokens.words(data, offsets, ignore_marks=True)
                sh, start, first_sh = tokens.shingles(hashes, first, k)
                maybe = np.flatnonzero(sieve[sh >> np.uint64(42)])
                low, high = np.searchsorted(every, sh[maybe], "left"), np.searchsorted(every, sh[maybe], "right")
                pairs: dict[int, set[int]] = {}
                rows = np.searchsorted(first_sh, maybe, side="right") - 1
                for r, lo, hi in zip(rows, low, high, strict=True):
                    if hi > lo:
                        pairs.setdefault(int(r), set()).update(owner[lo:hi].tolist())
                hits: list[list[dict]] = [[] for _ in range(end - at)]
                for r, found in pairs.items():
                    own = hashes[first[r] : first[r + 1]]
                    for i in sorted(found):
                        tiles = tile(own, item_words[i], k)
                        share = sum(t[2] for t in tiles) / len(item_words[i])
                        if share >= coverage:
                            hits[r].append({"item_id": ids[i], "coverage": share, "tiles": len(tiles)})
                kind = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.int32())]))
                yield pa.RecordBatch.from_arrays([*batch.slice(at, end - at).columns[: len(names)], pa.array(hits, kind)], names=[*names, out])

    source = docs.withColumn(lower, F.lower(text_or_empty()))
    return in_arrow(source, run, schema_of(docs, f"`{out}` array<struct<item_id: bigint, coverage: double, tiles: int>>")), out


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, k: int = 5, coverage: float = 0.5, chunk_words: int = 2_000_000) -> DataFrame:
    """A row for each contaminated pair: doc_id, item_id, coverage, tiles."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, coverage double, tiles int")
    for items in chunks(benchmark, k, chunk_words):
        marked, name = mark(ids, items, k, coverage)
        out = out.unionByName(marked.select("doc_id", F.explode(name).alias("h")).select("doc_id", "h.*"))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, k: int = 5, coverage: float = 0.5, chunk_words: int = 2_000_000) -> DataFrame:
    """The documents that no item contaminates, with their columns."""
    out = docs
    for items in chunks(benchmark, k, chunk_words):
        marked, name = mark(out, items, k, coverage)
        out = marked.where(F.size(name) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
    return out
