"""Suffix-array dedup: maximal repeats over enhanced suffix arrays of anchored contexts.

A string of ``length`` bytes that starts at two places is a repeat. Every such string has an anchor,
the rightmost of its ``gram``-byte substrings with the least hash; equal strings have equal anchors
at equal offsets. So repeats can be found anchor by anchor:

1. Each text is read once and its anchors are listed: about two in ``length - gram`` bytes. Hashes of
   anchors are counted with partial aggregation, and those seen once are left out.
2. An anchor that is seen again is sent, with the bytes around it that its strings cover, to the
   task that owns its hash. The task sorts the suffixes that start at the anchor, computes the
   common-prefix lengths of neighbours and stack-scans them into the interval tree. Within each
   interval the left contexts are sorted and scanned in the same way: a set of occurrences that can't
   be extended on either side (left-extension diversity) is a maximal repeat, with all occurrences.
3. An anchor with more than ``max_group`` occurrences isn't gathered by one task. Its strings are
   counted one by one by their 128-bit digest, again with partial aggregation: an exact way that
   deals any group over all tasks.

Offsets are bytes of the UTF-8 text. Null texts count as empty and matches never cross documents.
Rows are told apart by their id and text, so repeated rows are copies of one another and each is
removed like any copy; rows with null ids take part. A text of any length is read whole. Texts shorter than ``length`` bytes keep all
their bytes. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasegrid.llm import tokens
from phasegrid.llm.shared import cut, regrouped, text_or_empty

GRAM = 32
#: A place is packed with the bytes needed on either side, in ten bits each.
MAX_LENGTH = 1023


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first start, last start) of each anchor of a block of texts; the starts are
    those of the strings that it belongs to."""
    n, span = len(data), length - gram + 1
    if n < length:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * tokens.powers(n), out=sums[1:])
    grams = tokens.mix64((sums[gram:] - sums[:-gram]) * tokens.powers(n + 1, inverse=True)[: n + 1 - gram])
    # Least hash first, rightmost place second.
    rank = (grams & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(len(grams), dtype=np.uint64))
    low, width = rank, 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: len(rank) - span + 1], low[span - width :])
    place = (np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.int64)
    good = np.ones(len(place), dtype=bool)
    for end in offsets[1:]:  # strings that would cross the end of a text
        good[max(0, end - length + 1) : end] = False
    starts = np.flatnonzero(good)
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    own = place[starts]
    new = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1))))
    last = np.concatenate((new[1:] - 1, [len(starts) - 1]))
    return grams[own[new]].view(np.int64), own[new], starts[new], starts[last]


def _keys(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, text): the two hashes tell rows apart."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return base.select(F.xxhash64("doc_id").alias("k1"), F.xxhash64("text").alias("k2"), "doc_id", "text")


def list_anchors(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, k1, k2, packed): ``packed`` holds place, bytes needed before and bytes needed after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, _, data, offsets in tokens.blocks(batch.column(2)):
                h, place, first, last = anchors(data, offsets, length, gram)
                row = np.searchsorted(offsets, place, side="right") - 1
                packed = ((place - offsets[row]) << 20) | ((place - first) << 10) | (last + length - place)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(k1[at + row]), pa.array(k2[at + row]), pa.array(packed)], names=["h", "k1", "k2", "packed"])

    return keyed.select("k1", "k2", "text").mapInArrow(run, "h long, k1 long, k2 long, packed long")


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def intervals(lcp: list[int]) -> list[tuple[int, int, int]]:
    """The interval tree of a common-prefix array by one stack scan: (length, first, last) of each
    maximal run of sorted suffixes that share ``length`` bytes and no more, children before parents.
    ``lcp[i]`` is that of suffixes i and i + 1."""
    out: list[tuple[int, int, int]] = []
    stack: list[list[int]] = []
    for i, value in enumerate([*lcp, -1]):
        left = i
        while stack and stack[-1][0] > value:
            size, left = stack.pop()
            out.append((size, left, i))
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append([value, left])
    return out


def maximal(rights: list[bytes], lefts: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes before, bytes after, members) of each maximal repeat of ``length`` bytes or more among
    contexts of one anchor. ``lefts`` are reversed; members index the lists. The contexts differ
    pairwise in their right or left side."""
    order = sorted(range(len(rights)), key=lambda i: rights[i])
    lcp = [_common(rights[a], rights[b]) for a, b in zip(order, order[1:], strict=False)]
    child = [0] * len(order)  # the number of the last finished interval that a suffix is in
    for number, (after, first, last) in enumerate(intervals(lcp), 1):
        by_left = sorted(range(first, last + 1), key=lambda p: lefts[order[p]])
        left_lcp = [_common(lefts[order[a]], lefts[order[b]]) for a, b in zip(by_left, by_left[1:], strict=False)]
        for before, a, b in intervals(left_lcp):
            if before + after >= length:
                own = by_left[a : b + 1]
                seen = {child[p] for p in own}
                # All in one child interval: the repeat goes on to the right and was found there.
                if len(seen) > 1 or 0 in seen:
                    yield before, after, [order[p] for p in own]
        for p in range(first, last + 1):
            child[p] = number


def covers(rights: list[bytes], lefts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Per context, the (before, after) of the repeats that it occurs in. Equal contexts are merged
    first: they repeat one another as far as they go."""
    merged: dict[tuple[bytes, bytes], list[int]] = {}
    for i, pair in enumerate(zip(rights, lefts, strict=True)):
        merged.setdefault(pair, []).append(i)
    out: list[list[tuple[int, int]]] = [[] for _ in rights]
    groups = list(merged.items())
    for (right, left), members in groups:
        if len(members) > 1 and len(right) + len(left) >= length:
            for i in members:
                out[i].append((len(left), len(right)))
    if len(groups) == 2:
        (a, b), (c, d) = groups[0][0], groups[1][0]
        after, before = _common(a, c), _common(b, d)
        if before + after >= length:
            for _, members in groups:
                for i in members:
                    out[i].append((before, after))
    elif len(groups) > 2:
        for before, after, found in maximal([g[0][0] for g in groups], [g[0][1] for g in groups], length):
            for g in found:
                for i in groups[g][1]:
                    out[i].append((before, after))
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Whole groups by ``h`` from sorted batches, as many as a batch completes at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column(0).to_numpy()
        if held and held[-1].column(0)[held[-1].num_rows - 1].as_py() != h[0]:
            yield held
            held = []
        cut_at = int(np.searchsorted(h != h[-1], False, side="left")) if h[0] == h[-1] else int(np.flatnonzero(h != h[-1])[-1]) + 1
        if cut_at:
            yield [*held, batch.slice(0, cut_at)]
            held = []
        held.append(batch.slice(cut_at))
    if held:
        yield held


def _contexts(docs_with: DataFrame, hot: bool, length: int) -> DataFrame:
    """From (k1, k2, doc_id, text, found): one row per anchor with its bytes. For hot anchors instead: a
    row per string with its digest, if it starts once in the document; a string that starts again in
    it is a repeat already, so it gives spans without a digest, runs of them merged, and one row
    without a start, to be counted by other documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).cast(pa.large_binary())
            rows, hs, packs, segs = [], [], [], []
            for r in range(batch.num_rows):
                text, own = texts[r].as_py(), []
                for one in batch.column(4)[r].as_py():
                    if one["hot"] != hot:
                        continue
                    pack = one["packed"]
                    place, before, after = pack >> 20, (pack >> 10) & 1023, pack & 1023
                    if hot:
                        starts = range(place - before, place + after - length + 1)
                        own += [(hashlib.blake2b(text[s : s + length], digest_size=16).digest(), s) for s in starts]
                    else:
                        rows.append(r)
                        hs.append(one["h"])
                        packs.append(pack)
                        segs.append(text[place - before : place + after])
                if own:
                    times = Counter(d for d, _ in own)
                    for digest, start in sorted(own, key=lambda x: x[1]):
                        if times[digest] == 1:
                            rows.append(r)
                            segs.append(digest)
                            hs.append(start)
                            packs.append(start + length)
                        elif rows and rows[-1] == r and segs[-1] is None and packs[-1] is not None and start <= packs[-1]:
                            packs[-1] = start + length
                        else:
                            rows.append(r)
                            segs.append(None)
                            hs.append(start)
                            packs.append(start + length)
                    for digest in (d for d, n in times.items() if n > 1):
                        rows.append(r)
                        segs.append(digest)
                        hs.append(None)
                        packs.append(None)
                if len(segs) >= 20_000 or r == batch.num_rows - 1:
                    take = pa.array(rows, pa.int64())
                    keys = [batch.column(0).take(take), batch.column(1).take(take)]
                    if hot:
                        yield pa.RecordBatch.from_arrays([pa.array(segs, pa.binary()), *keys, pa.array(hs, pa.int64()), pa.array(packs, pa.int64())], names=["digest", "k1", "k2", "start", "end"])
                    else:
                        yield pa.RecordBatch.from_arrays([pa.array(hs, pa.int64()), *keys, pa.array(packs, pa.int64()), pa.array(segs, pa.binary())], names=["h", "k1", "k2", "packed", "seg"])
                    rows, hs, packs, segs = [], [], [], []

    return docs_with.mapInArrow(run, "digest binary, k1 long, k2 long, start long, end long" if hot else "h long, k1 long, k2 long, packed long, seg binary")


def _scan(contexts: DataFrame, length: int) -> DataFrame:
    """(k1, k2, start, end) of the repeats, from contexts sorted by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _groups(batches):
            table = pa.Table.from_batches(held)
            h, packed = table.column("h").to_numpy(), table.column("packed").to_numpy()
            place, before = packed >> 20, (packed >> 10) & 1023
            segs = table.column("seg").to_pylist()
            edges = [0, *(np.flatnonzero(np.diff(h)) + 1).tolist(), len(h)]
            row, start, end = [], [], []
            for s, e in zip(edges, edges[1:], strict=False):
                rights = [segs[i][before[i] :] for i in range(s, e)]
                lefts = [segs[i][: before[i]][::-1] for i in range(s, e)]
                for i, found in enumerate(covers(rights, lefts, length), s):
                    at = 0
                    for low, high in sorted((int(place[i]) - b, int(place[i]) + a) for b, a in found):
                        if at and low <= end[-1]:
                            end[-1] = max(end[-1], high)
                        else:
                            row.append(i)
                            start.append(low)
                            end.append(high)
                            at = 1
            take = pa.array(row, pa.int64())
            keys = [table.column("k1").combine_chunks().take(take), table.column("k2").combine_chunks().take(take)]
            keys = [k.combine_chunks() if isinstance(k, pa.ChunkedArray) else k for k in keys]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["k1", "k2", "start", "end"])

    return contexts.mapInArrow(run, "k1 long, k2 long, start long, end long")


def repeated_spans(docs: DataFrame, length: int = 200, gram: int = GRAM, max_group: int = 50_000) -> tuple[DataFrame, DataFrame]:
    """(keyed documents, (k1, k2, start, end) of all repeats); spans of a document may overlap."""
    if not gram < length <= MAX_LENGTH:
        raise ValueError(f"length must be over {gram} and at most {MAX_LENGTH}")
    keyed = _keys(docs)
    listed = list_anchors(keyed, length, gram)
    seen = cut(listed.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h", (F.col("n") > max_group).alias("hot")))
    again = listed.join(seen, "h").groupBy("k1", "k2").agg(F.collect_set(F.struct("h", "packed", "hot")).alias("found"))
    # All columns of ``keyed``, so that this join and the last one share one exchange of the texts.
    with_found = keyed.join(again, ["k1", "k2"])

    def part(hot: bool) -> DataFrame:
        """Documents with anchors of one kind, and only those anchors."""
        kind = F.filter("found", lambda x: x["hot"] == hot)
        return _contexts(with_found.withColumn("found", kind).where(F.size("found") > 0), hot, length)

    spans = _scan(part(False).repartition("h").sortWithinPartitions("h"), length)
    if seen.where("hot").limit(1).count():
        strings = part(True)
        often = strings.where("digest is not null").groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
        often = regrouped(often.select("digest", F.lit(True).alias("often")), "digest")
        # Spans without a digest get a key of their own, longer than any digest, so they spread.
        own = F.concat_ws(":", F.lit("span of a document"), "k1", "k2", "start").cast("binary")
        rows = strings.where("start is not null").withColumn("sure", F.col("digest").isNull()).withColumn("digest", F.coalesce("digest", own))
        again = rows.join(often, "digest", "left").where("sure or often")
        spans = spans.unionByName(again.select("k1", "k2", "start", "end"))
    return keyed, spans


def dedup(docs: DataFrame, length: int = 200, gram: int = GRAM, max_group: int = 50_000, with_bytes: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, unless
    ``with_bytes`` is off, kept: the bytes that are left once all bytes of repeats are removed."""
    keyed, spans = repeated_spans(docs, length, gram, max_group)
    merged = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = keyed.join(merged, ["k1", "k2"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            n_bytes, removed, n_spans, digests, left = [], [], [], [], []
            for r, found in enumerate(batch.column(2).to_pylist()):
                text = texts[r].as_py()
                at, pieces, count = 0, [], 0
                for s, e in sorted((x["start"], x["end"]) for x in found or ()):
                    if not count or s > at:
                        pieces.append(text[at:s])
                        count += 1
                    at = max(at, e)
                pieces.append(text[at:])
                kept = b"".join(pieces)
                n_bytes.append(len(text))
                removed.append(len(text) - len(kept))
                n_spans.append(count)
                digests.append(hashlib.sha256(kept).hexdigest())
                left.append(kept if with_bytes else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digests, pa.string()), pa.array(left, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    out = joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if with_bytes else out.drop("kept")
