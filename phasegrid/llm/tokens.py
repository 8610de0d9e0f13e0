"""Vectorised word and shingle hashing over Arrow text columns.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r. Word hashes are 64-bit polynomial
hashes taken from prefix sums over the bytes, so a whole block of texts is hashed by a few NumPy
passes. Blocks hold about ``BLOCK`` bytes, or one longer text, which bounds the memory of a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: ASCII punctuation separates words too: for matching that ignores punctuation.
_SPACE_OR_MARK = _SPACE.copy()
_SPACE_OR_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the hash base (or of its inverse) mod 2**64."""
    name = "inverse" if inverse else "base"
    have = _powers.get(name)
    if have is None or len(have) < n:
        full = np.empty(max(n, BLOCK + 1), dtype=np.uint64)
        full[0] = 1
        full[1:] = _INVERSE if inverse else _BASE
        _powers[name] = have = np.multiply.accumulate(full)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(31)
    return x


def blocks(texts: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive runs of texts without nulls."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words(data: np.ndarray, offsets: np.ndarray, ignore_marks: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, number of the first word of each text, with the total at the end)."""
    n = len(data)
    inside = ~(_SPACE_OR_MARK if ignore_marks else _SPACE)[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(n), out=sums[1:])
    hashes = mix64((sums[ends] - sums[starts]) * powers(n + 1, inverse=True)[starts])
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, number of their first word, first shingle of each text) of all runs of ``k`` words.
    A text of fewer words, but at least one, has one shingle of all its words."""
    n, counts = len(hashes), np.diff(first)
    weights = [np.uint64(w) for w in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]
    ks = [weights[j % 5] + np.uint64(2 * (j // 5)) for j in range(k)]
    made = np.zeros(max(0, n - k + 1), dtype=np.uint64)
    for j in range(k):
        made += hashes[j : j + len(made)] * ks[j]
    short = np.flatnonzero((counts > 0) & (counts < k))
    full = np.maximum(counts - k + 1, 0)
    starts = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(full)[:-1])), full) + np.arange(full.sum())
    out = mix64(made[starts]) if len(starts) else np.zeros(0, dtype=np.uint64)
    if len(short):
        extra = np.empty(len(short), dtype=np.uint64)
        for i, row in enumerate(short):
            own = hashes[first[row] : first[row + 1]]
            extra[i] = (own * np.array(ks[: len(own)], dtype=np.uint64)).sum(dtype=np.uint64) + np.uint64(len(own))
        at = np.concatenate(([0], np.cumsum(full)))[short]
        out, starts = np.insert(out, at, mix64(extra)), np.insert(starts, at, first[short])
        full = full.copy()
        full[short] = 1
    return out, starts, np.concatenate(([0], np.cumsum(full)))
