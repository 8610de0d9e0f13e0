"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Statistics of the whole text (lengths, shares of character kinds, repetition of words, word runs and
lines) are transformed to be roughly normal and standardised. Each class has a mean and a covariance
that is shrunk towards the pooled covariance and towards a multiple of the identity. The score is
the difference of the two Mahalanobis log densities, taken with Cholesky factors that are computed
once, and mapped to 0..1 by a logistic calibration on the training rows.

The model is fitted on at most ``max_rows`` labelled rows, chosen by the hash of their id; of several
labels of an id the largest counts, of several texts the one with the least statistics. The model is
a few hundred numbers and travels with the task. Labels, language, source and id are never inputs of a
score. Null texts count as empty; empty texts get a score like any other, from statistics that are
all defined at length 0; a text of any length is read whole, and equal texts get equal scores. If a class has no training row, every score is the share of the other. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasegrid.llm import tokens
from phasegrid.llm.shared import fresh, in_arrow, schema_of, text_or_empty

STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_length_sd", "upper", "digit", "symbol", "marks", "line_length",
    "repeated_words", "repeated_runs", "repeated_lines", "entropy", "sentence",
)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*+<=>@\\^_`{|}~"]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!?"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,"]] = True


def _share(part: np.ndarray, whole: np.ndarray, prior: float = 1.0) -> np.ndarray:
    """A log-odds transform of a share, defined at 0 of 0."""
    return np.log((part + 0.5 * prior) / (np.maximum(whole - part, 0) + prior))


def _repeats(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many values of each text are equal to an earlier one of it."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    same = (v[1:] == v[:-1]) & (o[1:] == o[:-1])
    return np.bincount(o[1:][same], minlength=len(first) - 1).astype(np.float64)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, len(STATISTICS)) of a block of texts."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(np.float64)

    hashes, starts, ends, first = tokens.words(data, offsets)
    count = np.diff(first).astype(np.float64)
    lengths = (ends - starts).astype(np.float64)
    owner = np.repeat(np.arange(n), np.diff(first))
    sum1 = np.bincount(owner, lengths, minlength=n)
    sum2 = np.bincount(owner, lengths * lengths, minlength=n)
    some = np.maximum(count, 1)
    mean = sum1 / some
    runs, _, first_run = tokens.shingles(hashes, first, 3)
    breaks = data == 10
    lines = total(breaks) + 1
    # A line is hashed as the sum of its words' hashes by place in the line.
    line_of = np.concatenate(([0], np.cumsum(breaks)))[starts] + owner
    if len(starts):
        new = np.concatenate(([True], line_of[1:] != line_of[:-1]))
        at = np.flatnonzero(new)
        place = np.arange(len(starts)) - np.repeat(at, np.diff(np.concatenate((at, [len(starts)]))))
        line_hash = np.add.reduceat(tokens.mix64(hashes + place.astype(np.uint64)), at)
        first_line = np.concatenate(([0], np.cumsum(np.bincount(owner[at], minlength=n))))
        line_repeats = _repeats(line_hash, first_line)
    else:
        line_repeats = np.zeros(n)
    kinds = np.bincount(
        np.repeat(np.arange(n), np.diff(offsets)) * 256 + data.astype(np.int64), minlength=n * 256
    ).reshape(n, 256).astype(np.float64)
    p = kinds / np.maximum(size, 1)[:, None]
    entropy = -(p * np.log(np.where(p > 0, p, 1))).sum(axis=1)
    return np.stack(
        [
            np.log1p(size), np.log1p(count), np.log1p(mean), np.log1p(np.sqrt(np.maximum(sum2 / some - mean * mean, 0))),
            _share(total(_UPPER[data]), size), _share(total(_DIGIT[data]), size), _share(total(_SYMBOL[data]), size),
            _share(total(_MARK[data]), size), np.log1p(count / lines), _share(_repeats(hashes, first), count),
            _share(_repeats(runs, first_run), np.diff(first_run)), _share(line_repeats, lines), entropy, _share(total(_STOP[data]), count),
        ],
        axis=1,
    )


def whiten(factor: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Solve factor · w = d by forward substitution over the few dimensions, each step vectorised over
    all rows. No threaded linear algebra: its pools stall with many small problems on shared cores."""
    w = np.empty_like(d)
    for i in range(len(factor)):
        w[i] = (d[i] - (factor[i, :i, None] * w[:i]).sum(axis=0)) / factor[i, i]
    return w


@dataclass(frozen=True)
class Model:
    center: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    log_dets: tuple[float, float]
    slope: float
    offset: float

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0."""
        z = np.clip((x - self.center) / self.scale, -8, 8)
        out = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets, strict=True):
            out.append(-0.5 * ((whiten(factor, (z - mean).T) ** 2).sum(axis=0) + log_det))
        return out[1] - out[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.means):
            return np.full(len(x), 1 / (1 + np.exp(-self.offset)))
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.offset, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, towards_pooled: float = 0.3, towards_identity: float = 0.05) -> Model:
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    if min(n0, n1) < 2:
        share = (n1 + 0.5) / (n0 + n1 + 1)
        return Model(np.zeros(1), np.ones(1), (), (), (), 0.0, float(np.log(share / (1 - share))))
    center, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.clip((x - center) / scale, -8, 8)
    parts = [z[y == c] for c in (0, 1)]
    means = tuple(p.mean(axis=0) for p in parts)
    own = [np.einsum("ni,nj->ij", p - m, p - m) / len(p) for p, m in zip(parts, means, strict=True)]
    pooled = (n0 * own[0] + n1 * own[1]) / (n0 + n1)
    factors, log_dets = [], []
    for c in own:
        c = (1 - towards_pooled) * c + towards_pooled * pooled
        c = (1 - towards_identity) * c + towards_identity * np.trace(c) / len(c) * np.eye(len(c))
        factor = np.linalg.cholesky(c)
        factors.append(factor)
        log_dets.append(float(2 * np.log(np.diag(factor)).sum()))
    model = Model(center, scale, means, tuple(factors), tuple(log_dets), 1.0, 0.0)
    d = np.clip(model.difference(x), -60, 60)
    slope, offset = 0.1, 0.0
    for _ in range(50):  # Newton steps of a logistic regression on one input, lightly ridged
        p = 1 / (1 + np.exp(-np.clip(slope * d + offset, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((y - p) * d).sum() - 1e-3 * slope, (y - p).sum() - 1e-3 * offset])
        h = np.array([[(w * d * d).sum() + 1e-3, (w * d).sum()], [(w * d).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 1.0 / max(1e-12, float(np.abs(step).max())))
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return Model(center, scale, means, tuple(factors), tuple(log_dets), max(0.0, float(slope)), float(offset))


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _with_statistics(df: DataFrame) -> DataFrame:
    """(doc_id, label, x) from (doc_id, label, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in tokens.blocks(batch.column(2)):
                x = statistics(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), batch.column(1).slice(at, end - at), lists], names=["doc_id", "label", "x"])

    return in_arrow(df, run, "doc_id long, label int, x array<double>")


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Model:
    """Fit on ``labels(doc_id, quality)``, at most ``max_rows`` of those that aren't held out."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    usable = usable.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    # Of repeated ids one row is learnt from, the same in each run: at most ``max_rows`` reach the driver.
    once = _with_statistics(rows.select("doc_id", "label", "text")).groupBy("doc_id").agg(F.min(F.struct("label", "x")).alias("r"))
    got = once.select("doc_id", "r.label", "r.x").toArrow()
    order = np.argsort(got.column("doc_id").to_numpy(), kind="stable")
    x = np.array(got.column("x").to_pylist(), dtype=np.float64).reshape(-1, len(STATISTICS))
    return fit(x[order], got.column("label").to_numpy()[order])


def score(docs: DataFrame, model: Model) -> tuple[DataFrame, str]:
    """All columns of ``docs`` and a score column, whose name is also returned."""
    out = fresh("score", docs.columns)
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            for start, end, data, offsets in tokens.blocks(texts.fill_null("") if texts.null_count else texts):
                scores = pa.array(model.score(statistics(data, offsets)))
                yield pa.RecordBatch.from_arrays([*batch.slice(start, end - start).columns, scores], names=[*names, out])

    return in_arrow(docs, run, schema_of(docs, f"`{out}` double")), out


def quality_filter(docs: DataFrame, labels: DataFrame, least: float = 0.7) -> DataFrame:
    """The documents whose score is ``least`` or more, with their columns."""
    scored, name = score(docs, train(docs, labels))
    return scored.where(F.col(name) >= least).select(*[F.col(f"`{c}`") for c in docs.columns])
