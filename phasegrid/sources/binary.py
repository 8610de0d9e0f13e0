"""``format("raster")``: binary rasters as rows of pixels.

Options: ``dtype`` (c8, ci2, f4, f8, i2, i4, u1), ``layout`` (plain; altline: one line of each band
in turn; altsample: samples of both bands in turn), ``header`` (true: 64 int32 with the full size
and the half-open box; strips: full size, left, right, number of strips and their row ranges, the
strips' rows following one another), ``nrow`` and ``ncol`` (headerless), ``skip`` (bytes before the data),
``window`` (top,bottom,left,right), ``mode`` (pixels, or header: one row per file), ``rows`` (rows
per partition, 2048). A path is a file, a folder (with ``suffix``) or a glob pattern, on storage
that all executors mount.

A file is read in partitions of whole rows, each seeking to its byte range; ``PushingSource`` takes
comparisons of ``r`` with literals into the row range. Spark refuses it where
``spark.sql.python.filterPushdown.enabled`` is false, so ``sources.register`` chooses between the two.
Partitions yield Arrow batches. Complex data gives re, im; two-band layouts give v, v2.

Writing takes (r, c, value columns) and the same options; each task writes the part file of its
rows, with the row range in its name, and ``join_parts`` puts them together. With ``header`` each part
is a valid cropped raster itself, and a task writes one for each run of rows without a gap, so rows
that weren't given aren't read back as zeros.
"""

from __future__ import annotations

import glob
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

HEADER_INTS = 64
DTYPES = {"c8": np.dtype("<c8"), "ci2": np.dtype("<i2"), "f4": np.dtype("<f4"), "f8": np.dtype("<f8"), "i2": np.dtype("<i2"), "i4": np.dtype("<i4"), "u1": np.dtype("u1")}
KINDS = {"f4": "float", "f8": "double", "i2": "short", "i4": "int", "u1": "short"}


@dataclass(frozen=True)
class Box:
    """Full size and half-open extent of a cropped raster."""

    nrow: int
    ncol: int
    left: int
    top: int
    right: int
    bottom: int

    def header(self) -> bytes:
        values = np.zeros(HEADER_INTS, dtype="<i4")
        values[:6] = [self.nrow, self.ncol, self.left, self.top, self.right, self.bottom]
        return values.tobytes()

    @classmethod
    def read(cls, path: str) -> Box:
        with open(path, "rb") as f:
            values = np.frombuffer(f.read(4 * HEADER_INTS), dtype="<i4")
        if len(values) < HEADER_INTS:
            raise ValueError(f"{path} is too short for a header")
        return cls(*(int(v) for v in values[:6]))


def read_strips(path: str) -> list[tuple[Box, int]]:
    """(box, rows before it in the file) of each strip of a multi-strip raster."""
    with open(path, "rb") as f:
        v = [int(x) for x in np.frombuffer(f.read(4 * HEADER_INTS), dtype="<i4")]
    if len(v) < HEADER_INTS or not 0 <= v[4] <= (HEADER_INTS - 5) // 2:
        raise ValueError(f"{path} has no strip header")
    out, before = [], 0
    for i in range(v[4]):
        top, bottom = v[5 + 2 * i], v[6 + 2 * i]
        out.append((Box(v[0], v[1], v[2], top, v[3], bottom), before))
        before += bottom - top
    return out


def write_strips(path: str, nrow: int, ncol: int, left: int, strips: list[tuple[int, np.ndarray]]) -> None:
    """A multi-strip raster of (top, rows) strips; ``raster.strips`` finds them, and strips that touch
    are one by its definition."""
    if len(strips) > (HEADER_INTS - 5) // 2:
        raise ValueError("too many strips for the header")
    head = np.zeros(HEADER_INTS, dtype="<i4")
    width = strips[0][1].shape[1] if strips else 0
    head[:5] = [nrow, ncol, left, left + width, len(strips)]
    for i, (top, rows) in enumerate(strips):
        head[5 + 2 * i : 7 + 2 * i] = [top, top + len(rows)]
    with open(path, "wb") as f:
        f.write(head.tobytes())
        for _, rows in strips:
            f.write(np.ascontiguousarray(rows).tobytes())


def resolve(path: str, suffix: str = "") -> list[str]:
    """The files that a path names: itself, a folder's files with a suffix, or a pattern's matches."""
    if os.path.isdir(path):
        return sorted(p for p in glob.glob(os.path.join(path, "*")) if p.endswith(suffix) and os.path.isfile(p))
    return [path] if os.path.isfile(path) else sorted(glob.glob(path))


@dataclass(frozen=True)
class Rows(InputPartition):
    path: str
    box: Box
    first: int
    last: int
    before: int  # rows of the file before the box

    def __init__(self, path: str, box: Box, first: int, last: int, before: int = 0) -> None:
        for name, value in (("path", path), ("box", box), ("first", first), ("last", last), ("before", before)):
            object.__setattr__(self, name, value)


class RasterSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "raster"

    def schema(self) -> str:
        o = self.options
        if o.get("mode", "pixels") == "header":
            return "path string, nrow int, ncol int, left int, top int, right int, bottom int"
        dtype = o.get("dtype", "c8")
        if o.get("layout", "plain") != "plain":
            return f"path string, r int, c int, v {KINDS[dtype]}, v2 {KINDS[dtype]}"
        return f"path string, r int, c int, {'re float, im float' if dtype in ('c8', 'ci2') else f'v {KINDS[dtype]}'}"

    def reader(self, schema) -> DataSourceReader:
        return RasterReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return RasterWriter(dict(self.options), [f.name for f in schema.fields])


class PushingSource(RasterSource):
    """For sessions with filter pushdown."""

    def reader(self, schema) -> DataSourceReader:
        return PushingReader(dict(self.options))


class RasterReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.o = {k.lower(): v for k, v in options.items()}
        self.low, self.high = -(1 << 62), 1 << 62

    def _boxes(self, path: str) -> list[tuple[Box, int]]:
        header = self.o.get("header", "false")
        if header == "strips":
            return read_strips(path)
        if header == "true":
            return [(Box.read(path), 0)]
        nrow, ncol = int(self.o["nrow"]), int(self.o["ncol"])
        return [(Box(nrow, ncol, 0, 0, ncol, nrow), 0)]

    def partitions(self) -> Sequence[InputPartition]:
        step, out = int(self.o.get("rows", "2048")), []
        window = [int(x) for x in self.o["window"].split(",")] if "window" in self.o else None
        files = resolve(self.o["path"], self.o.get("suffix", ""))
        if not files:
            raise FileNotFoundError(self.o["path"])
        for path, box, before in ((p, b, n) for p in files for b, n in self._boxes(p)):
            if self.o.get("mode", "pixels") == "header":
                out.append(Rows(path, box, 0, 0))
                continue
            low, high = max(box.top, self.low), min(box.bottom, self.high)
            if window:
                low, high = max(low, window[0]), min(high, window[1])
            out += [Rows(path, box, at, min(at + step, high), before) for at in range(low, high, step)]
        return out or [Rows("", Box(0, 0, 0, 0, 0, 0), 0, 0)]

    def read(self, part: Rows) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        box = part.box
        if self.o.get("mode", "pixels") == "header":
            names = ["nrow", "ncol", "left", "top", "right", "bottom"]
            yield pa.RecordBatch.from_arrays([pa.array([part.path]), *[pa.array([getattr(box, n)], pa.int32()) for n in names]], names=["path", *names])
            return
        dtype, layout = self.o.get("dtype", "c8"), self.o.get("layout", "plain")
        kind, width = DTYPES[dtype], box.right - box.left
        per_pixel = 2 if layout != "plain" or dtype == "ci2" else 1
        skip = int(self.o.get("skip", "0")) + (4 * HEADER_INTS if self.o.get("header", "false") != "false" else 0)
        left, right = box.left, box.right
        if "window" in self.o:
            left, right = max(left, int(self.o["window"].split(",")[2])), min(right, int(self.o["window"].split(",")[3]))
        if left >= right:
            return
        chunk = max(1, 250_000 // max(1, width))
        with open(part.path, "rb") as f:
            for first in range(part.first, part.last, chunk):
                last = min(first + chunk, part.last)
                f.seek(skip + (part.before + first - box.top) * width * per_pixel * kind.itemsize)
                raw = np.frombuffer(f.read((last - first) * width * per_pixel * kind.itemsize), dtype=kind)
                if len(raw) != (last - first) * width * per_pixel:
                    raise ValueError(f"{part.path} ends before row {last}")
                if layout == "altline":
                    values = raw.reshape(last - first, 2, width).transpose(1, 0, 2)
                elif per_pixel == 2:
                    values = raw.reshape(last - first, width, 2).transpose(2, 0, 1)
                elif dtype == "c8":
                    values = np.stack([raw.real, raw.imag]).reshape(2, last - first, width)
                else:
                    values = raw.reshape(1, last - first, width)
                values = values[:, :, left - box.left : right - box.left].reshape(len(values), -1)
                if dtype in ("ci2", "u1"):
                    values = values.astype(np.float32 if dtype == "ci2" else np.int16)
                n = right - left
                r = np.repeat(np.arange(first, last, dtype=np.int32), n)
                c = np.tile(np.arange(left, right, dtype=np.int32), last - first)
                names = ["re", "im"] if layout == "plain" and dtype in ("c8", "ci2") else ["v", "v2"][: len(values)]
                path = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(r), np.int32)), pa.array([part.path])).cast(pa.string())
                yield pa.RecordBatch.from_arrays([path, pa.array(r), pa.array(c), *[pa.array(np.ascontiguousarray(v)) for v in values]], names=["path", "r", "c", *names])


class PushingReader(RasterReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) == ("r",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(f, (EqualTo, GreaterThanOrEqual)):
                    self.low = max(self.low, f.value)
                if isinstance(f, GreaterThan):
                    self.low = max(self.low, f.value + 1)
                if isinstance(f, (EqualTo, LessThanOrEqual)):
                    self.high = min(self.high, f.value + 1)
                if isinstance(f, LessThan):
                    self.high = min(self.high, f.value)
            else:
                yield f


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class RasterWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], columns: list[str]) -> None:
        self.o, self.columns = {k.lower(): v for k, v in options.items()}, columns

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        names = [n for n in self.columns if n not in ("path", "r", "c")]
        batches = [[x.column(n).to_numpy(zero_copy_only=False) for n in ("r", "c", *names)] for x in iterator if x.num_rows]
        if not batches:
            return Written([])
        r, c, *values = (np.concatenate(column) for column in zip(*batches, strict=True))
        del batches
        rows = np.unique(r.astype(np.int64))
        runs = np.split(rows, np.flatnonzero(np.diff(rows) > 1) + 1) if self.o.get("header", "false") == "true" else [rows]
        os.makedirs(self.o["path"], exist_ok=True)
        if len(runs) == 1:
            return Written([self._part(r, c, values)])
        order = np.argsort(r, kind="stable")
        r, c, values = r[order], c[order], [v[order] for v in values]
        ends = np.searchsorted(r, [x[-1] for x in runs], side="right")
        cuts = [slice(at, end) for at, end in zip([0, *ends[:-1]], ends, strict=True)]
        return Written([self._part(r[x], c[x], [v[x] for v in values]) for x in cuts])

    def _part(self, r: np.ndarray, c: np.ndarray, values: list[np.ndarray]) -> str:
        """The part file of the pixels' rows, under its name before ``commit``."""
        from pyspark import TaskContext

        dtype, layout = self.o.get("dtype", "c8"), self.o.get("layout", "plain")
        kind, nrow, ncol = DTYPES[dtype], int(self.o["nrow"]), int(self.o["ncol"])
        r, c = r.astype(np.int64), c.astype(np.int64)
        top, bottom = r.min(), r.max() + 1
        bands = np.zeros((len(values), bottom - top, ncol))
        for i, v in enumerate(values):
            bands[i, r - top, c] = v
        if dtype == "c8" and layout == "plain":
            out = (bands[0] + 1j * bands[1]).astype(kind)
        elif layout == "altline":
            out = bands.transpose(1, 0, 2).astype(kind)
        elif len(values) == 2:
            out = bands.transpose(1, 2, 0).astype(kind)
        else:
            out = bands[0].astype(kind)
        attempt = TaskContext.get().taskAttemptId() if TaskContext.get() else 0
        path = os.path.join(self.o["path"], f".rows_{top:09d}_{bottom:09d}.{attempt}")
        with open(path, "wb") as f:
            if self.o.get("header", "false") == "true":
                f.write(Box(nrow, ncol, 0, int(top), ncol, int(bottom)).header())
            f.write(np.ascontiguousarray(out).tobytes())
        return path

    def commit(self, messages: Sequence[Written | None]) -> None:
        """Only files of successful tasks get their final name."""
        for message in messages:
            for path in message.files if message else ():
                folder, name = os.path.split(path)
                os.replace(path, os.path.join(folder, name[1:].rpartition(".")[0] + ".bin"))

    def abort(self, messages: Sequence[Written | None]) -> None:
        for message in messages:
            for path in message.files if message else ():
                if os.path.exists(path):
                    os.remove(path)


def join_parts(folder: str, target: str, box: Box | None = None) -> None:
    """One file of the headerless parts, in row order, behind an optional header."""
    with open(target, "wb") as out:
        if box is not None:
            out.write(box.header())
        for part in sorted(glob.glob(os.path.join(folder, "rows_*.bin"))):
            with open(part, "rb") as f:
                while block := f.read(1 << 24):
                    out.write(block)


def crop(box: Box, top: int, bottom: int, left: int, right: int) -> Box:
    return replace(box, top=max(top, box.top), bottom=min(bottom, box.bottom), left=max(left, box.left), right=min(right, box.right))
