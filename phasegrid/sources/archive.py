"""Scenes in zip archives: member lists, text members and measurement rasters, one task per archive.

Archives come through Spark's ``binaryFile`` source, so any storage that Spark reads will do; a
scene's archive is one value. Rasters are decoded in runs of rows, so one burst is held at a time.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasegrid.sources.tiff import Tiff


def archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def members(zips: DataFrame) -> DataFrame:
    """(path, member, size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                    rows += [(path, i.filename, i.file_size) for i in z.infolist() if not i.is_dir()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["path", "member", "size"])

    return zips.mapInArrow(run, "path string, member string, size long")


def member_texts(zips: DataFrame, part: str, suffix: str) -> DataFrame:
    """(path, member, text) of members whose name has ``part`` and ends in ``suffix``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                    rows += [(path, n, z.read(n).decode("utf-8", "replace")) for n in z.namelist() if part in n and n.endswith(suffix)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], names=["path", "member", "text"])

    return zips.mapInArrow(run, "path string, member string, text string")


def bursts(zips: DataFrame, polarisation: str, lines: int) -> DataFrame:
    """(path, member, burst, height, width, data) with complex64 bytes of each burst of ``lines`` rows
    of the measurement rasters of a polarisation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                    for name in sorted(n for n in z.namelist() if n.lower().endswith((".tif", ".tiff")) and polarisation.lower() in n.lower()):
                        tiff = Tiff.open(io.BytesIO(z.read(name)))
                        height, width = tiff.shape
                        if height % lines:
                            raise ValueError(f"{name} has {height} rows, not a multiple of {lines}")
                        for b in range(height // lines):
                            data = tiff.rows(b * lines, (b + 1) * lines).astype("<c8")
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([path]), pa.array([name]), pa.array([b], pa.int32()), pa.array([lines], pa.int32()), pa.array([width], pa.int32()), pa.array([data.tobytes()], pa.binary())],
                                names=["path", "member", "burst", "height", "width", "data"],
                            )

    return zips.mapInArrow(run, "path string, member string, burst int, height int, width int, data binary")


def burst_pixels(tiles: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, r, c, re, im) of complex64 tiles with ``height`` and ``width``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                width = batch.column("width")[i].as_py()
                z = np.frombuffer(batch.column("data")[i].as_py(), dtype="<c8")
                at = np.arange(len(z), dtype=np.int32)
                own = [pa.array([batch.column(k)[i].as_py()] * len(z), batch.schema.field(k).type) for k in keys]
                yield pa.RecordBatch.from_arrays([*own, pa.array(at // width), pa.array(at % width), pa.array(np.ascontiguousarray(z.real)), pa.array(np.ascontiguousarray(z.imag))], names=[*keys, "r", "c", "re", "im"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tiles.schema.fields if f.name in keys)
    ordered = tiles.select(*[f.name for f in tiles.schema.fields if f.name in keys], "width", F.col("data"))
    keys = [f.name for f in tiles.schema.fields if f.name in keys]
    return ordered.mapInArrow(run, f"{kinds}, r int, c int, re float, im float")
