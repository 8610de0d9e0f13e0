"""Baseline TIFF without a native library: uncompressed or deflated strips, one band.

Enough for product bursts (complex int16 or float), elevation models and result rasters. Reading is
by rows, so a burst of a product is decoded without the others.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np

#: Fixed values of the format: bytes and struct codes of the field types, and the tags used.
FIELD_TYPES = {1: (1, "B"), 2: (1, "c"), 3: (2, "H"), 4: (4, "I"), 5: (8, "II"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q")}
WIDTH, LENGTH, BITS, COMPRESSION, OFFSETS, SAMPLES, ROWS_PER_STRIP, COUNTS, FORMAT = 256, 257, 258, 259, 273, 277, 278, 279, 339
PIXEL_SCALE, TIEPOINT, GEO_KEYS, NODATA = 33550, 33922, 34735, 42113
#: (bits, sample format) to NumPy; format 5 is complex int, 6 complex float.
SAMPLE_KINDS = {(8, 1): "u1", (16, 1): "u2", (16, 2): "i2", (32, 1): "u4", (32, 2): "i4", (32, 3): "f4", (64, 3): "f8", (32, 5): "ci2", (64, 6): "c8"}


@dataclass
class Tiff:
    file: BinaryIO
    order: str
    tags: dict[int, tuple]

    @classmethod
    def open(cls, file: BinaryIO) -> Tiff:
        head = file.read(16)
        order = {b"II": "<", b"MM": ">"}.get(head[:2])
        if order is None:
            raise ValueError("not a TIFF")
        big = struct.unpack(order + "H", head[2:4])[0] == 43
        at = struct.unpack(order + ("Q" if big else "I"), head[8:16] if big else head[4:8])[0]
        file.seek(at)
        count = struct.unpack(order + ("Q" if big else "H"), file.read(8 if big else 2))[0]
        size, inline = (20, 8) if big else (12, 4)
        entries, tags = file.read(count * size), {}
        for i in range(count):
            raw = entries[i * size : (i + 1) * size]
            tag, kind = struct.unpack(order + "HH", raw[:4])
            number = struct.unpack(order + ("Q" if big else "I"), raw[4 : 12 if big else 8])[0]
            if kind not in FIELD_TYPES:
                continue
            width, code = FIELD_TYPES[kind]
            data = raw[-inline:]
            if number * width > inline:
                file.seek(struct.unpack(order + ("Q" if big else "I"), data)[0])
                data = file.read(number * width)
            tags[tag] = struct.unpack(f"{order}{code * number if len(code) == 2 else str(number) + code}", data[: number * width])
        return cls(file, order, tags)

    @property
    def shape(self) -> tuple[int, int]:
        return self.tags[LENGTH][0], self.tags[WIDTH][0]

    def rows(self, first: int, last: int) -> np.ndarray:
        """Rows first..last − 1; complex kinds as complex64."""
        height, width = self.shape
        kind = SAMPLE_KINDS[(self.tags.get(BITS, (8,))[0], self.tags.get(FORMAT, (1,))[0])]
        compression = self.tags.get(COMPRESSION, (1,))[0]
        if compression not in (1, 8, 32946) or self.tags.get(SAMPLES, (1,))[0] != 1:
            raise ValueError("only one band, plain or deflated, is read")
        base = np.dtype(self.order + ("i2" if kind == "ci2" else kind))
        per_strip, parts = min(self.tags.get(ROWS_PER_STRIP, (height,))[0], height), []
        for strip in range(first // per_strip, -(-last // per_strip)):
            self.file.seek(self.tags[OFFSETS][strip])
            data = self.file.read(self.tags[COUNTS][strip])
            values = np.frombuffer(zlib.decompress(data) if compression != 1 else data, dtype=base)
            if kind == "ci2":
                values = (values[0::2] + 1j * values[1::2]).astype(np.complex64)
            top = strip * per_strip
            parts.append(values.reshape(-1, width)[max(0, first - top) : last - top])
        return np.concatenate(parts) if parts else np.zeros((0, width), base)


def write(file: BinaryIO, data: np.ndarray, geotransform: tuple[float, ...] | None = None, nodata: str = "", rows_per_strip: int = 64, deflate: bool = True) -> None:
    """One band; ``geotransform`` adds WGS-84 geographic placement."""
    kinds = {"float32": (32, 3), "float64": (64, 3), "int16": (16, 2), "int32": (32, 2), "uint8": (8, 1), "complex64": (64, 6)}
    bits, sample = kinds[str(data.dtype)]
    height, width = data.shape
    strips = [np.ascontiguousarray(data[r : r + rows_per_strip]).astype(data.dtype.newbyteorder("<")).tobytes() for r in range(0, height, rows_per_strip)]
    strips = [zlib.compress(s) for s in strips] if deflate else strips
    fields: dict[int, tuple[int, tuple]] = {
        WIDTH: (4, (width,)), LENGTH: (4, (height,)), BITS: (3, (bits,)), COMPRESSION: (3, (8 if deflate else 1,)), 262: (3, (1,)), SAMPLES: (3, (1,)),
        ROWS_PER_STRIP: (4, (rows_per_strip,)), FORMAT: (3, (sample,)), COUNTS: (4, tuple(map(len, strips))),
    }
    at, offsets = 8, []
    for s in strips:
        offsets.append(at)
        at += len(s)
    fields[OFFSETS] = (4, tuple(offsets))
    if geotransform:
        fields[PIXEL_SCALE] = (12, (geotransform[1], -geotransform[5], 0.0))
        fields[TIEPOINT] = (12, (0.0, 0.0, 0.0, geotransform[0], geotransform[3], 0.0))
        fields[GEO_KEYS] = (3, (1, 1, 0, 3, 1024, 0, 1, 2, 1025, 0, 1, 1, 2048, 0, 1, 4326))
    if nodata:
        fields[NODATA] = (2, tuple(bytes([c]) for c in nodata.encode() + b"\0"))
    directory, extra = b"", b""
    extra_at = at + 2 + 12 * len(fields) + 4
    for tag in sorted(fields):
        kind, values = fields[tag]
        packed = struct.pack("<" + FIELD_TYPES[kind][1] * len(values), *values)
        if len(packed) <= 4:
            cell = packed.ljust(4, b"\0")
        else:
            cell = struct.pack("<I", extra_at + len(extra))
            extra += packed
        directory += struct.pack("<HHI", tag, kind, len(values)) + cell
    file.write(b"II*\0" + struct.pack("<I", at) + b"".join(strips) + struct.pack("<H", len(fields)) + directory + b"\0\0\0\0" + extra)


def shifted(geotransform: tuple[float, ...], half_pixel: bool) -> tuple[float, float]:
    """First longitude and latitude of the cells: corners, or centres when shifted by half a cell."""
    step = 0.5 if half_pixel else 0.0
    return geotransform[0] + step * geotransform[1], geotransform[3] + step * geotransform[5]
