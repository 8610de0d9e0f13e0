"""Orbit kernels in NumPy and their DataFrame wrappers.

Zero-Doppler times need Newton iterations, so they run over Arrow batches of pixels; the state
vectors of one scene are a few dozen rows and travel with the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasegrid.functions.geo import E2, MAJOR
from phasegrid.operators.joins import pairs_within

LIGHT = 299792458.0
ROUNDS, TOLERANCE = 51, 5e-9
SIDES = ("west", "south", "east", "north")


@dataclass(frozen=True)
class Orbit:
    """State vectors: times (n,), positions and velocities (n, 3)."""

    t: np.ndarray
    x: np.ndarray
    v: np.ndarray

    def at(self, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and velocities by Hermite interpolation through four vectors: the one nearest in
        time, one before it and two after it."""
        times = np.asarray(times, dtype=np.float64)
        after = np.clip(np.searchsorted(self.t, times), 1, len(self.t) - 1)
        nearest = after - (times - self.t[after - 1] <= self.t[after] - times)
        first = np.clip(nearest - 1, 0, len(self.t) - 4)
        pick = first[:, None] + np.arange(4)
        t, x, v = self.t[pick], self.x[pick], self.v[pick]
        d = times[:, None] - t  # (n, 4)
        gap = t[:, :, None] - t[:, None, :]  # (n, i, j)
        off = ~np.eye(4, dtype=bool)
        inverse = np.where(off, 1 / np.where(off, gap, 1), 0)
        slope_sum = inverse.sum(axis=2)  # derivative of the i-th basis at its own node
        ratio = np.where(off, d[:, None, :] * inverse, 1)
        basis = ratio.prod(axis=2)
        slope = np.zeros_like(basis)
        for j in range(4):
            rest = ratio.copy()
            rest[:, :, j] = 1
            slope += inverse[:, :, j] * rest.prod(axis=2)
        square, twice = basis**2, 2 * basis * slope
        a, b = (1 - 2 * d * slope_sum) * square, d * square
        da, db = -2 * slope_sum * square + (1 - 2 * d * slope_sum) * twice, square + d * twice
        mixed = lambda p, q: (p[:, :, None] * x + q[:, :, None] * v).sum(axis=1)
        return mixed(a, b), mixed(da, db)

    def zero_doppler(self, targets: np.ndarray, guess: float | np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(times, look vectors) at which the targets (n, 3) lie across the track."""
        time = np.broadcast_to(np.asarray(self.t.mean() if guess is None else guess, dtype=np.float64), (len(targets),)).copy()
        active = np.arange(len(targets))
        for _ in range(ROUNDS):
            if not len(active):
                break
            x, v = self.at(time[active])
            move = ((targets[active] - x) * v).sum(axis=1) / (v * v).sum(axis=1)
            time[active] += move
            active = active[np.abs(move) >= TOLERANCE]
        return time, targets - self.at(time)[0]

    @classmethod
    def from_rows(cls, rows: Sequence[Sequence[float]]) -> Orbit:
        """Rows of (t, x, y, z, vx, vy, vz)."""
        m = np.asarray(sorted(tuple(r)[:7] for r in rows), dtype=np.float64).reshape(-1, 7)
        if len(m) < 4:
            raise ValueError("an orbit needs four state vectors")
        return cls(m[:, 0].copy(), m[:, 1:4].copy(), m[:, 4:7].copy())


def llh_to_xyz(lat: np.ndarray, lon: np.ndarray, height: np.ndarray) -> np.ndarray:
    la, lo = np.radians(lat), np.radians(lon)
    east = MAJOR / np.sqrt(1 - E2 * np.sin(la) ** 2)
    return np.stack([(east + height) * np.cos(la) * np.cos(lo), (east + height) * np.cos(la) * np.sin(lo), (east * (1 - E2) + height) * np.sin(la)], axis=-1)


def xyz_to_llh(xyz: np.ndarray) -> np.ndarray:
    flat = np.hypot(xyz[..., 0], xyz[..., 1])
    minor, second = MAJOR * math.sqrt(1 - E2), E2 / (1 - E2)
    reduced = np.arctan2(xyz[..., 2] * MAJOR, flat * minor)
    la = np.arctan2(xyz[..., 2] + second * minor * np.sin(reduced) ** 3, flat - E2 * MAJOR * np.cos(reduced) ** 3)
    east = MAJOR / np.sqrt(1 - E2 * np.sin(la) ** 2)
    return np.stack([np.degrees(la), np.degrees(np.arctan2(xyz[..., 1], xyz[..., 0])), flat / np.cos(la) - east], axis=-1)


def enu(lat: np.ndarray, lon: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    la, lo = np.radians(lat), np.radians(lon)
    x, y, z = vectors[..., 0], vectors[..., 1], vectors[..., 2]
    east = -np.sin(lo) * x + np.cos(lo) * y
    north = -np.sin(la) * np.cos(lo) * x - np.sin(la) * np.sin(lo) * y + np.cos(la) * z
    return np.stack([east, north, np.cos(la) * np.cos(lo) * x + np.cos(la) * np.sin(lo) * y + np.sin(la) * z], axis=-1)


def range_to_llh(orbit: Orbit, time: float, slant: float, height: float, right_looking: bool = True) -> np.ndarray:
    """(lat, lon, height) of the point at a zero-Doppler time, slant range and height: a circle in the
    zero-Doppler plane is met with a sphere whose radius is refined to the ellipsoid."""
    x, v = (m[0] for m in orbit.at(np.array([time])))
    down = -x / np.linalg.norm(x)
    along = v / np.linalg.norm(v)
    side = np.cross(along, down)
    side *= (-1 if right_looking else 1) / np.linalg.norm(side)
    radius = float(np.linalg.norm(x)) - xyz_to_llh(x)[2]
    point = x
    for _ in range(20):
        far = float(np.linalg.norm(x))
        cos = (far**2 + slant**2 - (radius + height) ** 2) / (2 * far * slant)
        cos = min(1.0, max(-1.0, cos))
        level = down - along * (down @ along)
        level /= np.linalg.norm(level)
        # ``level`` leaves the exact nadir by the small flight-path angle; keep the range exact.
        point = x + slant * (cos * level + math.sqrt(1 - cos * cos) * side)
        error = xyz_to_llh(point)[2] - height
        radius -= error
        if abs(error) < 1e-6:
            break
    return xyz_to_llh(point)


def burst_bounds(orbit: Orbit, times: tuple[float, float], ranges: tuple[float, float], heights: tuple[float, float], right_looking: bool = True) -> dict[str, float]:
    """The latitude and longitude box of the eight corners."""
    corners = np.array([range_to_llh(orbit, t, r, h, right_looking) for t in times for r in ranges for h in heights])
    return {"south": corners[:, 0].min(), "north": corners[:, 0].max(), "west": corners[:, 1].min(), "east": corners[:, 1].max()}


def perpendicular_baseline(orbit1: Orbit, orbit2: Orbit, target: np.ndarray) -> float:
    """The distance of the second orbit from the first line of sight, signed by the look side."""
    (t1,), (look,) = orbit1.zero_doppler(target[None])
    (t2,), _ = orbit2.zero_doppler(target[None])
    x1, v1 = (m[0] for m in orbit1.at(np.array([t1])))
    x2 = orbit2.at(np.array([t2]))[0][0]
    along = v1 / np.linalg.norm(v1)
    step = x2 - x1
    step = step - (step @ along) * along
    sight = look / np.linalg.norm(look)
    across = step - (step @ sight) * sight
    return float(np.sign(np.cross(sight, along) @ across) * np.linalg.norm(across))


def _batched(points: DataFrame, orbit: Orbit, make, added: str) -> DataFrame:
    """Add columns that ``make(lat, lon, height)`` gives as arrays to (lat, lon, height, ...)."""
    names = points.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lat, lon, height = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.float64) for n in ("lat", "lon", "height"))
            made = make(lat, lon, height)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(m) for m in made]], names=[*names, *[a.split()[0] for a in added.split(", ")]])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema.fields)
    return points.mapInArrow(run, f"{kinds}, {added}")


def zero_doppler(points: DataFrame, orbit: Orbit) -> DataFrame:
    """Adds time (seconds) and slant (metres)."""

    def make(lat: np.ndarray, lon: np.ndarray, height: np.ndarray) -> list[np.ndarray]:
        time, look = orbit.zero_doppler(llh_to_xyz(lat, lon, height))
        return [time, np.linalg.norm(look, axis=1)]

    return _batched(points, orbit, make, "time double, slant double")


def line_of_sight(points: DataFrame, orbit: Orbit) -> DataFrame:
    """Adds the unit vector from ground to satellite (east, north, up) and the look angle (degrees)."""

    def make(lat: np.ndarray, lon: np.ndarray, height: np.ndarray) -> list[np.ndarray]:
        _, look = orbit.zero_doppler(llh_to_xyz(lat, lon, height))
        local = enu(lat, lon, -look / np.linalg.norm(look, axis=1, keepdims=True))
        satellite = llh_to_xyz(lat, lon, height) - look
        down = -satellite / np.linalg.norm(satellite, axis=1, keepdims=True)
        cos = (down * look).sum(axis=1) / np.linalg.norm(look, axis=1)
        return [local[:, 0], local[:, 1], local[:, 2], np.degrees(np.arccos(np.clip(cos, -1, 1)))]

    return _batched(points, orbit, make, "los_e double, los_n double, los_u double, look double")


@dataclass(frozen=True)
class Burst:
    """What a burst's geocoding needs; ``data`` is complex (lines, samples)."""

    data: np.ndarray
    start: float
    line_time: float
    near: float
    range_step: float
    wavelength: float
    ka: tuple[float, float, float, float]  # t0, c0, c1, c2 of the FM rate over slant time
    dc: tuple[float, float, float, float]  # the same of the Doppler centroid
    steering: float  # degrees a second
    valid: tuple[int, int, int, int]  # first and last valid line and sample


def geocoder(orbit: Orbit, burst: Burst, guard: int = 5):
    """A function of arrays (lat, lon, height) that gives re, im: deramp, zero-Doppler, bilinear,
    reramp, and the range phase removed; 0 outside of the valid window and in its first and last
    ``guard`` lines."""
    def poly(c: tuple[float, float, float, float], slant: np.ndarray) -> np.ndarray:
        x = 2 * slant / LIGHT - c[0]
        return c[1] + c[2] * x + c[3] * x * x

    middle = burst.start + burst.line_time * (burst.data.shape[0] - 1) / 2

    def ramp(line: np.ndarray, slant: np.ndarray) -> np.ndarray:
        speed = float(np.linalg.norm(orbit.at(np.array([middle]))[1][0]))
        ka, fdc = poly(burst.ka, slant), poly(burst.dc, slant)
        ks = 2 * speed / burst.wavelength * math.radians(burst.steering)
        kt = ka * ks / (ka - ks)
        near = burst.near + burst.range_step * burst.data.shape[1] / 2
        centre = -fdc / ka
        reference = centre - (-poly(burst.dc, np.array([near])) / poly(burst.ka, np.array([near])))
        eta = burst.start + line * burst.line_time - middle
        return -math.pi * kt * (eta - reference) ** 2

    lines, samples = np.mgrid[0 : burst.data.shape[0], 0 : burst.data.shape[1]]
    flat = burst.data * np.exp(1j * ramp(lines.astype(float), burst.near + samples * burst.range_step))

    def make(lat: np.ndarray, lon: np.ndarray, height: np.ndarray) -> list[np.ndarray]:
        time, look = orbit.zero_doppler(llh_to_xyz(lat, lon, height), middle)
        slant = np.linalg.norm(look, axis=1)
        line, sample = (time - burst.start) / burst.line_time, (slant - burst.near) / burst.range_step
        top, bottom, left, right = burst.valid
        inside = (line >= top + guard) & (line < bottom - guard) & (sample > left) & (sample < right - 1)
        i, j = (np.clip(np.floor(x).astype(int), 0, max(0, n - 2)) for x, n in ((line, flat.shape[0]), (sample, flat.shape[1])))
        below, beside = np.minimum(i + 1, flat.shape[0] - 1), np.minimum(j + 1, flat.shape[1] - 1)
        a, b = line - i, sample - j
        value = (1 - a) * (1 - b) * flat[i, j] + (1 - a) * b * flat[i, beside] + a * (1 - b) * flat[below, j] + a * b * flat[below, beside]
        value = value * np.exp(-1j * ramp(line, slant)) * np.exp(1j * 4 * math.pi / burst.wavelength * slant)
        value = np.where(inside, value, 0)
        return [value.real, value.imag]

    return make


def geocode(points: DataFrame, orbit: Orbit, burst: Burst, guard: int = 5) -> DataFrame:
    """Adds re, im of one burst at (lat, lon, height); see ``geocoder``."""
    return _batched(points, orbit, geocoder(orbit, burst, guard), "re double, im double")


#: What a table of bursts has for each burst; ``vectors`` are rows of (t, x, y, z, vx, vy, vz).
BURST = (
    "samples int, start double, line_time double, near double, range_step double, wavelength double, ka array<double>, dc array<double>, "
    "steering double, valid array<int>, vectors array<array<double>>, re array<double>, im array<double>"
)


def geocode_bursts(points: DataFrame, bursts: DataFrame, keys: Sequence[str], guard: int = 5) -> DataFrame:
    """Adds re, im to ``points(keys, lat, lon, height, ...)`` from ``bursts(keys, ...)``, a row per burst
    with the columns of ``BURST``. Points and burst of a key meet in one task, which holds that burst
    alone; points whose key has no burst are dropped."""
    names = points.columns

    def run(at: pa.Table, of: pa.Table) -> pa.Table:
        kind = pa.schema([*at.schema, ("re", pa.float64()), ("im", pa.float64())])
        if not at.num_rows or not of.num_rows:
            return kind.empty_table()
        x = of.slice(0, 1).to_pylist()[0]
        data = (np.asarray(x["re"]) + 1j * np.asarray(x["im"])).reshape(-1, x["samples"])
        burst = Burst(data, x["start"], x["line_time"], x["near"], x["range_step"], x["wavelength"], tuple(x["ka"]), tuple(x["dc"]), x["steering"], tuple(x["valid"]))
        made = geocoder(Orbit.from_rows(x["vectors"]), burst, guard)
        re, im = made(*(at.column(n).to_numpy().astype(np.float64) for n in ("lat", "lon", "height")))
        return pa.Table.from_arrays([*[at.column(n) for n in names], pa.array(re), pa.array(im)], schema=kind)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema.fields)
    grouped = points.groupBy(*keys).cogroup(bursts.groupBy(*keys))
    return grouped.applyInArrow(run, f"{kinds}, re double, im double")


def burst_areas(bursts: DataFrame, keys: Sequence[str], heights: tuple[float, float]) -> DataFrame:
    """(keys, west, south, east, north) that each burst may cover between two heights."""
    lines = F.expr("size(re) div samples")
    few = bursts.select(*keys, "start", "line_time", "near", "range_step", "samples", lines.cast("int").alias("lines"), "vectors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x in batch.to_pylist():
                times = (x["start"], x["start"] + x["line_time"] * (x["lines"] - 1))
                ranges = (x["near"], x["near"] + x["range_step"] * (x["samples"] - 1))
                found.append(burst_bounds(Orbit.from_rows(x["vectors"]), times, ranges, heights))
            own = [batch.column(k) for k in keys]
            yield pa.RecordBatch.from_arrays([*own, *[pa.array([f[n] for f in found], pa.float64()) for n in SIDES]], names=[*keys, *SIDES])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in few.schema.fields if f.name in keys)
    return few.mapInArrow(run, f"{kinds}, " + ", ".join(f"{n} double" for n in SIDES))


def pair_table(scenes: DataFrame, baselines: DataFrame, days: tuple[int, int], metres: tuple[float, float]) -> DataFrame:
    """(date1, date2, days, bperp) within both bands. Baselines are per date against one master, so
    a pair's is a difference and each orbit is read once."""
    pairs = pairs_within(scenes, "date", *days)
    one = baselines.select(F.col("date").alias("date1"), F.col("bperp").alias("b1"))
    two = baselines.select(F.col("date").alias("date2"), F.col("bperp").alias("b2"))
    gap: Column = F.col("b2") - F.col("b1")
    out = pairs.join(one, "date1").join(two, "date2").select("date1", "date2", "days", gap.alias("bperp"))
    return out.where(F.abs("bperp").between(*metres))
