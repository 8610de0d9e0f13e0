"""Geodesy on the WGS-84 ellipsoid as Column expressions, with NumPy twins for the iterative kernels
in ``operators.orbit``. Angles are degrees, lengths metres."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the ellipsoid.
MAJOR = 6378137.0
E2 = 0.0066943799901
MINOR = MAJOR * math.sqrt(1 - E2)
Vector = tuple[Column, Column, Column]


def llh_to_xyz(lat: Column, lon: Column, height: Column) -> Vector:
    la, lo = F.radians(lat), F.radians(lon)
    east = MAJOR / F.sqrt(1 - E2 * F.sin(la) * F.sin(la))
    flat = (east + height) * F.cos(la)
    return flat * F.cos(lo), flat * F.sin(lo), (east * (1 - E2) + height) * F.sin(la)


def xyz_to_llh(x: Column, y: Column, z: Column) -> Vector:
    """Bowring's formula, one step."""
    flat = F.sqrt(x * x + y * y)
    second = E2 / (1 - E2)
    reduced = F.atan2(z * MAJOR, flat * MINOR)
    sin3, cos3 = F.pow(F.sin(reduced), F.lit(3.0)), F.pow(F.cos(reduced), F.lit(3.0))
    la = F.atan2(z + second * MINOR * sin3, flat - E2 * MAJOR * cos3)
    east = MAJOR / F.sqrt(1 - E2 * F.sin(la) * F.sin(la))
    return F.degrees(la), F.degrees(F.atan2(y, x)), flat / F.cos(la) - east


def radius_east(lat: Column) -> Column:
    s = F.sin(F.radians(lat))
    return MAJOR / F.sqrt(1 - E2 * s * s)


def radius_north(lat: Column) -> Column:
    s = F.sin(F.radians(lat))
    return MAJOR * (1 - E2) / F.pow(1 - E2 * s * s, F.lit(1.5))


def radius_along(lat: Column, heading: Column) -> Column:
    """Radius of curvature in the direction of ``heading``."""
    h, east, north = F.radians(heading), radius_east(lat), radius_north(lat)
    return east * north / (east * F.cos(h) * F.cos(h) + north * F.sin(h) * F.sin(h))


def heading(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing on the sphere, in (−180, 180]."""
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    return F.degrees(F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)))


def heading_ellipsoid(lat1: Column, lon1: Column, lat2: Column, lon2: Column, rounds: int = 12) -> Column:
    """Azimuth at the first point of the geodesic to the second, in degrees in (−180, 180]; null for
    equal points. The longitude difference on the auxiliary sphere is found by Vincenty's fixed-point
    rounds, which don't converge for points that are nearly antipodal."""
    flat = 1 - math.sqrt(1 - E2)
    reduced = lambda lat: F.atan((1 - flat) * F.tan(F.radians(lat)))
    u1, u2 = reduced(lat1), reduced(lat2)
    s1, c1, s2, c2 = F.sin(u1), F.cos(u1), F.sin(u2), F.cos(u2)
    turn = F.radians(lon2 - lon1)
    apart = F.atan2(F.sin(turn), F.cos(turn))
    start = F.struct(apart.alias("lon"), apart.alias("apart"), s1.alias("s1"), c1.alias("c1"), s2.alias("s2"), c2.alias("c2"))

    def sides(x: Column) -> tuple[Column, Column]:
        return x["c2"] * F.sin(x["lon"]), x["c1"] * x["s2"] - x["s1"] * x["c2"] * F.cos(x["lon"])

    def better(x: Column, _: Column) -> Column:
        east, north = sides(x)
        sin = F.sqrt(east * east + north * north)
        cos = x["s1"] * x["s2"] + x["c1"] * x["c2"] * F.cos(x["lon"])
        tilt = F.when(sin > 0, x["c1"] * east / sin).otherwise(0.0)
        rest = 1 - tilt * tilt
        middle = F.when(rest > 1e-12, cos - 2 * x["s1"] * x["s2"] / rest).otherwise(0.0)
        share = flat / 16 * rest * (4 + flat * (4 - 3 * rest))
        arc = F.atan2(sin, cos) + share * sin * (middle + share * cos * (2 * middle * middle - 1))
        return x.withField("lon", x["apart"] + (1 - share) * flat * tilt * arc)

    solved = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, better, lambda x: F.struct(*sides(x)))
    at = solved.getField("col1"), solved.getField("col2")
    return F.when((at[0] != 0) | (at[1] != 0), F.degrees(F.atan2(*at)))


def cross(a: Vector, b: Vector) -> Vector:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def norm(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def scaled(a: Vector, by: Column) -> Vector:
    return a[0] * by, a[1] * by, a[2] * by


def tcn(position: Vector, velocity: Vector) -> tuple[Vector, Vector, Vector]:
    """Tangential, cross-track and nadir unit vectors, each row by its own norms."""
    down = scaled(position, -1 / norm(position))
    side = cross(down, velocity)
    side = scaled(side, 1 / norm(side))
    along = cross(side, down)
    return scaled(along, 1 / norm(along)), side, down


def enu_to_xyz(lat: Column, lon: Column, enu: Vector) -> Vector:
    la, lo = F.radians(lat), F.radians(lon)
    e, n, u = enu
    return (
        -F.sin(lo) * e - F.sin(la) * F.cos(lo) * n + F.cos(la) * F.cos(lo) * u,
        F.cos(lo) * e - F.sin(la) * F.sin(lo) * n + F.cos(la) * F.sin(lo) * u,
        F.cos(la) * n + F.sin(la) * u,
    )


def xyz_to_enu(lat: Column, lon: Column, xyz: Vector) -> Vector:
    la, lo = F.radians(lat), F.radians(lon)
    x, y, z = xyz
    return (
        -F.sin(lo) * x + F.cos(lo) * y,
        -F.sin(la) * F.cos(lo) * x - F.sin(la) * F.sin(lo) * y + F.cos(la) * z,
        F.cos(la) * F.cos(lo) * x + F.cos(la) * F.sin(lo) * y + F.sin(la) * z,
    )


def sch_matrix(lat: float, lon: float, heading_deg: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(rotation, origin offset, radius) of the sphere that fits the ellipsoid at a peg point."""
    la, lo, h = np.radians([lat, lon, heading_deg])
    east = MAJOR / math.sqrt(1 - E2 * math.sin(la) ** 2)
    north = MAJOR * (1 - E2) / (1 - E2 * math.sin(la) ** 2) ** 1.5
    radius = east * north / (east * math.cos(h) ** 2 + north * math.sin(h) ** 2)
    up = np.array([math.cos(la) * math.cos(lo), math.cos(la) * math.sin(lo), math.sin(la)])
    e = np.array([-math.sin(lo), math.cos(lo), 0.0])
    n = np.array([-math.sin(la) * math.cos(lo), -math.sin(la) * math.sin(lo), math.cos(la)])
    along = math.sin(h) * e + math.cos(h) * n
    rotation = np.stack([up, along, np.cross(up, along)], axis=1)
    peg = np.array([east * math.cos(la) * math.cos(lo), east * math.cos(la) * math.sin(lo), east * (1 - E2) * math.sin(la)])
    return rotation, peg - radius * up, radius


def intersect(a: tuple[Column, Column, Column, Column], b: tuple[Column, Column, Column, Column]) -> Column:
    """The overlap of two (west, south, east, north) boxes as a struct; null unless it has an area."""
    west, south = F.greatest(a[0], b[0]), F.greatest(a[1], b[1])
    east, north = F.least(a[2], b[2]), F.least(a[3], b[3])
    box = F.struct(west.alias("west"), south.alias("south"), east.alias("east"), north.alias("north"))
    return F.when((west < east) & (south < north), box)


@dataclass(frozen=True)
class Grid:
    """A north-up grid: (lon_min, lat_max) is the first cell, ``dlat`` is negative."""

    rows: int
    cols: int
    lon_min: float
    lat_max: float
    dlon: float
    dlat: float

    def row(self, lat: Column) -> Column:
        return ((lat - self.lat_max) / self.dlat).cast("int")

    def col(self, lon: Column) -> Column:
        return ((lon - self.lon_min) / self.dlon).cast("int")

    def inside(self, row: Column, col: Column) -> Column:
        return (row >= 0) & (row < self.rows) & (col >= 0) & (col < self.cols)

    def box(self, west: Column, south: Column, east: Column, north: Column) -> Column:
        """The half-open box (top, bottom, left, right) of the cells of an area, clamped to the grid."""
        down, across = lambda x: F.greatest(F.lit(0), F.least(x, F.lit(self.rows))), lambda x: F.greatest(F.lit(0), F.least(x, F.lit(self.cols)))
        return F.struct(down(self.row(north)).alias("top"), down(self.row(south) + 1).alias("bottom"), across(self.col(west)).alias("left"), across(self.col(east) + 1).alias("right"))

    def lat(self, row: Column) -> Column:
        return row * self.dlat + self.lat_max

    def lon(self, col: Column) -> Column:
        return col * self.dlon + self.lon_min

    def looks(self, row_looks: int, col_looks: int) -> Grid:
        """The grid of multilooked cells; its first cell is the centre of the first block."""
        return Grid(
            self.rows // row_looks, self.cols // col_looks, self.lon_min + (col_looks - 1) / 2 * self.dlon,
            self.lat_max + (row_looks - 1) / 2 * self.dlat, self.dlon * col_looks, self.dlat * row_looks,
        )

    def union(self, other: Grid) -> Grid:
        """The least grid of the same posting that covers both."""
        if abs(self.dlon - other.dlon) > 1e-12 or abs(self.dlat - other.dlat) > 1e-12:
            raise ValueError("the grids differ in posting")
        lon, lat = min(self.lon_min, other.lon_min), max(self.lat_max, other.lat_max)
        east = max(g.lon_min + g.cols * g.dlon for g in (self, other))
        south = min(g.lat_max + g.rows * g.dlat for g in (self, other))
        return Grid(round((south - lat) / self.dlat), round((east - lon) / self.dlon), lon, lat, self.dlon, self.dlat)

    def cells(self, spark: SparkSession) -> DataFrame:
        """All (row, col, lat, lon), made in parallel."""
        flat = spark.range(self.rows * self.cols)
        row, col = F.expr(f"cast(id div {self.cols} as int)"), (F.col("id") % self.cols).cast("int")
        return flat.select(row.alias("row"), col.alias("col")).withColumns({"lat": self.lat(F.col("row")), "lon": self.lon(F.col("col"))})

    def to_rsc(self) -> str:
        pairs = (("WIDTH", self.cols), ("FILE_LENGTH", self.rows), ("X_FIRST", self.lon_min), ("Y_FIRST", self.lat_max), ("X_STEP", self.dlon), ("Y_STEP", self.dlat))
        return "".join(f"{k:<14}{v!r}\n" for k, v in pairs)

    @classmethod
    def from_rsc(cls, text: str) -> Grid:
        found = {p[0]: p[1] for line in text.splitlines() if len(p := line.split()) >= 2}
        return cls(int(found["FILE_LENGTH"]), int(found["WIDTH"]), float(found["X_FIRST"]), float(found["Y_FIRST"]), float(found["X_STEP"]), float(found["Y_STEP"]))

    def geotransform(self) -> tuple[float, float, float, float, float, float]:
        """Corner of the first cell and steps; cells are named by their centres."""
        return self.lon_min - self.dlon / 2, self.dlon, 0.0, self.lat_max - self.dlat / 2, 0.0, self.dlat

    def kml(self, image: str, name: str = "overlay") -> str:
        north, south = self.lat_max, self.lat_max + self.dlat * self.rows
        west, east = self.lon_min, self.lon_min + self.dlon * self.cols
        box = f"<LatLonBox><north>{north!r}</north><south>{south!r}</south><east>{east!r}</east><west>{west!r}</west></LatLonBox>"
        return (
            '<?xml version="1.0" encoding="UTF-8"?>\n<kml xmlns="http://www.opengis.net/kml/2.2"><GroundOverlay>'
            f"<name>{name}</name><Icon><href>{image}</href></Icon>{box}</GroundOverlay></kml>\n"
        )


def clip_polygon(points: list[tuple[float, float]], west: float, south: float, east: float, north: float) -> list[tuple[float, float]]:
    """The part of a polygon within a box: one half-plane after the other."""
    for axis, bound, sign in ((0, west, 1), (0, east, -1), (1, south, 1), (1, north, -1)):
        out: list[tuple[float, float]] = []
        for i, now in enumerate(points):
            before = points[i - 1]
            d_now, d_before = sign * (now[axis] - bound), sign * (before[axis] - bound)
            if (d_now >= 0) != (d_before >= 0):
                share = d_before / (d_before - d_now)
                out.append(tuple(b + share * (n - b) for b, n in zip(before, now, strict=True)))
            if d_now >= 0:
                out.append(now)
        points = out
    return points
