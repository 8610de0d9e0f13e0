"""Scene catalogues, parameters and manifests as relational operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasegrid.functions.geo import Grid
from phasegrid.session import cut


def dedup(rows: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``; rows without a key are dropped. One aggregate of the
    least struct, combined on the map side, instead of a sort per key."""
    columns = [c for c in rows.columns if c not in order]
    keyed = rows.withColumn("__key", key).where(F.col("__key").isNotNull())
    first = keyed.groupBy("__key").agg(F.min(F.struct(*order)).alias("__o"), F.min_by(F.struct(*columns), F.struct(*order)).alias("__r"))
    return first.select("__o.*", "__r.*").select(*rows.columns)


def middle(rows: DataFrame, keys: Sequence[str], order: str, keep: str) -> DataFrame:
    """Per key the element n div 2 of the order, such as the middle orbit by perpendicular baseline.
    Groups are graph-sized (a row per date)."""
    w = Window.partitionBy(*keys)
    ranked = rows.select(*keys, order, keep, F.row_number().over(w.orderBy(order, keep)).alias("__i"), F.count("*").over(w).alias("__n"))
    return ranked.where(F.col("__i") == F.floor(F.col("__n") / 2) + 1).select(*keys, keep, order)


def changes(rows: DataFrame, keys: Sequence[str], order: str, watched: Sequence[str]) -> DataFrame:
    """Adds ``changed``: a watched column differs from the previous row's; false for the first."""
    w = Window.partitionBy(*keys).orderBy(order)
    differs = [~F.col(c).eqNullSafe(F.lag(c).over(w)) for c in watched]
    first = F.row_number().over(w) == 1
    some = differs[0]
    for d in differs[1:]:
        some = some | d
    return rows.withColumn("changed", ~first & some)


def scene_key(name: Column, file_id: Column) -> Column:
    return F.coalesce(F.nullif(name, F.lit("")), F.nullif(file_id, F.lit("")))


def path_summary(scenes: DataFrame, path: str, frame: str, direction: str, order: str) -> DataFrame:
    """Per path its sorted distinct frames, number of scenes and first flight direction."""
    return scenes.groupBy(path).agg(
        F.array_join(F.sort_array(F.collect_set(frame)), ",").alias("frames"), F.count("*").alias("n_scenes"), F.min_by(direction, order).alias("direction")
    )


def by_path(scenes: DataFrame, path: int | None = None, frames: Sequence[int] | None = None) -> DataFrame:
    """Filter by path and frames; an empty result is an error, raised when it is known."""
    out = scenes
    if path is not None:
        out = out.where(F.col("path") == path)
    if frames:
        out = out.where(F.col("frame").isin([int(f) for f in frames]))
    if out.isEmpty():
        raise ValueError(f"no scene of path {path} and frames {frames}")
    return out


def zip_members(names: DataFrame, name: str, part: str, suffix: str, polarisation: str) -> DataFrame:
    column = F.lower(F.col(name))
    return names.where(F.col(name).contains(part) & column.endswith(suffix.lower()) & column.contains(polarisation.lower()))


def footprint(polygons: DataFrame, keys: Sequence[str], rings: str) -> DataFrame:
    """The box of array<array<array<double>>> rings of (lon, lat) points; null when there are none."""
    points = F.flatten(rings)
    lon, lat = F.transform(points, lambda p: F.get(p, F.lit(0))), F.transform(points, lambda p: F.get(p, F.lit(1)))
    return polygons.groupBy(*keys).agg(
        F.min(F.array_min(lon)).alias("west"), F.min(F.array_min(lat)).alias("south"), F.max(F.array_max(lon)).alias("east"), F.max(F.array_max(lat)).alias("north")
    )


def clipped_boxes(polygons: DataFrame, ring: str, grid: Grid) -> DataFrame:
    """Polygons with the box (top, bottom, left, right) of the cells of the part of their ``ring``
    (array of (lon, lat) arrays) that lies on the grid; null where none does. The ring is cut at one
    side of the grid after the other, all in array functions."""
    east, south = grid.lon_min + grid.cols * grid.dlon, grid.lat_max + grid.rows * grid.dlat
    out = polygons.withColumn("__p", F.col(ring))

    def side(axis: int, bound: float, sign: int):
        def step(before: Column, now: Column) -> Column:
            far, near = sign * (before[axis] - bound), sign * (now[axis] - bound)
            other = before[1 - axis] + F.try_divide(far, far - near) * (now[1 - axis] - before[1 - axis])
            crossing = F.array(F.lit(bound), other) if axis == 0 else F.array(other, F.lit(bound))
            none = F.slice(F.array(now), 1, 0)
            return F.concat(F.when((far >= 0) != (near >= 0), F.array(crossing)).otherwise(none), F.when(near >= 0, F.array(now)).otherwise(none))

        return step

    for axis, bound, sign in ((0, grid.lon_min, 1), (0, east, -1), (1, south, 1), (1, grid.lat_max, -1)):
        turned = F.concat(F.slice("__p", -1, 1), F.slice("__p", F.lit(1), F.greatest(F.size("__p") - 1, F.lit(0))))
        out = out.withColumn("__q", turned).withColumn("__p", F.flatten(F.zip_with("__q", "__p", side(axis, bound, sign)))).drop("__q")
    lon, lat = F.transform("__p", lambda p: F.get(p, F.lit(0))), F.transform("__p", lambda p: F.get(p, F.lit(1)))
    box = grid.box(F.array_min(lon), F.array_min(lat), F.array_max(lon), F.array_max(lat))
    return out.withColumn("__b", F.when(F.size("__p") > 0, box)).select(*polygons.columns, *[F.col(f"__b.{n}").alias(n) for n in ("top", "bottom", "left", "right")])


def json_field(json: Column, *paths: str) -> Column:
    """The first of several paths that is present."""
    return F.coalesce(*[F.get_json_object(json, p) for p in paths])


def upsert(rows: DataFrame, key: Sequence[str], sequence: str) -> DataFrame:
    """The last version of each key."""
    columns = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*columns), F.col(sequence)).alias("r")).select(*key, "r.*")


def wide(params: DataFrame, keys: Sequence[str], typed: dict[str, str]) -> DataFrame:
    """Text parameters (keys, name, value) as one typed row; values that don't parse are null. The
    names are given, so the pivot needs no pass to find them."""
    picks = [F.max(F.when(F.col("name") == n, F.col("value").try_cast(kind))).alias(n) for n, kind in typed.items()]
    return params.where(F.col("name").isin(list(typed))).groupBy(*keys).agg(*picks)


def todo(wanted: DataFrame, done: DataFrame, key: Sequence[str]) -> DataFrame:
    """What isn't done yet."""
    return wanted.join(done.select(*key).distinct(), list(key), "left_anti")


def linked(links: DataFrame, roots: DataFrame, rounds: int = 50) -> DataFrame:
    """All names reachable from ``roots(name)`` over ``links(name, target)``: semi-naive rounds, each
    checkpoint holding only the names found so far."""
    seen = cut(roots.select("name").distinct())
    new = seen
    for _ in range(rounds):
        step = new.join(links, "name").select(F.col("target").alias("name")).distinct().join(seen, "name", "left_anti")
        new = cut(step)
        if new.isEmpty():
            return seen
        seen = cut(seen.unionByName(new))
    raise RuntimeError("links are deeper than the rounds allowed")


def split_ranges(count, start: int, end: int, cap: int = 2000) -> Iterator[tuple[int, int]]:
    """Halve [start, end) until ``count(start, end)`` is at most ``cap`` or one unit is left: the
    adaptive planner of a paged catalogue."""
    if end - start <= 1 or count(start, end) <= cap:
        yield start, end
        return
    middle = (start + end) // 2
    yield from split_ranges(count, start, middle, cap)
    yield from split_ranges(count, middle, end, cap)


def with_files(scenes: DataFrame, name: str, files: DataFrame, path: str) -> DataFrame:
    """Scenes and the least path of the files that bear their name; null where none does."""
    stem = F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)
    found = files.groupBy(stem.alias(name)).agg(F.min(path).alias(path))
    return scenes.join(found, name, "left")
