"""Phase unwrapping: gradients, residues and costs as windows; a spanning-tree unwrapper per tile.

The relational parts work on long pixels. The tree is a heap algorithm over one tile; ``tiled_unwrap``
cuts frames of any size into tiles of bounded size and levels them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasegrid.functions import cplx

PI = math.pi
CYCLE_STEPS = 200
MAX_WEIGHT = 1000


def gradients(phases: DataFrame, keys: Sequence[str] = (), phase: str = "phase") -> DataFrame:
    """(keys, r, c, phase, dc, dr): wrapped differences to the next column and row, in cycles; null at
    the far edges."""
    along = Window.partitionBy(*keys, "r").orderBy("c")
    down = Window.partitionBy(*keys, "c").orderBy("r")
    step = lambda w: cplx.wrap_cycles((F.lead(phase).over(w) - F.col(phase)) / (2 * PI))
    return phases.select(*keys, "r", "c", phase, step(along).alias("dc"), step(down).alias("dr"))


def residues(phases: DataFrame, keys: Sequence[str] = (), phase: str = "phase") -> DataFrame:
    """(keys, r, c, residue) of each 2 × 2 loop, by its upper left pixel."""
    grads = gradients(phases, keys, phase)
    right = F.lead("dr").over(Window.partitionBy(*keys, "r").orderBy("c"))
    below = F.lead("dc").over(Window.partitionBy(*keys, "c").orderBy("r"))
    loop = grads.select(*keys, "r", "c", F.rint(F.col("dc") + right - below - F.col("dr")).cast("int").alias("residue"))
    return loop.where("residue is not null")


def integrate(phases: DataFrame, keys: Sequence[str] = (), phase: str = "phase") -> DataFrame:
    """(keys, r, c, unwrapped): wrapped differences summed along the first row, then down columns.
    Right where there are no residues."""
    grads = gradients(phases, keys, phase)
    along = Window.partitionBy(*keys, "r").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*keys, "c").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    first_row = F.col("r") == F.min("r").over(Window.partitionBy(*keys, "c"))
    made = grads.withColumn("row_sum", F.coalesce(F.sum("dc").over(along), F.lit(0.0))).withColumn("col_sum", F.coalesce(F.sum("dr").over(down), F.lit(0.0)))
    top = F.max(F.when(first_row, F.col("row_sum"))).over(Window.partitionBy(*keys, "c"))
    made = made.withColumn("cycles", F.col("col_sum") + top)
    if keys:
        start = Window.partitionBy(*keys).orderBy("r", "c")
        return made.select(*keys, "r", "c", (F.first(phase).over(start) + 2 * PI * F.col("cycles")).alias("unwrapped"))
    origin = phases.agg(F.min_by(phase, F.struct("r", "c")).alias("origin"))
    return made.crossJoin(F.broadcast(origin)).select("r", "c", (F.col("origin") + 2 * PI * F.col("cycles")).alias("unwrapped"))


def cost_variance(coherence: Column | np.ndarray, scale: float = 1.0, sigma: float = 0.05, power: float = 0.5):
    """The variance of a difference in sub-cycles, from its coherence; for columns and arrays."""
    return ((1 - coherence) ** power / 6.0 + sigma) * (float(CYCLE_STEPS) ** 2) / scale


def smooth_costs(grads: DataFrame, mean: str, diff: str, coherence: str, scale: float = 1.0, sigma: float = 0.05, power: float = 0.5) -> DataFrame:
    """Adds (offset, variance) of the quadratic arc cost in sub-cycles: the offset from the local mean
    gradient, half of it where the coherence is 0, and the variance from the coherence."""
    n = float(CYCLE_STEPS)
    used = F.when(F.col(coherence) > 0, F.col(mean)).otherwise(0.5 * F.col(mean))
    variance = cost_variance(F.col(coherence), scale, sigma, power)
    return grads.withColumns({"offset": F.rint(n * (F.col(diff) - used)).cast("int"), "variance": F.ceil(variance).cast("int")})


def unwrap_array(wrapped: np.ndarray, weight_r: np.ndarray | None = None, weight_c: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(unwrapped, residues) of one tile by the cheapest tree that joins all residues to the ground.

    Nodes are 2 × 2 loops and a ground node around the tile; crossing an arc costs the weight of the
    pixel difference it crosses (``weight_r`` of vertical differences, ``weight_c`` of horizontal
    ones). The tree grows by repeated shortest paths from the tree to the next charge, tree arcs
    being free; then charges flow from the leaves to the root, and the flow on an arc is the number
    of cycles its difference is off."""
    rows, cols = wrapped.shape
    if rows < 2 or cols < 2:
        return np.unwrap(wrapped, axis=0 if cols < 2 else 1), np.zeros((max(0, rows - 1), max(0, cols - 1)), dtype=int)
    cycles = wrapped / (2 * PI)
    fold = lambda x: x - np.floor(x + 0.5)
    dc, dr = fold(np.diff(cycles, axis=1)), fold(np.diff(cycles, axis=0))
    charge = np.rint(dc[:-1] + dr[:, 1:] - dc[1:] - dr[:, :-1]).astype(int)
    weight_c = np.ones(dc.shape) if weight_c is None else np.clip(weight_c, 0, MAX_WEIGHT)
    weight_r = np.ones(dr.shape) if weight_r is None else np.clip(weight_r, 0, MAX_WEIGHT)
    ground = (rows - 1) * (cols - 1)

    def arcs(node: int) -> list[tuple[int, float, str, int, int, int]]:
        """(other node, weight, kind, row, column of the difference, sign of the flow)."""
        if node == ground:
            out = [(j, weight_c[0, j], "c", 0, j, -1) for j in range(cols - 1)]
            out += [((rows - 2) * (cols - 1) + j, weight_c[rows - 1, j], "c", rows - 1, j, 1) for j in range(cols - 1)]
            out += [(i * (cols - 1), weight_r[i, 0], "r", i, 0, 1) for i in range(rows - 1)]
            return out + [(i * (cols - 1) + cols - 2, weight_r[i, cols - 1], "r", i, cols - 1, -1) for i in range(rows - 1)]
        i, j = divmod(node, cols - 1)
        up = node - (cols - 1) if i else ground
        down = node + (cols - 1) if i < rows - 2 else ground
        left = node - 1 if j else ground
        right = node + 1 if j < cols - 2 else ground
        return [
            (up, weight_c[i, j], "c", i, j, 1), (down, weight_c[i + 1, j], "c", i + 1, j, -1),
            (left, weight_r[i, j], "r", i, j, -1), (right, weight_r[i, j + 1], "r", i, j + 1, 1),
        ]

    charges = {int(n) for n in np.flatnonzero(charge)}
    parent: dict[int, tuple[int, str, int, int, int]] = {}
    if charges:
        best = {ground: 0.0}
        back: dict[int, tuple[int, str, int, int, int]] = {}
        heap, tree = [(0.0, ground)], {ground}
        while charges:
            far, node = heapq.heappop(heap)
            if far > best.get(node, math.inf):
                continue
            if node in charges:
                charges.discard(node)
                walk = node
                while walk not in tree:
                    tree.add(walk)
                    parent[walk] = back[walk]
                    best[walk] = 0.0
                    heapq.heappush(heap, (0.0, walk))
                    walk = back[walk][0]
                continue
            for other, weight, kind, i, j, sign in arcs(node):
                if far + weight < best.get(other, math.inf) and other not in tree:
                    best[other] = far + weight
                    back[other] = (node, kind, i, j, sign)
                    heapq.heappush(heap, (best[other], other))
    flow_c, flow_r = np.zeros(dc.shape), np.zeros(dr.shape)
    load = {n: int(charge.flat[n]) for n in parent}
    children: dict[int, int] = {}
    for up, *_ in parent.values():
        children[up] = children.get(up, 0) + 1
    leaves = [n for n in parent if not children.get(n)]
    while leaves:
        node = leaves.pop()
        up, kind, i, j, sign = parent[node]
        if load[node]:
            (flow_c if kind == "c" else flow_r)[i, j] += sign * load[node]
            if up in load:
                load[up] += load[node]
        children[up] -= 1
        if not children[up] and up in parent:
            leaves.append(up)
    dc, dr = dc + flow_c, dr + flow_r
    whole = np.zeros((rows, cols))
    whole[0, 1:] = np.cumsum(dc[0])
    whole[1:] = whole[0] + np.cumsum(dr, axis=0)
    return wrapped[0, 0] + 2 * PI * whole, charge


def joined_cells(cost_c: np.ndarray, cost_r: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether neighbouring pixels belong together: the shortfall of the arc cost below the threshold,
    smoothed 1-2-1 along the arc's direction, is 0."""

    def one(cost: np.ndarray, axis: int) -> np.ndarray:
        gap = np.maximum(0.0, threshold - cost)
        pad = [(1, 1) if a == axis else (0, 0) for a in (0, 1)]
        ones = np.pad(np.ones_like(gap), pad)
        padded = np.pad(gap, pad)
        cut = lambda x, s: np.take(x, np.arange(s, s + gap.shape[axis]), axis=axis)
        total = cut(padded, 0) + 2 * cut(padded, 1) + cut(padded, 2)
        return np.rint(total / (cut(ones, 0) + 2 * cut(ones, 1) + cut(ones, 2))) == 0

    return one(cost_c, 1), one(cost_r, 0)


def components(join_c: np.ndarray, join_r: np.ndarray, min_share: float = 0.01, most: int = 32) -> np.ndarray:
    """Labels 1.. of the connected pixels in scan order; small and surplus components are 0."""
    rows, cols = join_c.shape[0], join_r.shape[1]
    label = np.zeros((rows, cols), dtype=np.int32)
    found: list[tuple[int, int]] = []
    for start in range(rows * cols):
        if label.flat[start]:
            continue
        number, todo, size = len(found) + 1, [start], 0
        label.flat[start] = number
        while todo:
            i, j = divmod(todo.pop(), cols)
            size += 1
            near = []
            if j + 1 < cols and join_c[i, j]:
                near.append((i, j + 1))
            if j and join_c[i, j - 1]:
                near.append((i, j - 1))
            if i + 1 < rows and join_r[i, j]:
                near.append((i + 1, j))
            if i and join_r[i - 1, j]:
                near.append((i - 1, j))
            for a, b in near:
                if not label[a, b]:
                    label[a, b] = number
                    todo.append(a * cols + b)
        found.append((size, number))
    large = [f for f in found if f[0] >= min_share * rows * cols]
    chosen = sorted(sorted(large, key=lambda f: (-f[0], -f[1]))[:most], key=lambda f: f[1])
    renamed = np.zeros(len(found) + 1, dtype=np.int32)
    for new, (_, old) in enumerate(chosen, 1):
        renamed[old] = new
    return renamed[label]


def arc_weights(coherence: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of vertical and horizontal differences: the inverse cost variance of the lesser coherence
    of the two cells, ``MAX_WEIGHT`` at coherence 1. Differences with an absent cell cost nothing."""

    def one(axis: int) -> np.ndarray:
        n = coherence.shape[axis]
        pair = lambda x: (np.take(x, range(n - 1), axis=axis), np.take(x, range(1, n), axis=axis))
        worst = np.clip(np.minimum(*pair(coherence)), 0.0, 1.0)
        weight = np.maximum(1, np.rint(MAX_WEIGHT * cost_variance(1.0) / cost_variance(worst)))
        return np.where(np.logical_and(*pair(known)), weight, 0)

    return one(0), one(1)


def unwrap(phases: DataFrame, keys: Sequence[str], phase: str = "phase", coherence: str | None = None) -> DataFrame:
    """(keys, r, c, unwrapped): one tile per key. Differences are weighted by ``coherence``, or equally;
    crossing cells that are absent from a tile costs nothing, and they aren't returned."""

    def one(table: pa.Table) -> pa.Table:
        r, c = table.column("r").to_numpy(), table.column("c").to_numpy()
        top, left = r.min(), c.min()
        tile = np.zeros((r.max() - top + 1, c.max() - left + 1))
        known, quality = np.zeros(tile.shape, dtype=bool), np.ones(tile.shape)
        tile[r - top, c - left] = table.column(phase).to_numpy()
        known[r - top, c - left] = True
        if coherence:
            quality[r - top, c - left] = table.column(coherence).to_numpy()
        plain = coherence is None and known.all()
        out, _ = unwrap_array(tile, *(() if plain else arc_weights(quality, known)))
        return pa.table({k: table.column(k) for k in keys} | {"r": r, "c": c, "unwrapped": out[r - top, c - left]})

    own = [f for f in phases.schema.fields if f.name in [*keys, "r", "c"]]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own)
    ordered = phases.select(*[f.name for f in own], phase, *([coherence] if coherence else []))
    return ordered.groupBy(*keys).applyInArrow(one, f"{kinds}, unwrapped double")


def tile_count(size: int, tile: int = 1024) -> int:
    return max(1, size // tile)


def tiled_unwrap(
    phases: DataFrame, keys: Sequence[str], shape: tuple[int, int], tiles: tuple[int, int] | None = None, overlap: tuple[int, int] = (200, 200),
    phase: str = "phase", coherence: str | None = None,
) -> DataFrame:
    """(keys, r, c, unwrapped) of frames of any size: overlapping tiles, one for each 1024 rows and
    columns, are unwrapped on their own and levelled by the cycles between them where they overlap. A
    cell is copied to the tiles that hold it, two or four at a seam."""
    tiles = tiles or (tile_count(shape[0]), tile_count(shape[1]))

    def held(axis: str, i: int) -> Column:
        step, reach = -(-shape[i] // tiles[i]), overlap[i] // 2
        own = F.floor(F.col(axis) / step).cast("int")
        near = F.filter(F.array(own - 1, own, own + 1), lambda t: (t >= 0) & (t < tiles[i]) & (F.col(axis) >= t * step - reach) & (F.col(axis) < (t + 1) * step + reach))
        return F.explode(near)

    rows = phases.withColumn("__ti", held("r", 0)).withColumn("__tj", held("c", 1))
    rows = rows.withColumn("tile", (F.col("__ti") * tiles[1] + F.col("__tj")).cast("int")).drop("__ti", "__tj")
    return level_tiles(unwrap(rows, [*keys, "tile"], phase, coherence), "tile", keys=keys)


def seam_offsets(tiles: DataFrame, tile: str, phase: str = "unwrapped", keys: Sequence[str] = ()) -> DataFrame:
    """(keys, tile a, tile b, cycles): the rounded median of the cycles between tiles on shared pixels."""
    a = tiles.select(*keys, "r", "c", F.col(tile).alias("a"), F.col(phase).alias("pa"))
    b = tiles.select(*keys, "r", "c", F.col(tile).alias("b"), F.col(phase).alias("pb"))
    both = a.join(b, [*keys, "r", "c"]).where("a < b")
    return both.groupBy(*keys, "a", "b").agg(F.rint(F.median((F.col("pb") - F.col("pa")) / (2 * PI))).cast("int").alias("cycles"), F.count("*").alias("n"))


def tile_levels(a: Sequence, b: Sequence, cycles: Sequence[int], weight: Sequence[int]) -> dict:
    """The cycles to add to each tile of one frame: along a tree of the seams with the most pixels, from
    the least tile of each connected group."""
    near: dict = {}
    for x, y, d, n in zip(a, b, cycles, weight, strict=True):
        near.setdefault(x, []).append((n, y, -d))
        near.setdefault(y, []).append((n, x, d))
    level: dict = {}
    for root in sorted(near):
        todo = [] if root in level else [(0, root, 0)]
        while todo:
            _, t, offset = heapq.heappop(todo)
            if t not in level:
                level[t] = offset
                for n, other, d in near[t]:
                    heapq.heappush(todo, (-n, other, offset + d))
    return level


def level_tiles(tiles: DataFrame, tile: str, phase: str = "unwrapped", keys: Sequence[str] = ()) -> DataFrame:
    """(keys, r, c, phase): overlapping tiles brought to the level of the least tile of their group. The
    tile graph of a frame has one row per pair of neighbouring tiles and is solved in one task; pixels
    then take the least tile that has them."""
    kinds = dict(tiles.dtypes)

    def solve(table: pa.Table) -> pa.Table:
        levels = tile_levels(*[table.column(n).to_pylist() for n in ("a", "b", "cycles", "n")])
        same = {k: pa.array([table.column(k)[0].as_py()] * len(levels), table.schema.field(k).type) for k in keys}
        return pa.table(same | {tile: pa.array(list(levels), table.schema.field("a").type), "cycles": pa.array(list(levels.values()), pa.int32())})

    schema = ", ".join([f"`{k}` {kinds[k]}" for k in [*keys, tile]] + ["cycles int"])
    edges = seam_offsets(tiles, tile, phase, keys)
    levels = (edges.groupBy(*keys) if keys else edges.groupBy(F.lit(0).alias("__frame"))).applyInArrow(solve, schema)
    moved = tiles.join(levels, [*keys, tile], "left").withColumn(phase, F.col(phase) + 2 * PI * F.coalesce("cycles", F.lit(0)))
    return moved.groupBy(*keys, "r", "c").agg(F.min_by(phase, tile).alias(phase))
