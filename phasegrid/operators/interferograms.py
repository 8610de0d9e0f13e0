"""Interferograms: formation, looks, mosaics, coherence, delay correction, stitching."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasegrid.functions import cplx
from phasegrid.operators import raster


def form(ref: DataFrame, sec: DataFrame, keys: Sequence[str] = ("r", "c")) -> DataFrame:
    """conj(ref) · sec on the pixels that both have."""
    a = ref.select(*keys, F.col("re").alias("a_re"), F.col("im").alias("a_im"))
    b = sec.select(*keys, F.col("re").alias("b_re"), F.col("im").alias("b_im"))
    re, im = cplx.mul_conj(cplx.pair("a_"), cplx.pair("b_"))
    return a.join(b, list(keys)).select(*keys, re.alias("re"), im.alias("im"))


def form_union(ref: DataFrame, sec: DataFrame, keys: Sequence[str] = ("r", "c")) -> DataFrame:
    """As ``form`` on the union of both extents, 0 where one is missing."""
    a = ref.select(*keys, F.col("re").alias("a_re"), F.col("im").alias("a_im"))
    b = sec.select(*keys, F.col("re").alias("b_re"), F.col("im").alias("b_im"))
    both = a.join(b, list(keys), "full").na.fill(0.0, ["a_re", "a_im", "b_re", "b_im"])
    re, im = cplx.mul_conj(cplx.pair("a_"), cplx.pair("b_"))
    return both.select(*keys, re.alias("re"), im.alias("im"))


def looked(ifg: DataFrame, rows: int, cols: int, looks: tuple[int, int], phase_only: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """Multilooked complex values, or their phase."""
    made = raster.multilook(ifg, rows, cols, looks, ["re", "im"], keys)
    return made.select(*keys, "br", "bc", cplx.angle(cplx.pair()).alias("phase")) if phase_only else made


def snapped_box(top: Column, bottom: Column, left: Column, right: Column, looks: tuple[int, int]) -> Column:
    """The largest box of whole looks inside a box: starts round up, ends down."""
    up = lambda x, n: F.ceil(x / n) * n
    down = lambda x, n: F.floor(x / n) * n
    a, b = looks
    return F.struct(up(top, a).alias("top"), down(bottom, a).alias("bottom"), up(left, b).alias("left"), down(right, b).alias("right"))


def coherence(ifg: DataFrame, amps: DataFrame, above_one: str = "null", keys: Sequence[str] = ("r", "c")) -> DataFrame:
    """(date1, date2, keys, amp product, coherence) from looks of ifgs and amplitudes per date."""
    first = amps.select(F.col("date").alias("date1"), *keys, F.col("amp").alias("amp1"))
    second = amps.select(F.col("date").alias("date2"), *keys, F.col("amp").alias("amp2"))
    joined = ifg.join(first, ["date1", *keys]).join(second, ["date2", *keys])
    value = cplx.coherence(cplx.magnitude(cplx.pair()), F.col("amp1"), F.col("amp2"), above_one)
    return joined.select("date1", "date2", *keys, (F.col("amp1") * F.col("amp2")).alias("amp"), value.alias("coherence"))


def _with_delays(df: DataFrame, delays: DataFrame, keys: Sequence[str], wavelength: float, flip: bool) -> DataFrame:
    first = delays.select(F.col("date").alias("date1"), *keys, F.col("delay").alias("delay1"))
    second = delays.select(F.col("date").alias("date2"), *keys, F.col("delay").alias("delay2"))
    joined = df.join(first, ["date1", *keys]).join(second, ["date2", *keys])
    phase = cplx.delay_phase(F.col("delay1"), F.col("delay2"), wavelength)
    return joined.withColumn("__phase", -phase if flip else phase).drop("delay1", "delay2")


def correct_wrapped(ifg: DataFrame, delays: DataFrame, wavelength: float, keys: Sequence[str] = ("r", "c"), flip: bool = False) -> DataFrame:
    """Rotate complex values by minus the differential delay phase."""
    joined = _with_delays(ifg, delays, keys, wavelength, flip)
    re, im = cplx.rotate(cplx.pair(), -F.col("__phase"))
    return joined.withColumns({"re": re, "im": im}).drop("__phase")


def correct_unwrapped(ifg: DataFrame, delays: DataFrame, value: str, wavelength: float, keys: Sequence[str] = ("r", "c"), flip: bool = False) -> DataFrame:
    joined = _with_delays(ifg, delays, keys, wavelength, flip)
    return joined.withColumn(value, F.col(value) - F.col("__phase")).drop("__phase")


def phase_offset(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Robust offset of ``re, im`` products per key: the angle of the mean phasor plus the median of
    what is left of each angle."""
    mean = pairs.groupBy(*keys).agg(F.atan2(F.avg("im"), F.avg("re")).alias("mean"))
    rest = pairs.join(mean, list(keys))
    re, im = cplx.rotate(cplx.pair(), -F.col("mean"))
    rest = rest.select(*keys, "mean", F.atan2(im, re).alias("rest"))
    return rest.groupBy(*keys).agg((F.first("mean") + F.median("rest")).alias("offset"))


def stitch_raw(bursts: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Mosaic of bursts, the first with data wins, without phase carry."""
    return raster.mosaic(bursts, order, ["re", "im"], F.col("re") != 0, keys=[*keys, "r", "c"])


def stitch_frame(subswaths: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mosaic of subswaths: the highest number with data wins."""
    return raster.mosaic(subswaths, "iw", ["re", "im"], F.col("re") != 0, last_wins=True, keys=[*keys, "r", "c"])


def carried(parts: Sequence[tuple[object, int, int, np.ndarray]]) -> tuple[np.ndarray, int, int]:
    """(mosaic, top, left) of (acquisition, top, left, values) in order. The offset is measured where
    the acquisition changes, against the mosaic so far, and carried until the next change."""
    top, left = min(t for _, t, _, _ in parts), min(le for _, _, le, _ in parts)
    bottom, right = max(t + v.shape[0] for _, t, _, v in parts), max(le + v.shape[1] for _, _, le, v in parts)
    out = np.zeros((bottom - top, right - left), dtype=np.complex128)
    offset, before = 0.0, None
    for acquisition, y, x, new in parts:
        view = out[y - top : y - top + new.shape[0], x - left : x - left + new.shape[1]]
        overlap = (view.real != 0) & (new != 0)
        if before is not None and acquisition != before and overlap.any():
            turn = np.conj(view[overlap]) * new[overlap]
            mean = np.angle(turn.mean())
            offset = mean + np.median(np.angle(turn * np.exp(-1j * mean)))
        before = acquisition
        empty = (view.real == 0) & (new.real != 0)
        view[empty] = (new * np.exp(-1j * offset))[empty]
    return out, top, left


def _stitched(rows: DataFrame, keys: Sequence[str], parts) -> DataFrame:
    """Fold each subswath: ``parts(table)`` lists its bursts in order."""

    def fold(table: pa.Table) -> pa.Table:
        out, top, left = carried(parts(table))
        r, c = np.nonzero(out)
        own = {k: pa.array([table.column(k)[0].as_py()] * len(r), table.schema.field(k).type) for k in keys}
        return pa.table(own | {"r": (r + top).astype(np.int64), "c": (c + left).astype(np.int32), "re": out[r, c].real, "im": out[r, c].imag})

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in keys)
    return rows.groupBy(*keys).applyInArrow(fold, f"{kinds}, r long, c int, re double, im double")


def stitch_subswath(tiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stitch the bursts of one subswath with the phase offset carried forward.

    ``tiles`` has a row per burst: keys, ord, acquisition (the image pair's id), top, left, height,
    width, re and im as arrays. The offset of a burst is measured against the mosaic of those before
    it, which are already corrected, so the bursts of one subswath (nine or ten) are folded in order
    by one task; subswaths are independent. Returns (keys, r, c, re, im) of cells with data."""

    def parts(table: pa.Table) -> list[tuple[object, int, int, np.ndarray]]:
        rows = sorted(table.to_pylist(), key=lambda x: x["ord"])
        return [(x["acquisition"], x["top"], x["left"], (np.asarray(x["re"]) + 1j * np.asarray(x["im"])).reshape(x["height"], x["width"])) for x in rows]

    return _stitched(tiles, keys, parts)


def stitch_subswath_pixels(pixels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As ``stitch_subswath`` from (keys, ord, acquisition, r, c, re, im), a row per pixel; ``ord``
    tells the bursts apart."""
    numbered = pixels.withColumn("__n", F.dense_rank().over(Window.partitionBy(*keys).orderBy("ord")))
    names = [*keys, "__n", "acquisition", "r", "c", "re", "im"]

    def parts(table: pa.Table) -> list[tuple[object, int, int, np.ndarray]]:
        n, r, c = (table.column(x).to_numpy() for x in ("__n", "r", "c"))
        z = table.column("re").to_numpy() + 1j * table.column("im").to_numpy()
        order = np.argsort(n, kind="stable")
        out = []
        for at in np.split(order, np.flatnonzero(np.diff(n[order])) + 1):
            top, left = int(r[at].min()), int(c[at].min())
            values = np.zeros((int(r[at].max()) - top + 1, int(c[at].max()) - left + 1), dtype=np.complex128)
            values[r[at] - top, c[at] - left] = z[at]
            out.append((table.column("acquisition")[int(at[0])].as_py(), top, left, values))
        return out

    return _stitched(numbered.select(*names), keys, parts)


def goldstein(ifg: DataFrame, rows: int, cols: int, window: int = 32, alpha: float = 0.5, keys: Sequence[str] = ()) -> DataFrame:
    """Adaptive spectral filter over overlapping patches.

    Patches of ``window``² start every window/4 cells; the last of an axis is moved inwards. Each is
    transformed, its magnitude is smoothed circularly by a 7 × 7 Gaussian and divided by its mean,
    and the spectrum is multiplied by that weight to the power ``alpha``. Patches are summed with
    triangular weights. A patch is one group of window² pixels; the sums are a shuffle by pixel."""
    step = max(1, window // 4)

    def hits(n: int, axis: str) -> Column:
        """The starts of the patches that hold a cell, by arithmetic: at most window / step + 1."""
        x, last, inner = F.col(axis).cast("int"), max(1, math.ceil(n / step) - 3) - 1, max(0, n - window)
        first = F.greatest(F.lit(0), F.floor((x - window) / step).cast("int") + 1)
        near = F.sequence(F.least(first, F.lit(last)), F.greatest(F.least(first, F.lit(last)), F.least(F.floor(x / step).cast("int"), F.lit(last))))
        every = F.concat(F.transform(near, lambda i: F.least(i * step, F.lit(inner))), F.array(F.lit(min(last * step, inner))))
        return F.array_distinct(F.filter(every, lambda s: (s <= x) & (x < s + window)))

    spread = ifg.select(*keys, "r", "c", "re", "im", F.explode(hits(rows, "r")).alias("pr"))
    spread = spread.select("*", F.explode(hits(cols, "c")).alias("pc"))
    ramp = np.minimum(np.arange(window) + 0.5, window - np.arange(window) - 0.5)
    triangle = np.outer(ramp, ramp) / ramp.max() ** 2
    g = np.exp(-0.5 * (np.arange(-3, 4) / 1.5) ** 2)
    kernel = np.outer(g, g) / np.outer(g, g).sum()

    def one(table: pa.Table) -> pa.Table:
        r, c = table.column("r").to_numpy(), table.column("c").to_numpy()
        pr, pc = table.column("pr")[0].as_py(), table.column("pc")[0].as_py()
        patch = np.zeros((window, window), dtype=np.complex128)
        patch[r - pr, c - pc] = table.column("re").to_numpy() + 1j * table.column("im").to_numpy()
        spectrum = np.fft.fft2(patch)
        size = np.abs(spectrum)
        smooth = sum(kernel[i, j] * np.roll(size, (i - 3, j - 3), axis=(0, 1)) for i in range(7) for j in range(7))
        mean = smooth.mean()
        weight = (smooth / mean) ** alpha if mean > 1e-8 else np.zeros_like(smooth)
        out = np.fft.ifft2(spectrum * weight) * triangle
        own = {k: table.column(k) for k in keys}
        return pa.table(own | {"r": r, "c": c, "re": out[r - pr, c - pc].real, "im": out[r - pr, c - pc].imag, "w": triangle[r - pr, c - pc]})

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in ifg.schema.fields if f.name in keys)
    kind_r, kind_c = (dict(ifg.dtypes)[x] for x in ("r", "c"))
    filtered = spread.groupBy(*keys, "pr", "pc").applyInArrow(one, f"{kinds}r {kind_r}, c {kind_c}, re double, im double, w double")
    summed = filtered.groupBy(*keys, "r", "c").agg(F.sum("re").alias("re"), F.sum("im").alias("im"), F.sum("w").alias("w"))
    return summed.select(*keys, "r", "c", (F.col("re") / F.col("w")).alias("re"), (F.col("im") / F.col("w")).alias("im"))


