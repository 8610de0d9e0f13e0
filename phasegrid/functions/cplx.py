"""Complex arithmetic on pairs of DOUBLE columns. A complex value is (re, im), as Column pair or as
struct; everything stays within whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Complex = tuple[Column, Column]
PI = math.pi


def pair(prefix: str = "") -> Complex:
    return F.col(f"{prefix}re"), F.col(f"{prefix}im")


def mul_conj(a: Complex, b: Complex) -> Complex:
    """conj(a) · b."""
    return a[0] * b[0] + a[1] * b[1], a[0] * b[1] - a[1] * b[0]


def power(z: Complex) -> Column:
    return z[0] * z[0] + z[1] * z[1]


def magnitude(z: Complex) -> Column:
    return F.sqrt(power(z))


def angle(z: Complex) -> Column:
    return F.atan2(z[1], z[0])


def unit(z: Complex, tiny: float = 1e-8) -> Complex:
    """z / abs(z), or 0 where the magnitude is ``tiny`` or less."""
    size = magnitude(z)
    return tuple(F.when(size > tiny, part / size).otherwise(0.0) for part in z)


def rotate(z: Complex, phase: Column) -> Complex:
    """z · exp(i·phase)."""
    cos, sin = F.cos(phase), F.sin(phase)
    return z[0] * cos - z[1] * sin, z[0] * sin + z[1] * cos


def wrap(phase: Column) -> Column:
    """Into (−π, π]."""
    return phase - 2 * PI * F.ceil((phase - PI) / (2 * PI))


def wrap_positive(phase: Column) -> Column:
    """Into [0, 2π)."""
    return phase - 2 * PI * F.floor(phase / (2 * PI))


def wrap_cycles(cycles: Column) -> Column:
    """Into [−0.5, 0.5)."""
    return cycles - F.floor(cycles + 0.5)


def wrap_once(phase: Column) -> Column:
    """One step of ±2π where the phase lies outside of [−π, π]."""
    return F.when(phase > PI, phase - 2 * PI).when(phase < -PI, phase + 2 * PI).otherwise(phase)


def soft_threshold(a: Column, kappa: Column | float) -> Column:
    return F.greatest(F.lit(0.0), a - kappa) - F.greatest(F.lit(0.0), -a - kappa)


def displacement(phase: Column, wavelength: float) -> Column:
    return phase * (wavelength / (4 * PI))


def coherence(ifg: Column, amp1: Column, amp2: Column, above_one: str = "null") -> Column:
    """abs(ifg) / amp1 / amp2. Values above 1 become null, are clipped to 1, or (``hash``) turn into
    a repeatable uniform number."""
    value = ifg / (amp1 + 1e-12) / (amp2 + 1e-12)
    above = {
        "null": F.lit(None).cast("double"),
        "clip": F.lit(1.0),
        "hash": F.pmod(F.xxhash64(ifg, amp1, amp2), F.lit(1_000_000)).cast("double") / 1_000_000,
    }[above_one]
    return F.when(value > 1, above).otherwise(value)


def delay_phase(delay1: Column, delay2: Column, wavelength: float) -> Column:
    return (delay1 - delay2) / wavelength * 4 * PI


def deramp_phase(kt: Column, eta: Column, eta_ref: Column) -> Column:
    """Phase that removes the azimuth ramp of a burst."""
    return -PI * kt * (eta - eta_ref) * (eta - eta_ref)


def quadratic(c0: Column, c1: Column, c2: Column, x: Column) -> Column:
    return c0 + c1 * x + c2 * x * x


def doppler_rate(ka: Column, steering_deg: Column, speed: Column, frequency: float, light: float = 299792458.0) -> Column:
    """The total rate kt from the FM rate and the antenna's steering rate."""
    ks = 2 * speed * frequency / light * steering_deg * (PI / 180)
    return ka * ks / (ka - ks)
