"""Processing configuration: strict dataclasses from YAML, paths relative to the file."""

from __future__ import annotations

import dataclasses
import os
from dataclasses import dataclass, field
from typing import Any

import yaml


@dataclass
class Io:
    scenes: str = "scenes"
    interferograms: str = "interferograms"
    corrected: str = ""
    unwrapped: str = "unwrapped"
    output: str = "timeseries"


@dataclass
class Looks:
    rows: int = 10
    cols: int = 20


@dataclass
class Pairs:
    min_days: int = 6
    max_days: int = 360
    min_metres: float = 0.0
    max_metres: float = 300.0


@dataclass
class Filter:
    window: int = 32
    alpha: float = 0.5


@dataclass
class TimeSeries:
    method: str = "stack"
    mad_scale: float = 0.0
    regularisation: float = 0.0
    seasonal_terms: int = 1
    rounds: int = 20
    rho: float = 0.4
    alpha: float = 1.0
    reference_row: int = 0
    reference_col: int = 0
    reference_window: list[int] = field(default_factory=lambda: [10, 10])


METHODS = ("stack", "linear", "seasonal", "ls", "l1")


@dataclass
class Config:
    io: Io = field(default_factory=Io)
    looks: Looks = field(default_factory=Looks)
    pairs: Pairs = field(default_factory=Pairs)
    filter: Filter = field(default_factory=Filter)
    timeseries: TimeSeries = field(default_factory=TimeSeries)


def _build(kind: type, given: Any, where: str) -> Any:
    if not isinstance(given, dict):
        raise ValueError(f"{where} must be a mapping")
    known = {f.name: f for f in dataclasses.fields(kind)}
    if extra := sorted(set(given) - set(known)):
        raise ValueError(f"{where} has unknown keys: {', '.join(map(str, extra))}")
    out = {}
    for name, value in given.items():
        default = known[name].default if known[name].default is not dataclasses.MISSING else known[name].default_factory()
        if dataclasses.is_dataclass(default):
            out[name] = _build(type(default), value, f"{where}.{name}")
        elif isinstance(default, float) and isinstance(value, int) and not isinstance(value, bool):
            out[name] = float(value)
        elif type(value) is not type(default):
            raise ValueError(f"{where}.{name} must be of type {type(default).__name__}")
        else:
            out[name] = value
    return kind(**out)


def load(path: str, relative: bool = True) -> Config:
    with open(path) as f:
        config = _build(Config, yaml.safe_load(f) or {}, "config")
    if config.timeseries.method not in METHODS:
        raise ValueError(f"timeseries.method must be one of {', '.join(METHODS)}")
    if relative:
        base = os.path.dirname(os.path.abspath(path))
        for f in dataclasses.fields(Io):
            value = getattr(config.io, f.name)
            if value and not os.path.isabs(value) and "://" not in value:
                setattr(config.io, f.name, os.path.join(base, value))
    return config


def save(config: Config, path: str) -> None:
    with open(path, "w") as f:
        yaml.safe_dump(dataclasses.asdict(config), f, sort_keys=False)
