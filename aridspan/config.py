"""Configuration documents: found by walking up, read from YAML, checked into dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from pathlib import Path

import yaml

from aridspan.functions.periods import period_code


def find_root(start: str | Path, marker: str) -> Path:
    """The first folder from start upwards that holds marker."""
    start = Path(start).resolve()
    for folder in (start, *start.parents):
        if (folder / marker).exists():
            return folder
    raise FileNotFoundError(f"{marker} is in no folder from {start} upwards")


def read_yaml(path: str | Path) -> dict:
    """The document at path, or at that path below the first folder upwards that has it."""
    path = Path(path)
    if not path.exists() and not path.is_absolute():
        path = find_root(Path.cwd(), str(path)) / path
    return yaml.safe_load(path.read_text(encoding="utf-8")) or {}


@dataclass(frozen=True)
class Bounds:
    """A box of cell centres, both ends included."""

    south: float
    north: float
    west: float
    east: float
    stride: int = 1

    @classmethod
    def of(cls, region: dict) -> Bounds:
        return cls(region["lat_min"], region["lat_max"], region["lon_min"], region["lon_max"], int(region.get("stride", 1)))


@dataclass(frozen=True)
class IndexConfig:
    """What an index run needs; each index has its own threshold and period."""

    bounds: Bounds
    experiments: list[str]
    indices: list[str]
    thresholds: dict[str, float] = field(default_factory=dict)
    periods: dict[str, str] = field(default_factory=dict)

    @classmethod
    def of(cls, cfg: dict) -> IndexConfig:
        named = {k: v for k, v in cfg.items() if isinstance(v, dict) and ("threshold_mm" in v or "aggregation" in v or "aggregation_code" in v)}
        return cls(
            Bounds.of(cfg["region"]),
            list(cfg.get("experiments", {}).get("select", ["historical"])),
            list(cfg.get("run_indices") or []),
            {k: float(v["threshold_mm"]) for k, v in named.items() if "threshold_mm" in v},
            {k: v.get("aggregation_code") or period_code(v.get("aggregation", "annual")) for k, v in named.items()},
        )


@dataclass(frozen=True)
class DownloadConfig:
    """What a download or verification run needs."""

    bounds: Bounds
    models: list[str]
    experiments: list[str]
    variables: list[str]
    run: str
    grid_label_default: str
    grid_labels: dict[str, str]
    time_ranges: dict[str, tuple[int, int]]
    fallback_range: tuple[int, int] | None

    @classmethod
    def of(cls, cfg: dict) -> DownloadConfig:
        ranges = {k: (int(a), int(b)) for k, (a, b) in (cfg["experiments"].get("time_ranges") or {}).items()}
        time = cfg.get("time")
        fallback = ranges.get("historical") or ((int(time["start_year"]), int(time["end_year"])) if time else None)
        return cls(
            Bounds.of(cfg["region"]),
            list(cfg["models"]["select"]),
            list(cfg["experiments"]["select"]),
            list(cfg["variables"]["daily"]),
            cfg.get("run", "r1i1p1f1"),
            cfg.get("grid_label_default", "gn"),
            dict(cfg.get("grid_labels") or {}),
            ranges,
            fallback,
        )

    def only(self, model: str | None, experiment: str | None, variable: str | None, years: tuple[int, int] | None) -> DownloadConfig:
        """The same for one model, experiment, variable or span of years alone; None: all."""
        out = replace(
            self,
            models=[model] if model else self.models,
            experiments=[experiment] if experiment else self.experiments,
            variables=[variable] if variable else self.variables,
        )
        return out if years is None else replace(out, time_ranges={e: (years[0], years[1]) for e in out.experiments})
