"""Parameters of a run, from defaults or a YAML file."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from pathlib import Path

# Path loss by land-cover class, in dB; classes not listed lose nothing.
CLUTTER_DB = {10: 12.0, 20: 5.0, 30: 0.0, 40: 0.0, 50: 15.0, 60: 0.0, 70: 0.0, 80: 0.0, 90: 2.0, 95: 2.0, 100: 0.0}


@dataclass(frozen=True)
class Radio:
    freq_mhz: float = 700.0
    eirp_dbm: float = 60.0
    subcarriers: int = 600
    rx_height_m: float = 1.5
    default_tx_height_m: float = 45.0
    shadow_margin_db: float = 8.0
    threshold_dbm: float = -105.0
    keep_floor_dbm: float = -125.0
    max_link_m: float = 40_000.0
    samples: int = 128
    k_factor: float = 1.333
    setback_m: float = 15.0
    building_cap_db: float = 30.0
    default_building_m: float = 5.0


@dataclass(frozen=True)
class Siting:
    sites: int = 20
    colocation_radius_m: float = 15_000.0
    max_candidates: int = 800
    candidate_height_m: float = 60.0


@dataclass(frozen=True)
class Gate:
    min_towers: int = 100
    max_null_fraction: float = 0.0
    min_receivers: int = 50_000
    max_rsrp_dbm: float = -30.0
    min_rsrp_dbm: float = -200.0


@dataclass(frozen=True)
class Config:
    radio: Radio = field(default_factory=Radio)
    siting: Siting = field(default_factory=Siting)
    gate: Gate = field(default_factory=Gate)
    tourism_weight: float = 1000.0
    k_ring: int = 2
    cell_m: float = 90.0
    scope: str = field(default_factory=lambda: os.environ.get("SCOPE", "state"))


def load(path: str | Path | None = None) -> Config:
    """Defaults, overridden by the sections radio, siting, gate and top-level keys of a YAML file."""
    if path is None:
        return Config()
    import yaml

    raw = yaml.safe_load(Path(path).read_text()) or {}
    parts = {"radio": Radio, "siting": Siting, "gate": Gate}
    made = {k: cls(**raw.get(k, {})) for k, cls in parts.items()}
    rest = {f.name for f in fields(Config)} - set(parts)
    return Config(**made, **{k: v for k, v in raw.items() if k in rest})


def reader_path(uri: str) -> str:
    """The path under which a raster library opens an object: ``s3a://`` becomes its virtual file system, all else stays."""
    return "/vsis3/" + uri.removeprefix("s3a://") if uri.startswith("s3a://") else uri


def layer_path(layer: str, *parts: str, root: str | None = None) -> str:
    """Where a table of a layer lives: under ``root``, by default the environment's DATA_ROOT or ./data."""
    return "/".join([(root or os.environ.get("DATA_ROOT", "data")).rstrip("/"), layer, *parts])
