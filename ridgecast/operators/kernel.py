"""The path-loss kernel: free space, multi-edge terrain diffraction, clutter and rooftops, vectorised over links.

Spark hands Arrow batches of links to numpy; the terrain is a broadcast object with ``sample(x, y)``. The floor on
signal strength is applied inside the kernel, for Catalyst cannot push a filter below it.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgecast.config import CLUTTER_DB, Radio
from ridgecast.functions.formulas import EARTH_M, LIGHT_M_S


@dataclass
class ArrayTerrain:
    """Rasters of one shape; (x0, y0) is the first pixel's centre, rows grow southward."""

    elevation: np.ndarray
    land: np.ndarray
    x0: float
    y0: float
    cell_m: float = 90.0
    buildings: np.ndarray | None = None

    def _rasters(self):
        return [a for a in (self.elevation, self.land, self.buildings) if a is not None]

    @property
    def nbytes(self) -> int:
        return sum(a.nbytes for a in self._rasters())

    def __post_init__(self):
        shapes = {a.shape for a in self._rasters()}
        if len(shapes) > 1:
            raise ValueError(f"rasters differ in shape: {sorted(shapes)}")

    def pixel(self, x, y):
        """Nearest pixel (half to even), clamped to the raster."""
        rows, cols = self.elevation.shape
        c = np.clip(np.rint((x - self.x0) / self.cell_m), 0, cols - 1).astype(np.int64)
        r = np.clip(np.rint((self.y0 - y) / self.cell_m), 0, rows - 1).astype(np.int64)
        return r, c

    def height(self, x, y):
        return self.elevation[self.pixel(x, y)].astype(np.float64)

    def land_class(self, x, y):
        return self.land[self.pixel(x, y)]

    def building(self, x, y):
        return np.zeros(np.shape(x)) if self.buildings is None else self.buildings[self.pixel(x, y)].astype(np.float64)


@dataclass
class FormulaTerrain:
    """Terrain given by integer formulas of row and column, so that any engine can repeat it."""

    rows: int = 4450
    cols: int = 4450
    x0: float = 45.0
    y0: float = 400_455.0
    cell_m: float = 90.0
    # Fixed values of the test terrain.
    classes: tuple = (10, 20, 30, 40, 50, 60, 80, 90)

    def pixel(self, x, y):
        c = np.clip(np.rint((x - self.x0) / self.cell_m), 0, self.cols - 1).astype(np.int32)
        r = np.clip(np.rint((self.y0 - y) / self.cell_m), 0, self.rows - 1).astype(np.int32)
        return r, c

    def height(self, x, y, straight=False):
        """200 + |(7 * column + 3 * row) mod 200 - 100|, in doubles, which hold these integers exactly."""
        t, r = np.subtract(x, self.x0), np.subtract(self.y0, y)
        for a, n in ((t, self.cols), (r, self.rows)):
            a /= self.cell_m
            np.rint(a, out=a)
            # A straight profile lies between its ends.
            ends = a[:, [0, -1]] if a.ndim == 2 and straight else a
            if ends.size and not (ends.min() >= 0 and ends.max() <= n - 1):
                np.clip(a, 0, n - 1, out=a)
        t *= 7.0
        r *= 3.0
        t += r
        np.multiply(t, 1.0 / 200.0, out=r)
        np.rint(r, out=r)
        r *= 200.0
        t -= r
        np.abs(t, out=t)
        return np.subtract(300.0, t, out=t)

    def land_class(self, x, y):
        r, c = self.pixel(x, y)
        return np.array(self.classes)[(r * 13 + c * 29) % 8]

    def building(self, x, y):
        r, c = self.pixel(x, y)
        return np.where((r * 7 + c * 11) % 17 == 0, (r + c) % 40, 0).astype(np.float64)


def profile(terrain, tx_x, tx_y, rx_x, rx_y, samples: int) -> np.ndarray:
    """Heights at ``samples`` places from each transmitter to its receiver, both included."""
    f = np.linspace(0.0, 1.0, samples)
    x, y = np.multiply.outer(rx_x - tx_x, f), np.multiply.outer(rx_y - tx_y, f)
    x += tx_x[:, None]
    y += tx_y[:, None]
    return terrain.height(x, y, straight=True) if isinstance(terrain, FormulaTerrain) else terrain.height(x, y)


def fspl(distance_m, freq_mhz):
    return 20 * np.log10(np.maximum(distance_m, 1.0) / 1000.0) + 20 * np.log10(freq_mhz) + 32.44


def knife_edge(v):
    """Loss of a knife edge; none for v up to -0.78, and none where there is no edge (-inf)."""
    v = np.asarray(v, float)
    w = np.where(v > -0.78, v, 0.0) - 0.1
    return np.where(v > -0.78, np.maximum(0.0, 6.9 + 20 * np.log10(np.sqrt(w * w + 1.0) + w)), 0.0)


def building_loss(height_m, radio: Radio):
    height_m = np.asarray(height_m, float)
    v = (height_m - radio.rx_height_m) * np.sqrt(2.0 / (LIGHT_M_S / (radio.freq_mhz * 1e6) * radio.setback_m))
    return np.where(height_m > radio.rx_height_m, np.minimum(knife_edge(v), radio.building_cap_db), 0.0)


def _bare(weights):
    """``weights`` without those of the ends and of samples at the edge itself, which are not finite."""
    return np.where(np.isfinite(weights), weights, 0.0)


@functools.cache
def _shares(n: int):
    """Of ``n`` samples, at shares f of the way: f and f * f, the weight of each sample on the whole way, and on its side of each edge.

    With ``rise`` over a ray and ``s = sqrt(2 / (wavelength * length))``, v is ``rise * s * weight``; a sample that may not count weighs zero.
    """
    f = np.linspace(0.0, 1.0, n)
    p, i = f[:, None], f[None, :]
    inner = (i > 0.0) & (i < 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        whole = _bare(1.0 / np.sqrt(f * (1.0 - f)))
        left = np.where(inner & (i < p), _bare(np.sqrt(p / (i * (p - i)))), 0.0)
        right = np.where(inner & (i > p), _bare(np.sqrt((1.0 - p) / ((i - p) * (1.0 - i)))), 0.0)
    return f, f * f, whole, left, right


def _over(bent, f, a, b):
    """How far bent profiles rise above lines of ``a + b * f``."""
    # No matrix product: its library would start threads beside those of the tasks.
    rise = np.multiply.outer(b, f)
    rise += a[:, None]
    return np.subtract(bent, rise, out=rise)


def _top(v):
    """Of each row, the place of its largest value (the first) and the value."""
    at = v.argmax(axis=1)  # quicker than max
    return at, v[np.arange(len(v)), at]


def edges(elev, length, z_tx, z_rx, freq_mhz, k, most=None):
    """Deygout's construction: v of the worst edge, and of the worst on either side of it; 0 where there is none.

    A profile is bent by the earth's curve once, after which every ray is a straight line ``a + b * f``. Sides of edges above ``most`` are not looked at.
    """
    f, square, whole, left, right = _shares(elev.shape[1])
    curve = length * length / (2.0 * k * EARTH_M)
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.sqrt(2.0 * freq_mhz * 1e6 / (LIGHT_M_S * length))
    bent = np.multiply.outer(curve, square)
    np.subtract(elev, bent, out=bent)
    if not np.isfinite(bent.sum()):
        bent[~np.isfinite(bent)] = -1e30  # unknown ground is no edge
    v = _over(bent, f, z_tx, z_rx - z_tx - curve)
    v *= whole
    at, top = _top(v)
    blocked = (top > 0.0) & np.isfinite(scale)
    out = np.zeros((3, len(top)))
    np.multiply(top, scale, out=out[0], where=blocked)
    go = np.flatnonzero(blocked if most is None else blocked & ~(out[0] > most))
    if len(go):
        if len(go) < len(at):
            bent, at, curve, scale, z_tx, z_rx = bent[go], at[go], curve[go], scale[go], z_tx[go], z_rx[go]
        p = f[at]
        zp = bent[np.arange(len(at)), at] + curve * p * p
        slope = (z_rx - zp) / (1.0 - p)
        for o, a, b, weight in ((out[1], z_tx, (zp - z_tx) / p - curve * p, left), (out[2], zp - slope * p + curve * p, slope - curve * (1.0 + p), right)):
            v = _over(bent, f, a, b)
            v *= weight[at]
            o[go] = np.maximum(_top(v)[1], 0.0) * scale
    return out


def edge_loss(v):
    return np.where(v > 0.0, knife_edge(v), 0.0)


def diffraction(elev, length, z_tx, z_rx, freq_mhz, k):
    """The loss of the worst edge and of those on either side of it. (loss, blocked)"""
    v = edges(elev, length, z_tx, z_rx, freq_mhz, k)
    return edge_loss(v).sum(axis=0), v[0] > 0.0


@functools.cache
def _clutter_table():
    table = np.zeros(256)
    for k, v in CLUTTER_DB.items():
        table[k] = v
    return table


def clutter(terrain, x, y, radio: Radio = Radio()) -> np.ndarray:
    """What land cover or buildings at receivers take, in dB."""
    return np.maximum(_clutter_table()[terrain.land_class(x, y)], building_loss(terrain.building(x, y), radio))


def link_budget(terrain, tx_x, tx_y, tx_h, rx_x, rx_y, radio: Radio = Radio(), floor_dbm: float = -np.inf, step: int = 400) -> dict[str, np.ndarray]:
    """Signal and losses of links, by slices of ``step`` profiles, which stay in cache. Below ``floor_dbm`` the losses of a link may lack some, so that its signal is only known to be below."""
    tx_x, tx_y, tx_h, rx_x, rx_y = (np.asarray(a, float) for a in (tx_x, tx_y, tx_h, rx_x, rx_y))
    dx, dy = rx_x - tx_x, rx_y - tx_y
    length = np.sqrt(dx * dx + dy * dy)
    clutter_db = clutter(terrain, rx_x, rx_y, radio)
    free = fspl(length, radio.freq_mhz)
    bare = radio.eirp_dbm - 10 * np.log10(radio.subcarriers) - free
    v = np.zeros((3, len(length)))
    # Every loss found only lowers a signal: profiles, and the sides of an edge, are for links that are not below the floor already.
    spare = bare - clutter_db - radio.shadow_margin_db - floor_dbm
    live = np.flatnonzero(~(spare < 0.0))
    with np.errstate(over="ignore"):
        most = np.sinh((spare + 1e-6 - 6.9) * (math.log(10.0) / 20.0)) + 0.1
    for first in range(0, len(live), step):
        on = live[first : first + step]
        elev = profile(terrain, tx_x[on], tx_y[on], rx_x[on], rx_y[on], radio.samples)
        v[:, on] = edges(elev, length[on], elev[:, 0] + tx_h[on], elev[:, -1] + radio.rx_height_m, radio.freq_mhz, radio.k_factor, most[on])
    loss = edge_loss(v[0]) + (edge_loss(v[1]) + edge_loss(v[2]))
    return {
        "rsrp_dbm": bare - loss - clutter_db - radio.shadow_margin_db,
        "path_loss_db": free + loss + clutter_db,
        "diffraction_db": loss,
        "clutter_db": clutter_db,
        "distance_m": length,
        "is_los": v[0] <= 0.0,
    }


def shared(spark, terrain, most_bytes: int = 4 << 30):
    """``terrain`` as a broadcast object, if it is not too large for one."""
    if getattr(terrain, "nbytes", 0) > most_bytes:
        raise ValueError(f"a terrain of {terrain.nbytes} bytes is too large to broadcast: cut it by region")
    return spark.sparkContext.broadcast(terrain)


def links(pairs: DataFrame, terrain, tx: str, rx: str, radio: Radio = Radio(), floor_dbm: float | None = None, step: int = 4096, most_bytes: int = 4 << 30) -> DataFrame:
    """Links of pairs (tx, rx, tx_x, tx_y, tx_height_m, rx_x, rx_y): ids, signal and losses, at ``floor_dbm`` or more."""
    given = shared(pairs.sparkSession, terrain, most_bytes)
    kinds = dict(pairs.dtypes)
    floor_dbm = radio.keep_floor_dbm if floor_dbm is None else floor_dbm
    names = ["rsrp_dbm", "path_loss_db", "diffraction_db", "clutter_db", "distance_m", "is_los"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                b = batch.slice(at, step)
                got = link_budget(given.value, *(b.column(c).to_numpy() for c in ("tx_x", "tx_y", "tx_height_m", "rx_x", "rx_y")), radio=radio, floor_dbm=floor_dbm)
                keep = np.flatnonzero(got["rsrp_dbm"] >= floor_dbm)
                t = b.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([t.column(tx), t.column(rx), *(pa.array(got[n][keep]) for n in names)], names=[tx, rx, *names])

    # Pairs lie where towers are dense; spread them before the costly part.
    spread = pairs.select(tx, rx, "tx_x", "tx_y", F.col("tx_height_m").cast("double").alias("tx_height_m"), "rx_x", "rx_y").repartition(F.xxhash64(tx, rx))
    return spread.mapInArrow(run, f"{tx} {kinds[tx]}, {rx} {kinds[rx]}, rsrp_dbm double, path_loss_db double, diffraction_db double, clutter_db double, distance_m double, is_los boolean")
