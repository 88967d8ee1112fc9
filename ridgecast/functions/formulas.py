"""Scalar formulas as Column builders: everything stays in the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridgecast.config import CLUTTER_DB, Radio

LIGHT_M_S = 299_792_458.0
EARTH_M = 6_371_000.0


def fspl_db(distance_m: Column, freq_mhz: float) -> Column:
    return 20 * F.log10(F.greatest(distance_m, F.lit(1.0)) / 1000.0) + 20 * math.log10(freq_mhz) + 32.44


def knife_edge_db(v: Column) -> Column:
    w = v - 0.1
    return F.when(v > -0.78, F.greatest(F.lit(0.0), 6.9 + 20 * F.log10(F.sqrt(w * w + 1.0) + w))).otherwise(0.0)


def building_db(height_m: Column, radio: Radio = Radio()) -> Column:
    """A rooftop as a knife edge ``setback_m`` before the receiver; nothing where it does not rise above it."""
    wavelength = LIGHT_M_S / (radio.freq_mhz * 1e6)
    v = (height_m - radio.rx_height_m) * math.sqrt(2.0 / (wavelength * radio.setback_m))
    return F.when(height_m > radio.rx_height_m, F.least(knife_edge_db(v), F.lit(radio.building_cap_db))).otherwise(0.0)


def clutter_db(land_class: Column) -> Column:
    table = F.create_map(*[F.lit(x) for k, v in CLUTTER_DB.items() for x in (k, v)])
    return F.coalesce(F.try_element_at(table, land_class.cast("int")), F.lit(0.0))


def dms_to_degrees(d: Column, m: Column, s: Column, hemisphere: Column, negative: str) -> Column:
    deg = d + m / 60.0 + s / 3600.0
    return F.when(hemisphere == negative, -deg).otherwise(deg)


def blank_to_double(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit("")).try_cast("double")


# Ellipsoidal Albers equal-area conic (Snyder, USGS PP 1395): GRS80 and the parameters of EPSG:5070.
A, F_INV = 6378137.0, 298.257222101
E2 = 2 / F_INV - 1 / F_INV**2
E1 = math.sqrt(E2)


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - E2 * math.sin(phi) ** 2)


def _q(phi: float) -> float:
    s = math.sin(phi)
    return (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - E1 * s) / (1 + E1 * s)) / (2 * E1))


PHI0, PHI1, PHI2, LAM0 = (math.radians(x) for x in (23.0, 29.5, 45.5, -96.0))
CONE = (_m(PHI1) ** 2 - _m(PHI2) ** 2) / (_q(PHI2) - _q(PHI1))
CONST = _m(PHI1) ** 2 + CONE * _q(PHI1)
RHO0 = A * math.sqrt(CONST - CONE * _q(PHI0)) / CONE


def albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to EPSG:5070 metres."""
    s = F.sin(F.radians(lat))
    q = (1 - E2) * (s / (1 - E2 * s * s) - F.log((1 - E1 * s) / (1 + E1 * s)) / (2 * E1))
    rho = A * F.sqrt(CONST - CONE * q) / CONE
    theta = CONE * (F.radians(lon) - LAM0)
    return rho * F.sin(theta), RHO0 - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column, rounds: int = 8) -> tuple[Column, Column]:
    """EPSG:5070 metres to degrees (lon, lat)."""
    down = RHO0 - y
    rho = F.sqrt(x * x + down * down)
    q = (CONST - (rho * CONE / A) * (rho * CONE / A)) / CONE

    def step(phi, _):
        s = F.sin(phi)
        t = 1 - E2 * s * s
        return phi + t * t / (2 * F.cos(phi)) * (q / (1 - E2) - s / t + F.log((1 - E1 * s) / (1 + E1 * s)) / (2 * E1))

    # A fold over the rounds: written out, the expression would double with each.
    phi = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.asin(q / 2), step)
    return F.degrees(LAM0 + F.atan2(x, down) / CONE), F.degrees(phi)


def tile_xy(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Web-Mercator tile of a point; y grows southward, both clamped to the grid."""
    n = 1 << zoom
    x = F.floor((lon + 180.0) / 360.0 * n)
    y = F.floor((1 - F.asinh(F.tan(F.radians(lat))) / math.pi) / 2 * n)
    clamp = lambda v: F.least(F.lit(n - 1), F.greatest(F.lit(0), v)).cast("long")
    return clamp(x), clamp(y)


def quadkey(x: Column, y: Column, zoom: int) -> Column:
    """Base-4 digits from the most significant bit: x's bit plus twice y's."""
    bit = lambda v, i: F.shiftright(v, i).bitwiseAND(F.lit(1))
    return F.concat(*[(bit(x, i) + 2 * bit(y, i)).cast("string") for i in range(zoom - 1, -1, -1)])


def service_band(rsrp: Column, servers: Column) -> Column:
    return F.when(rsrp.isNull() & (servers < 1), "no_link").when(servers < 1, "gap").when(servers == 1, "single").when(servers <= 4, "multi").otherwise("over")


def snap_bounds(xmin: Column, ymin: Column, xmax: Column, ymax: Column, cell: float = 90.0) -> dict[str, Column]:
    """Bounds snapped outward to the lattice, and the raster's size."""
    lo, hi = (lambda v: F.floor(v / cell) * cell), (lambda v: F.ceil(v / cell) * cell)
    x0, y0, x1, y1 = lo(xmin), lo(ymin), hi(xmax), hi(ymax)
    return {"x0": x0, "y0": y0, "x1": x1, "y1": y1, "width": F.round((x1 - x0) / cell).cast("long"), "height": F.round((y1 - y0) / cell).cast("long")}
