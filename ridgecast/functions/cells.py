"""A hierarchy of planar hexagonal cells on projected metres, and the bit layout of H3 ids.

Cells are axial coordinates (q, r) of a pointy-top hexagon lattice. A parent is the 3 x 3 rhombus of cells with equal
``floor(q / 3), floor(r / 3)``: each cell has exactly one parent, so roll-ups lose nothing. These ids are not H3 ids.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFSET = 1 << 20


def cell_id(q: Column, r: Column, level: int) -> Column:
    return F.shiftleft(F.lit(level).cast("long"), 42) + F.shiftleft((q + OFFSET).cast("long"), 21) + (r + OFFSET).cast("long")


def cell_q(cell: Column) -> Column:
    return F.shiftright(cell, 21).bitwiseAND(F.lit((1 << 21) - 1)) - OFFSET


def cell_r(cell: Column) -> Column:
    return cell.bitwiseAND(F.lit((1 << 21) - 1)) - OFFSET


def point_to_axial(x: Column, y: Column, size: float) -> tuple[Column, Column]:
    """The hexagon (of corner radius ``size``) that holds a point: cube rounding."""
    q = (math.sqrt(3.0) / 3.0 * x - y / 3.0) / size
    r = (2.0 / 3.0 * y) / size
    s = -q - r
    rq, rr, rs = F.rint(q), F.rint(r), F.rint(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    worst_q = (dq > dr) & (dq > ds)
    return F.when(worst_q, -rr - rs).otherwise(rq).cast("long"), F.when(~worst_q & (dr > ds), -rq - rs).otherwise(rr).cast("long")


def centre(q: Column, r: Column, size: float) -> tuple[Column, Column]:
    return size * math.sqrt(3.0) * (q + r / 2.0), size * 1.5 * r


def parent(cell: Column, level: int, up: int) -> Column:
    k = 3**up
    return cell_id(F.floor(cell_q(cell) / k), F.floor(cell_r(cell) / k), level - up)


def disk(q: Column, r: Column, k: int) -> Column:
    """Array of (q, r) within ``k`` steps, the cell itself included."""
    steps = [(a, b) for a in range(-k, k + 1) for b in range(-k, k + 1) if abs(a + b) <= k]
    return F.array(*[F.struct((q + a).alias("q"), (r + b).alias("r")) for a, b in steps])


def boundary(q: Column, r: Column, size: float) -> Column:
    """Ring of the hexagon's six corners."""
    x, y = centre(q, r, size)
    return F.array(*[F.struct((x + size * math.sin(math.radians(60 * i))).alias("x"), (y + size * math.cos(math.radians(60 * i))).alias("y")) for i in range(6)])


def h3_resolution(h: Column) -> Column:
    return F.shiftright(h, 52).bitwiseAND(F.lit(15)).cast("int")


def h3_parent(h: Column, res: int) -> Column:
    """Set the resolution, and the digits below it to 7."""
    fill = (1 << (3 * (15 - res))) - 1
    cleared = h.bitwiseAND(F.lit(~(15 << 52)))
    return cleared.bitwiseOR(F.lit(res << 52)).bitwiseOR(F.lit(fill))


def h3_to_string(h: Column) -> Column:
    return F.lower(F.hex(h))


def h3_from_string(s: Column) -> Column:
    return F.conv(s, 16, 10).cast("long")
