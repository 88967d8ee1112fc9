"""Points against rings, as Column expressions; convex clipping in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def contains(ring: list[tuple[float, float]], x: Column, y: Column) -> Column:
    """Ray casting: an odd number of edges crosses the ray to the right."""
    crossings = F.lit(0)
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
        if y0 == y1:
            continue
        crosses = ((F.lit(y0) > y) != (F.lit(y1) > y)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
        crossings = crossings + crosses.cast("int")
    return crossings % 2 == 1


def distance(ring: list[tuple[float, float]], x: Column, y: Column) -> Column:
    """Distance to the polygon: 0 inside, else to the nearest edge."""
    best = []
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
        dx, dy = x1 - x0, y1 - y0
        t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((x - x0) * dx + (y - y0) * dy) / (dx * dx + dy * dy)))
        best.append(F.hypot(x - (x0 + t * dx), y - (y0 + t * dy)))
    return F.when(contains(ring, x, y), 0.0).otherwise(F.least(*best))


def box_distance(x: Column, y: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Distance to a rectangle: 0 inside."""
    away = lambda v, lo, hi: F.greatest(lo - v, v - hi, F.lit(0.0))
    return F.hypot(away(x, xmin, xmax), away(y, ymin, ymax))


def densify(ring: list[tuple[float, float]], step: float) -> list[tuple[float, float]]:
    """Points along every edge, at most ``step`` apart, corners kept."""
    out = []
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
        n = max(1, int(np.ceil(max(abs(x1 - x0), abs(y1 - y0)) / step)))
        out += [(x0 + (x1 - x0) * i / n, y0 + (y1 - y0) * i / n) for i in range(n)]
    return out


def area(ring) -> float:
    p = np.asarray(ring, float)
    if len(p) < 3:
        return 0.0
    x, y = p[:, 0], p[:, 1]
    return float(abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2)


def clip_convex(subject, clip) -> list[tuple[float, float]]:
    """Sutherland-Hodgman: ``subject`` cut by a convex counter-clockwise ``clip``."""
    out = [tuple(p) for p in subject]
    for (ax, ay), (bx, by) in zip(clip, [*clip[1:], clip[0]], strict=True):
        side = lambda p: (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)  # noqa: B023, E731
        points, out = out, []
        for p, q in zip(points, points[1:] + points[:1], strict=True):
            sp, sq = side(p), side(q)
            if sp >= 0:
                out.append(p)
            if (sp > 0 > sq) or (sp < 0 < sq):
                t = sp / (sp - sq)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        if not out:
            break
    return out
