"""Distance joins and areal interpolation without nested loops."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgecast.functions.polygon import area, clip_convex


def distance_join(left: DataFrame, right: DataFrame, radius: float, lxy=("x", "y"), rxy=("x", "y"), prefix: str = "r_") -> DataFrame:
    """Pairs within ``radius`` (inclusive) as an equi-join on grid cells of that width.

    ``left`` is repeated to its 3 x 3 neighbour cells, so give the smaller side first; each pair meets in exactly one
    cell. Columns of ``right`` get ``prefix``; ``distance_m`` is added.
    """
    cell = lambda c: F.floor(c / radius).cast("long")
    steps = F.array(*[F.lit(k).cast("long") for k in (-1, 0, 1)])
    a = left.withColumn("__dx", F.explode(steps)).withColumn("__dy", F.explode(steps))
    a = a.withColumn("__gx", cell(F.col(lxy[0])) + F.col("__dx")).withColumn("__gy", cell(F.col(lxy[1])) + F.col("__dy")).drop("__dx", "__dy")
    b = right.select(*[F.col(c).alias(prefix + c) for c in right.columns])
    rx, ry = prefix + rxy[0], prefix + rxy[1]
    b = b.withColumn("__gx", cell(F.col(rx))).withColumn("__gy", cell(F.col(ry)))
    dx, dy = F.col(rx) - F.col(lxy[0]), F.col(ry) - F.col(lxy[1])
    return a.join(b, ["__gx", "__gy"]).where(dx * dx + dy * dy <= radius * radius).drop("__gx", "__gy").withColumn("distance_m", F.sqrt(dx * dx + dy * dy))


def near_any(left: DataFrame, right: DataFrame, radius: float, key: str) -> DataFrame:
    """Rows of ``left`` with at least one ``right`` point within ``radius``."""
    hit = distance_join(left.select(key, "x", "y"), right.select("x", "y"), radius).select(key).distinct()
    return left.join(hit, key, "left_semi")


def weight_within(left: DataFrame, right: DataFrame, radius: float, key: str, weight: str) -> DataFrame:
    """(key, total): sum of ``weight`` over ``right`` points within ``radius`` of each ``left`` point that has any."""
    return distance_join(left.select(key, "x", "y"), right.select("x", "y", weight), radius).groupBy(key).agg(F.sum("r_" + weight).alias("total"))


def rectangle_overlap(a: DataFrame, b: DataFrame, grain: float, prefix: str = "r_") -> DataFrame:
    """Pairs of rectangles (xmin, ymin, xmax, ymax) with positive common area, via shared grid tiles of width ``grain``."""
    tiles = lambda lo, hi: F.sequence(F.floor(F.col(lo) / grain).cast("long"), F.floor(F.col(hi) / grain).cast("long"))
    x = a.withColumn("__tx", F.explode(tiles("xmin", "xmax"))).withColumn("__ty", F.explode(tiles("ymin", "ymax")))
    y = b.withColumn("__tx", F.explode(tiles("xmin", "xmax"))).withColumn("__ty", F.explode(tiles("ymin", "ymax")))
    y = y.select(*[F.col(c).alias(c if c.startswith("__") else prefix + c) for c in y.columns])
    x0, y0 = F.greatest("xmin", prefix + "xmin"), F.greatest("ymin", prefix + "ymin")
    x1, y1 = F.least("xmax", prefix + "xmax"), F.least("ymax", prefix + "ymax")
    # A pair meets in every tile that both touch; the tile of the overlap's corner counts.
    first = (F.col("__tx") == F.floor(x0 / grain)) & (F.col("__ty") == F.floor(y0 / grain))
    return x.join(y, ["__tx", "__ty"]).where((x1 > x0) & (y1 > y0) & first).withColumn("overlap_m2", (x1 - x0) * (y1 - y0)).drop("__tx", "__ty")


def polygon_overlap(a: DataFrame, b: DataFrame, grain: float, a_key: str, b_key: str) -> DataFrame:
    """(a_key, b_key, overlap_m2) of polygons ``ring`` (array of x, y) with convex ``b``: tiles by bounding box, clipping in Arrow batches."""

    def boxed(d, key, name):
        xs, ys = F.col("ring.x"), F.col("ring.y")
        return d.select(F.col(key).alias(name), F.col("ring").alias(f"{name}_ring"), F.array_min(xs).alias(f"{name}_x0"), F.array_max(xs).alias(f"{name}_x1"), F.array_min(ys).alias(f"{name}_y0"), F.array_max(ys).alias(f"{name}_y1"))

    def tiled(d, n):
        span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / grain).cast("long"), F.floor(F.col(hi) / grain).cast("long"))
        return d.withColumn("tx", F.explode(span(f"{n}_x0", f"{n}_x1"))).withColumn("ty", F.explode(span(f"{n}_y0", f"{n}_y1")))

    x, y = tiled(boxed(a, a_key, "a"), "a"), tiled(boxed(b, b_key, "b"), "b")
    first = (F.col("tx") == F.floor(F.greatest("a_x0", "b_x0") / grain)) & (F.col("ty") == F.floor(F.greatest("a_y0", "b_y0") / grain))
    meet = (F.col("a_x0") < F.col("b_x1")) & (F.col("b_x0") < F.col("a_x1")) & (F.col("a_y0") < F.col("b_y1")) & (F.col("b_y0") < F.col("a_y1"))
    pairs = x.join(y, ["tx", "ty"]).where(first & meet).select("a", "b", "a_ring", "b_ring")
    ka, kb = dict(a.dtypes)[a_key], dict(b.dtypes)[b_key]

    def clip(batches):
        for batch in batches:
            ra, rb = batch.column("a_ring").to_pylist(), batch.column("b_ring").to_pylist()
            size = [area(clip_convex([(p["x"], p["y"]) for p in s], [(p["x"], p["y"]) for p in c])) for s, c in zip(ra, rb, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(np.array(size, float))], names=[a_key, b_key, "overlap_m2"])

    return pairs.mapInArrow(clip, f"{a_key} {ka}, {b_key} {kb}, overlap_m2 double").where("overlap_m2 > 0")


def interpolate(overlaps: DataFrame, target: str, pop: Column, source_area: Column, growth: Column) -> DataFrame:
    """(target, pop, pop_grown): each source's people split by share of area, growth applied piece by piece."""
    share = pop * F.col("overlap_m2") / source_area
    return overlaps.groupBy(target).agg(F.sum(share).alias("pop"), F.sum(share * (1 + F.coalesce(growth, F.lit(0.0)))).alias("pop_grown"))
