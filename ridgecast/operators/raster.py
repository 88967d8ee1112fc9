"""Rasters as tile tables: (layer, tx, ty, rows, cols, data), data being row-major bytes of one type.

Tile work is numpy in Arrow batches; per-pixel relations use ``pixels``. Only combinable partial statistics cross a tile edge.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TILE = 512
TILES = "layer string, tx int, ty int, rows int, cols int, data binary"


def tiles_of(spark: SparkSession, layer: str, rows: int, cols: int, value, dtype: str, tile: int = TILE) -> DataFrame:
    """Tiles of a raster given by ``value(row, col)``, a numpy function: made where they are used, not on the driver."""
    across, down = -(-cols // tile), -(-rows // tile)

    def run(batches):
        for batch in batches:
            out = []
            for k in batch.column("id").to_pylist():
                ty, tx = divmod(k, across)
                r, c = np.arange(ty * tile, min(rows, (ty + 1) * tile)), np.arange(tx * tile, min(cols, (tx + 1) * tile))
                data = np.ascontiguousarray(value(r[:, None], c[None, :]).astype(dtype))
                out.append((layer, tx, ty, len(r), len(c), data.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["layer", "tx", "ty", "rows", "cols", "data"])

    return spark.range(across * down).mapInArrow(run, TILES)


def map_algebra(tiles: DataFrame, dtype: str, function, out_dtype: str, layer: str) -> DataFrame:
    """``function`` of every tile's array, as tiles of ``layer``."""

    def run(batches):
        for batch in batches:
            shape = zip(batch.column("rows").to_pylist(), batch.column("cols").to_pylist(), batch.column("data"), strict=True)
            data = [np.ascontiguousarray(function(np.frombuffer(d.as_buffer(), dtype).reshape(r, c)).astype(out_dtype)).tobytes() for r, c, d in shape]
            yield pa.RecordBatch.from_arrays([pa.array([layer] * batch.num_rows), *(batch.column(n) for n in ("tx", "ty", "rows", "cols")), pa.array(data, pa.binary())], names=["layer", "tx", "ty", "rows", "cols", "data"])

    return tiles.mapInArrow(run, TILES)


def to_int16(tiles: DataFrame, dtype: str, layer: str, nodata: float | None = None) -> DataFrame:
    """Tiles of whole numbers: gaps (NaN or ``nodata``) become 0, all else is rounded half to even and clipped to 16 bits."""

    def fill(a):
        gap = np.isnan(a) if nodata is None else np.isnan(a) | (a == nodata)
        return np.clip(np.rint(np.where(gap, 0.0, a)), -32768, 32767)

    return map_algebra(tiles, dtype, fill, "int16", layer)


def pixels(tiles: DataFrame, dtype: str, sql_type: str, tile: int = TILE) -> DataFrame:
    """(row, col, value) of every pixel."""

    def run(batches):
        for batch in batches:
            for tx, ty, r, c, d in zip(*(batch.column(n).to_pylist() for n in ("tx", "ty", "rows", "cols")), batch.column("data"), strict=True):
                row, col = np.divmod(np.arange(r * c, dtype=np.int64), c)
                yield pa.RecordBatch.from_arrays([pa.array(row + ty * tile), pa.array(col + tx * tile), pa.array(np.frombuffer(d.as_buffer(), dtype))], names=["row", "col", "value"])

    return tiles.mapInArrow(run, f"row long, col long, value {sql_type}")


def zonal(tiles: DataFrame, zones: DataFrame, key: str, dtype: str, x0: float, y0: float, cell_m: float, tile: int = TILE) -> DataFrame:
    """(key, sum, n, min, max) of pixels whose centre lies in a rectangular zone (key, xmin, ymin, xmax, ymax; lower edges belong to it).

    Zones meet only the tiles that they touch; each pair gives one partial row, then partials are combined.
    """
    kind = dict(zones.dtypes)[key]
    side = tile * cell_m
    left, top = x0 - cell_m / 2, y0 + cell_m / 2
    index = lambda lo, hi: F.sequence(F.floor(lo / side).cast("int"), F.floor(hi / side).cast("int"))
    z = zones.select(key, "xmin", "ymin", "xmax", "ymax")
    z = z.withColumn("tx", F.explode(index(F.col("xmin") - left, F.col("xmax") - left))).withColumn("ty", F.explode(index(top - F.col("ymax"), top - F.col("ymin"))))
    met = z.join(tiles, ["tx", "ty"])

    def run(batches):
        for batch in batches:
            out = []
            cols = ("tx", "ty", "rows", "cols", "xmin", "ymin", "xmax", "ymax")
            for k, tx, ty, r, c, a, b, p, q, d in zip(batch.column(key).to_pylist(), *(batch.column(n).to_pylist() for n in cols), batch.column("data"), strict=True):
                xs = x0 + (np.arange(c) + tx * tile) * cell_m
                ys = y0 - (np.arange(r) + ty * tile) * cell_m
                v = np.frombuffer(d.as_buffer(), dtype).reshape(r, c)[np.ix_((ys >= b) & (ys < q), (xs >= a) & (xs < p))]
                if v.size:
                    out.append((k, float(v.sum(dtype=np.float64)), v.size, float(v.min()), float(v.max())))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.column(key).type), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.float64())], names=[key, "sum", "n", "min", "max"])

    part = met.mapInArrow(run, f"{key} {kind}, sum double, n long, min double, max double")
    return part.groupBy(key).agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"))


def pixel_of(x: Column, y: Column, x0: float, y0: float, rows: int, cols: int, cell_m: float = 90.0) -> tuple[Column, Column]:
    """Nearest pixel (row, col), half to even, clamped."""
    clamp = lambda v, n: F.least(F.lit(n - 1), F.greatest(F.lit(0), F.rint(v))).cast("long")
    return clamp((y0 - y) / cell_m, rows), clamp((x - x0) / cell_m, cols)


def pixel_centres(spark: SparkSession, rows: int, cols: int, x_left: float, y_top: float, cell_m: float) -> DataFrame:
    """(pix, row, col, x, y): id is row * cols + col, centres at +0.5."""
    p = spark.range(rows * cols).select(F.col("id").alias("pix"), F.expr(f"id div {cols}").alias("row"), F.expr(f"id % {cols}").alias("col"))
    return p.withColumn("x", x_left + (F.col("col") + 0.5) * cell_m).withColumn("y", y_top - (F.col("row") + 0.5) * cell_m)


def burn_heights(buildings: DataFrame, x_left: float, y_top: float, cell_m: float, default_m: float = 5.0, cap: int = 250) -> DataFrame:
    """(row, col, height): per pixel the tallest building of (x, y, height), rounded half to even and capped."""
    h = F.least(F.rint(F.coalesce(F.nanvl("height", F.lit(None).cast("double")), F.lit(default_m))), F.lit(float(cap))).cast("int")
    return buildings.groupBy(F.floor((y_top - F.col("y")) / cell_m).alias("row"), F.floor((F.col("x") - x_left) / cell_m).alias("col")).agg(F.max(h).alias("height"))


def degree_tiles(bounds: DataFrame, step: int) -> DataFrame:
    """(key, name): names of the ``step``-degree tiles (south-west corners) that a box (key, west, south, east, north) touches."""
    lo = lambda c: F.floor(F.col(c) / step).cast("int")
    hi = lambda c: (F.ceil(F.col(c) / step) - 1).cast("int")
    t = bounds.withColumn("lat", F.explode(F.sequence(lo("south"), F.greatest(hi("north"), lo("south"))))).withColumn("lon", F.explode(F.sequence(lo("west"), F.greatest(hi("east"), lo("west")))))
    lat, lon = F.col("lat") * step, F.col("lon") * step
    ns, ew = F.when(lat >= 0, "N").otherwise("S"), F.when(lon >= 0, "E").otherwise("W")
    return t.select("key", F.concat(ns, F.lpad(F.abs(lat).cast("string"), 2, "0"), ew, F.lpad(F.abs(lon).cast("string"), 3, "0")).alias("name"))


def mosaic(layers: list[np.ndarray], nodata) -> np.ndarray:
    """Later arrays over earlier ones wherever they are valid."""
    if not layers:
        raise ValueError("no tile to mosaic")
    out = layers[0].copy()
    for a in layers[1:]:
        out = np.where(a != nodata, a, out)
    return out


def warp(source: np.ndarray, to_row, to_col, method: str = "bilinear", nodata: float = np.nan) -> np.ndarray:
    """Resample ``source`` at fractional (row, col) arrays: bilinear for heights, nearest, or mode of the 3 x 3 pixels for classes."""
    rows, cols = source.shape
    inside = (to_row >= -0.5) & (to_row <= rows - 0.5) & (to_col >= -0.5) & (to_col <= cols - 0.5)
    if method == "bilinear":
        r, c = np.clip(to_row, 0, rows - 1), np.clip(to_col, 0, cols - 1)
        r0, c0 = np.floor(r).astype(int), np.floor(c).astype(int)
        r1, c1 = np.minimum(r0 + 1, rows - 1), np.minimum(c0 + 1, cols - 1)
        a, b = r - r0, c - c0
        v = (source[r0, c0] * (1 - a) * (1 - b) + source[r0, c1] * (1 - a) * b + source[r1, c0] * a * (1 - b) + source[r1, c1] * a * b).astype(float)
    else:
        r, c = np.clip(np.rint(to_row), 0, rows - 1).astype(int), np.clip(np.rint(to_col), 0, cols - 1).astype(int)
        if method == "nearest":
            v = source[r, c].astype(float)
        else:
            near = np.stack([source[np.clip(r + i, 0, rows - 1), np.clip(c + j, 0, cols - 1)] for i in (-1, 0, 1) for j in (-1, 0, 1)])
            votes = (near[:, None] == near[None]).sum(axis=0)
            v = np.take_along_axis(near, votes.argmax(axis=0)[None], 0)[0].astype(float)
    return np.where(inside, v, nodata)
