"""WKB, GeoParquet and shapefiles without a geometry library."""

from __future__ import annotations

import json
import struct
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def wkb_point(x: float, y: float) -> bytes:
    return struct.pack("<BIdd", 1, 1, x, y)


def wkb_polygon(rings) -> bytes:
    return struct.pack("<BII", 1, 3, len(rings)) + b"".join(struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", *p) for p in r) for r in rings)


def read_wkb(b: bytes):
    """("point", (x, y)), ("polygon", rings) or ("multipolygon", polygons) of either byte order."""
    at = 0

    def take(fmt):
        nonlocal at
        v = struct.unpack_from(fmt, b, at)
        at += struct.calcsize(fmt)
        return v

    def geometry():
        o = "<" if take("B")[0] else ">"
        kind = take(o + "I")[0] & 0xFF
        if kind == 1:
            return "point", take(o + "dd")
        if kind == 3:
            return "polygon", [[take(o + "dd") for _ in range(take(o + "I")[0])] for _ in range(take(o + "I")[0])]
        if kind == 6:
            return "multipolygon", [geometry()[1] for _ in range(take(o + "I")[0])]
        raise ValueError(f"geometry type {kind}")

    return geometry()


def points_to_wkb(df: DataFrame, x: str = "x", y: str = "y", geom: str = "geom") -> DataFrame:
    """Adds a WKB point column, in Arrow batches."""

    def run(batches):
        for b in batches:
            g = [None if p is None or q is None else wkb_point(p, q) for p, q in zip(b.column(x).to_pylist(), b.column(y).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(g, pa.binary())], names=[*b.schema.names, geom])

    from pyspark.sql.types import BinaryType, StructField, StructType

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(geom, BinaryType())]))


def point_xy(geom: Column) -> tuple[Column, Column]:
    """x and y of a little-endian WKB point, in the JVM: IEEE bits to double by arithmetic."""

    def double(at: int) -> Column:
        hexed = F.concat(*[F.hex(F.substring(geom, at + 7 - i, 1)) for i in range(8)])
        hi, lo = F.conv(F.substring(hexed, 1, 3), 16, 10).cast("long"), F.conv(F.substring(hexed, 4, 13), 16, 10).cast("double")
        exp = hi % 2048
        value = F.when(exp == 0, lo * 2.0**-52 * F.pow(F.lit(2.0), F.lit(-1022))).otherwise((1 + lo * 2.0**-52) * F.pow(F.lit(2.0), exp - 1023))
        return F.when(hi >= 2048, -value).otherwise(value)

    return double(6), double(14)


def write_geoparquet(table: pa.Table, path: str, geom: str = "geom", kinds=("Point",), epsg: int = 5070) -> None:
    """One Parquet file with the GeoParquet footer."""
    geo = {"version": "1.0.0", "primary_column": geom, "columns": {geom: {"encoding": "WKB", "geometry_types": list(kinds), "crs": {"id": {"authority": "EPSG", "code": epsg}}}}}
    pq.write_table(table.replace_schema_metadata({**(table.schema.metadata or {}), b"geo": json.dumps(geo).encode()}), path)


def read_geoparquet(spark: SparkSession, path: str) -> DataFrame:
    """Geometry stays WKB; x and y columns, where present, are what computations use."""
    return spark.read.parquet(path)


def read_shapefile(shp: str, dbf: str) -> list[dict]:
    """Polygons and attributes of a shapefile pair: dicts with ``rings`` and the table's fields."""
    b = Path(shp).read_bytes()
    at, rings = 100, []
    while at < len(b):
        size = struct.unpack_from(">i", b, at + 4)[0] * 2
        kind = struct.unpack_from("<i", b, at + 8)[0]
        if kind == 5:
            parts, points = struct.unpack_from("<ii", b, at + 44)
            starts = [*struct.unpack_from(f"<{parts}i", b, at + 52), points]
            base = at + 52 + 4 * parts
            xy = [struct.unpack_from("<dd", b, base + 16 * i) for i in range(points)]
            rings.append([xy[s:e] for s, e in zip(starts, starts[1:], strict=False)])
        else:
            rings.append([])
        at += 8 + size
    d = Path(dbf).read_bytes()
    count, head, width = struct.unpack_from("<IHH", d, 4)
    fields, at = [], 32
    while d[at] != 13:
        fields.append((d[at : at + 11].split(b"\0")[0].decode(), d[at + 16]))
        at += 32
    rows = []
    for i in range(count):
        at, row = head + i * width + 1, {}
        for name, n in fields:
            row[name] = d[at : at + n].decode("latin-1").strip() or None
            at += n
        rows.append(row)
    return [{**r, "rings": g} for r, g in zip(rows, rings, strict=True)]
