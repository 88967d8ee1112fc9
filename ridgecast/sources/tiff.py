"""One-band tiled deflate TIFF: a reader (also as a Spark data source of tiles) and a writer."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 12: "d", 16: "Q"}
FORMATS = {("u", 8): "u1", ("i", 8): "i1", ("u", 16): "u2", ("i", 16): "i2", ("f", 32): "f4", ("u", 32): "u4", ("i", 32): "i4", ("f", 64): "f8"}


def write_tiff(array: np.ndarray, x_left: float, y_top: float, cell_m: float, nodata=None, epsg: int = 5070, tile: int = 512) -> bytes:
    """Bytes of a GeoTIFF with its origin at the top left."""
    rows, cols = array.shape
    kind, bits = array.dtype.kind, array.dtype.itemsize * 8
    fmt = {"u": 1, "i": 2, "f": 3}[kind]
    blocks = []
    for r in range(0, rows, tile):
        for c in range(0, cols, tile):
            t = np.zeros((tile, tile), array.dtype)
            part = array[r : r + tile, c : c + tile]
            t[: part.shape[0], : part.shape[1]] = part
            blocks.append(zlib.compress(t.astype(array.dtype.newbyteorder("<")).tobytes()))
    geo = (1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, epsg)
    tags = [
        (256, 4, (cols,)), (257, 4, (rows,)), (258, 3, (bits,)), (259, 3, (8,)), (262, 3, (1,)), (277, 3, (1,)), (322, 4, (tile,)), (323, 4, (tile,)),
        (324, 4, (0,) * len(blocks)), (325, 4, tuple(map(len, blocks))), (339, 3, (fmt,)), (33550, 12, (cell_m, cell_m, 0.0)), (33922, 12, (0.0, 0.0, 0.0, x_left, y_top, 0.0)), (34735, 3, geo),
    ]
    if nodata is not None:
        tags.append((42113, 2, (f"{nodata}\0".encode(),)))
    at = 8 + 2 + 12 * len(tags) + 4
    extra, entries = b"", []
    where = {}
    for tag, typ, values in tags:
        raw = values[0] if typ == 2 else struct.pack(f"<{len(values)}{TYPES[typ]}", *values)
        count = len(raw) if typ == 2 else len(values)
        if len(raw) > 4:
            where[tag] = len(extra)
            entries.append((tag, typ, count, at + len(extra)))
            extra += raw + b"\0" * (len(raw) % 2)
        else:
            entries.append((tag, typ, count, int.from_bytes(raw.ljust(4, b"\0"), "little")))
    starts = np.cumsum([at + len(extra), *map(len, blocks)])[:-1]
    if 324 in where:
        i = where[324]
        extra = extra[:i] + struct.pack(f"<{len(blocks)}I", *starts) + extra[i + 4 * len(blocks) :]
    else:
        entries = [(t, y, n, int(starts[0])) if t == 324 else (t, y, n, v) for t, y, n, v in entries]
    head = struct.pack("<2sHI", b"II", 42, 8) + struct.pack("<H", len(entries)) + b"".join(struct.pack("<HHII", *e) for e in entries) + b"\0" * 4
    return head + extra + b"".join(blocks)


def tiff_tags(b: bytes) -> tuple[str, dict[int, tuple]]:
    o = "<" if b[:2] == b"II" else ">"
    magic, at = struct.unpack_from(o + "HI", b, 2)
    if magic != 42:
        raise ValueError("not a classic TIFF")
    out = {}
    for i in range(struct.unpack_from(o + "H", b, at)[0]):
        tag, typ, n = struct.unpack_from(o + "HHI", b, at + 2 + 12 * i)
        if typ not in TYPES:
            continue
        f = f"{n}{TYPES[typ]}" if typ != 5 else f"{2 * n}I"
        size = struct.calcsize(o + f)
        p = at + 10 + 12 * i if size <= 4 else struct.unpack_from(o + "I", b, at + 10 + 12 * i)[0]
        out[tag] = struct.unpack_from(o + f, b, p)
    return o, out


def read_tiles(b: bytes):
    """(dtype, (x_left, y_top, cell), [(tx, ty, array)]) of a tiled file; edge tiles are cut to the raster."""
    o, t = tiff_tags(b)
    if 322 not in t:
        raise ValueError("not tiled")
    cols, rows, tw, th = t[256][0], t[257][0], t[322][0], t[323][0]
    dtype = np.dtype(FORMATS[{1: "u", 2: "i", 3: "f"}[t.get(339, (1,))[0]], t[258][0]]).newbyteorder(o)
    across = -(-cols // tw)
    tiles = []
    for k, (p, n) in enumerate(zip(t[324], t[325], strict=True)):
        raw = b[p : p + n]
        raw = zlib.decompress(raw) if t[259][0] in (8, 32946) else raw
        ty, tx = divmod(k, across)
        a = np.frombuffer(raw, dtype).reshape(th, tw)[: rows - ty * th, : cols - tx * tw]
        tiles.append((tx, ty, a.astype(dtype.newbyteorder("="))))
    return dtype, (t[33922][3], t[33922][4], t[33550][0]), tiles


def read_tiff(b: bytes) -> np.ndarray:
    _, tags = tiff_tags(b)
    out = None
    for tx, ty, a in read_tiles(b)[2]:
        out = np.zeros((tags[257][0], tags[256][0]), a.dtype) if out is None else out
        r, c = ty * tags[323][0], tx * tags[322][0]
        out[r : r + a.shape[0], c : c + a.shape[1]] = a
    return out


def read_tile_table(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """Files of ``path`` as a tile table; each file is decoded where its bytes are."""

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                for tx, ty, a in read_tiles(content.as_py())[2]:
                    yield pa.RecordBatch.from_arrays([pa.array([layer]), pa.array([tx], pa.int32()), pa.array([ty], pa.int32()), pa.array([a.shape[0]], pa.int32()), pa.array([a.shape[1]], pa.int32()), pa.array([a.tobytes()])], names=["layer", "tx", "ty", "rows", "cols", "data"])

    from ridgecast.operators.raster import TILES

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, TILES)
