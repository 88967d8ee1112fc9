"""Publishing: packed footprints with an offset index, GeoJSON lines, gazetteer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A record of the published format, little-endian cell, signal, diffraction and clutter in whole dB, line of sight.
RECORD = np.dtype([("cell", "<u8"), ("rsrp", "i1"), ("diff", "u1"), ("clut", "u1"), ("los", "u1")])


def pack(cell, rsrp, diff, clut, los) -> bytes:
    """Whole dB, half to even, clipped to a byte; never wrapped."""
    rec = np.empty(len(cell), RECORD)
    rec["cell"] = np.asarray(cell, "uint64")
    for name, v, lo, hi in (("rsrp", rsrp, -128, 127), ("diff", diff, 0, 255), ("clut", clut, 0, 255)):
        rec[name] = np.clip(np.rint(np.asarray(v, float)), lo, hi)
    rec["los"] = np.asarray(los, "uint8")
    return rec.tobytes()


def records(blob: bytes, rows: slice = slice(None)) -> np.ndarray:
    """The records of a blob of whole records, or a run of them, without a copy."""
    width = RECORD.itemsize
    first, last, _ = rows.indices(len(blob) // width)
    return np.ndarray(max(0, last - first), RECORD, memoryview(blob)[first * width : last * width].tobytes())


def footprint_blobs(links: DataFrame, tx: str, rx: str) -> DataFrame:
    """(tx, n, blob): each transmitter's records, strongest first (ties: smaller cell). A transmitter's links are bounded by its range."""
    kind = dict(links.dtypes)[tx]

    def run(t: pa.Table) -> pa.Table:
        p = [t.column(c).to_numpy() for c in (rx, "rsrp_dbm", "diffraction_db", "clutter_db", "is_los")]
        order = np.lexsort((p[0], -p[1]))
        blob = pack(*(c[order] for c in p))
        return pa.table({tx: t.column(tx).slice(0, 1), "n": pa.array([len(order)], pa.int64()), "blob": pa.array([blob], pa.binary())})

    return links.select(tx, rx, "rsrp_dbm", "diffraction_db", "clutter_db", "is_los").groupBy(tx).applyInArrow(run, f"{tx} {kind}, n long, blob binary")


def unpacked(blobs: DataFrame, tx: str) -> DataFrame:
    """(tx, place, cell_id, rsrp, diff, clut, los): the records of every blob in their order."""
    kind = dict(blobs.dtypes)[tx]

    def run(batches):
        for batch in batches:
            for t, blob in zip(batch.column(tx).to_pylist(), batch.column("blob"), strict=True):
                r = records(blob.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * len(r), batch.column(tx).type), pa.array(np.arange(len(r))), pa.array(r["cell"].astype(np.int64)), *(pa.array(r[c].astype(np.int64)) for c in ("rsrp", "diff", "clut")), pa.array(r["los"] > 0)],
                    names=[tx, "place", "cell_id", "rsrp", "diff", "clut", "los"],
                )

    return blobs.select(tx, "blob").mapInArrow(run, f"{tx} {kind}, place long, cell_id long, rsrp long, diff long, clut long, los boolean")


def footprint_index(links: DataFrame, coverage: DataFrame, tx: str, rx: str, threshold: float) -> DataFrame:
    """(tx, offset, n, n_served, pop_served): byte offsets of transmitters' records in id order.

    The running sum is one window over a row per transmitter; links are counted before it.
    """
    served = F.col("rsrp_dbm") >= threshold
    pop = F.coalesce("pop", F.lit(0.0))
    per = links.join(coverage.select(rx, "pop"), rx, "left").groupBy(tx).agg(F.count("*").alias("n"), F.count_if(served).alias("n_served"), F.rint(F.sum(F.when(served, pop).otherwise(0.0))).cast("long").alias("pop_served"))
    return offsets(per, tx)


def offsets(per: DataFrame, tx: str) -> DataFrame:
    """(tx, offset, n, n_served, pop_served) of a row per transmitter."""
    before = F.sum("n").over(Window.orderBy(tx).rowsBetween(Window.unboundedPreceding, -1))
    return per.select(tx, (F.coalesce(before, F.lit(0)) * RECORD.itemsize).alias("offset"), "n", "n_served", "pop_served")


def geojson(features: DataFrame, geometry: Column, properties: list[str]) -> DataFrame:
    """(value): a GeoJSON feature per row; null and NaN properties are left out."""
    kinds = dict(features.dtypes)
    clean = [F.when(~F.isnan(c), F.col(c)).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in properties]
    return features.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*clean).alias("properties"))).alias("value"))


def point(lon: str, lat: str) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def gazetteer(places: DataFrame, name: str, x: str, y: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Places in the box (inclusive), by name; an empty result is an error of the inputs, checked by the caller with ``require_rows``."""
    return places.where(F.col(x).between(box[0], box[2]) & F.col(y).between(box[1], box[3])).orderBy(name, x, y)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df
