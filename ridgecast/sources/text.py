"""Ragged delimited text, zipped registers, header-row JSON and cached downloads."""

from __future__ import annotations

import json
import os
import urllib.request
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cached(url: str, folder: str, name: str | None = None) -> Path:
    """The file of ``url`` in ``folder``: reused if not empty, else fetched to a .part file and renamed."""
    target = Path(folder) / (name or url.rsplit("/", 1)[-1])
    if target.exists() and target.stat().st_size:
        return target
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(target.name + ".part")
    with urllib.request.urlopen(url) as src, part.open("wb") as dst:  # noqa: S310
        while block := src.read(1 << 20):
            dst.write(block)
    os.replace(part, target)
    return target


def unzip(archive: str, folder: str, names: list[str]) -> list[Path]:
    with zipfile.ZipFile(archive) as z:
        return [Path(z.extract(n, folder)) for n in names]


def read_ragged(spark: SparkSession, path: str, columns: dict[str, int], delimiter: str = "|") -> DataFrame:
    """Latin-1 lines split at ``delimiter``; columns by position (free text may hold the delimiter); lines that are too short are left out."""
    parts = F.split("value", f"[{delimiter}]", -1)
    # The text source hands over raw bytes, whatever encoding is asked for.
    lines = spark.read.text(path).withColumn("value", F.decode(F.col("value").cast("binary"), "ISO-8859-1")).withColumn("p", parts)
    return lines.where(F.size("p") > max(columns.values())).select(*[F.col("p")[i].alias(c) for c, i in columns.items()])


def read_register(spark: SparkSession, archive: str, folder: str, parts: dict[str, tuple[dict[str, int], dict[str, str]]], key: str) -> DataFrame:
    """A zipped register whose files are joined on ``key``: for each file its columns by position and the values that rows must have.

    ``folder`` is one that all machines share; the archive is unpacked there.
    """
    out = None
    for path, (columns, wanted) in zip(unzip(archive, folder, list(parts)), parts.values(), strict=True):
        t = read_ragged(spark, str(path), columns)
        for column, value in wanted.items():
            t = t.where(F.col(column) == value)
        t = t.drop(*wanted)
        out = t if out is None else out.join(t, key)
    return out


def write_layer(df: DataFrame, path: str) -> None:
    """The table at ``path``, whole: what was there goes."""
    df.write.mode("overwrite").parquet(path)


def header_rows(text: str, content_type: str = "application/json") -> tuple[list[str], list[list]]:
    """A JSON answer ``[header, *rows]``; any other content type is an error message, not data."""
    if "json" not in content_type:
        raise ValueError(f"not JSON ({content_type}): {text[:200]}")
    head, *rows = json.loads(text)
    return head, rows


def read_header_json(spark: SparkSession, text: str, content_type: str = "application/json") -> DataFrame:
    head, rows = header_rows(text, content_type)
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], ", ".join(f"`{c}` string" for c in head))


def bbox_scan(df: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float, column: str = "bbox") -> DataFrame:
    """Rows whose box corner lies in the window: conditions on struct leaves, so Parquet prunes row groups."""
    return df.where(F.col(f"{column}.xmin").between(xmin, xmax) & F.col(f"{column}.ymin").between(ymin, ymax))
