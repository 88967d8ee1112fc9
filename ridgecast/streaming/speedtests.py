"""An extension: speed tests as a stream, in windows with a watermark. The batch form is ``operators.demand.speedtest_cells``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgecast.functions.formulas import quadkey, tile_xy


def windowed_cells(tests: DataFrame, zoom: int = 8, window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """(start, quadkey, tiles, tests, d_kbps) of a stream (ts, lon, lat, tests, d_kbps); rows later than ``late`` are dropped."""
    x, y = tile_xy(F.col("lon"), F.col("lat"), zoom)
    t = tests.withWatermark("ts", late).withColumn("quadkey", quadkey(x, y, zoom))
    g = t.groupBy(F.window("ts", window).alias("w"), "quadkey").agg(F.count("*").alias("tiles"), F.sum("tests").alias("tests"), (F.sum(F.col("d_kbps") * F.col("tests")) / F.sum("tests")).alias("d_kbps"))
    return g.select(F.col("w.start").alias("start"), "quadkey", "tiles", "tests", "d_kbps")
