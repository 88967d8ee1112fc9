"""Demand: population growth, points of interest over a k-ring, and their sum; speed-test validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgecast.functions.cells import cell_id, disk, point_to_axial
from ridgecast.functions.formulas import quadkey, tile_xy


def growth(vintages: DataFrame, key: str, old: int, new: int) -> DataFrame:
    """(key, growth): relative change between two vintages that both exist; 0 where the old one is 0."""
    at = lambda v, name: vintages.where(F.col("vintage") == v).select(key, F.col("pop").alias(name))
    return at(old, "pop_old").join(at(new, "pop_new"), key).select(key, F.when(F.col("pop_old") > 0, (F.col("pop_new") - F.col("pop_old")) / F.col("pop_old")).otherwise(0.0).alias("growth"))


def poi_scores(places: DataFrame, weights: dict[str, float], size: float, k: int = 2, level: int = 8) -> DataFrame:
    """(cell, poi_score): each place gives its full weight to every cell within ``k`` steps. Cells are partially summed before the shuffle."""
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    q, r = point_to_axial(F.col("x"), F.col("y"), size)
    p = places.where(F.col("category").isin(*weights)).select(F.element_at(table, F.col("category")).alias("w"), q.alias("q"), r.alias("r"))
    spread = p.select("w", F.explode(disk(F.col("q"), F.col("r"), k)).alias("c"))
    return spread.groupBy(cell_id(F.col("c.q"), F.col("c.r"), level).alias("cell")).agg(F.sum("w").alias("poi_score"))


def category_counts(places: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(category, places) for every configured category; raises if one matches nothing."""
    names = places.sparkSession.createDataFrame([(c,) for c in weights], "category string")
    out = names.join(F.broadcast(names).join(places, "category").groupBy("category").agg(F.count("*").alias("places")), "category", "left").fillna(0, ["places"])
    missing = [r["category"] for r in out.where("places = 0").collect()]
    if missing:
        raise ValueError(f"categories that no place has: {missing}")
    return out


def demand(pop_grown: Column, poi_score: Column, tourism_weight: float = 1000.0) -> Column:
    return pop_grown + tourism_weight * poi_score


def speedtest_cells(tests: DataFrame, zoom: int = 16, prefix_zoom: int = 8, prefixes: list[str] | None = None) -> DataFrame:
    """(quadkey, tiles, tests, devices, d_kbps): sums per tile, mean speed weighted by tests."""
    x, y = tile_xy(F.col("lon"), F.col("lat"), zoom)
    t = tests.withColumn("quadkey", quadkey(x, y, zoom))
    if prefixes is not None:
        t = t.where(F.substring("quadkey", 1, prefix_zoom).isin(prefixes))
    return t.groupBy("quadkey").agg(F.count("*").alias("tiles"), F.sum("tests").alias("tests"), F.sum("devices").alias("devices"), (F.sum(F.col("d_kbps") * F.col("tests")) / F.sum("tests")).alias("d_kbps"))


def false_negatives(coverage: DataFrame, tests: DataFrame, key: str, sensitivity=(1, 5, 20), min_devices: int = 2, usable: float = 0.10) -> DataFrame:
    """(min_tests, gap_hit, gap_cells, gap_rate, control_hit, control_cells, control_rate, verdict) per number of tests asked for."""
    m = coverage.select(key, "is_covered").join(tests.select(key, "tests", "devices"), key, "left").fillna(0, ["tests", "devices"])
    m = m.withColumn("min_tests", F.explode(F.array(*[F.lit(n) for n in sensitivity])))
    ok, gap = (F.col("tests") >= F.col("min_tests")) & (F.col("devices") >= min_devices), ~F.col("is_covered")
    a = m.groupBy("min_tests").agg(F.count_if(gap & ok).alias("gap_hit"), F.count_if(gap).alias("gap_cells"), F.count_if(~gap & ok).alias("control_hit"), F.count_if(~gap).alias("control_cells"))
    rate = lambda h, n: F.col(h) / F.greatest(F.lit(1), F.col(n))
    a = a.withColumn("gap_rate", rate("gap_hit", "gap_cells")).withColumn("control_rate", rate("control_hit", "control_cells"))
    return a.withColumn("verdict", F.when(F.col("control_rate") < usable, "not usable").otherwise("lower bound"))
