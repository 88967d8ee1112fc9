"""Candidate sites and maximum-coverage selection."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgecast.config import Radio, Siting
from ridgecast.operators.max_cover import exact
from ridgecast.operators.spatial import near_any, weight_within


def colocation(towers: DataFrame, gaps: DataFrame, siting: Siting = Siting(), radio: Radio = Radio()) -> DataFrame:
    """Existing towers with a gap in reach, rebuilt to the candidate height at least."""
    near = near_any(towers, gaps, siting.colocation_radius_m, "asr_id")
    height = F.greatest(F.coalesce("height_agl_m", F.lit(radio.default_tx_height_m)), F.lit(siting.candidate_height_m))
    return near.select(F.concat(F.lit("colo:"), F.col("asr_id").cast("string")).alias("cand_id"), F.lit("colocation").alias("kind"), "x", "y", height.alias("tx_height_m"))


def greenfield(parents: DataFrame, pixels: DataFrame, cell_m: float, siting: Siting = Siting()) -> DataFrame:
    """The highest pixel in each parent's bounding box (first in row-major order); a pixel picked twice stays once, for the smallest parent.

    ``parents`` has parent and row0, row1, col0, col1 (end exclusive); ``pixels`` has row, col, x, y, z. The boxes are joined by
    blocks of 64 x 64 pixels.
    """
    span = lambda lo, hi: F.sequence(F.expr(f"{lo} div 64"), F.expr(f"({hi} - 1) div 64"))
    p = parents.where("row1 > row0 and col1 > col0").withColumn("br", F.explode(span("row0", "row1"))).withColumn("bc", F.explode(span("col0", "col1")))
    q = pixels.withColumn("br", F.expr("row div 64")).withColumn("bc", F.expr("col div 64"))
    inside = F.col("row").between(F.col("row0"), F.col("row1") - 1) & F.col("col").between(F.col("col0"), F.col("col1") - 1)
    top = p.join(q, ["br", "bc"]).where(inside).groupBy("parent").agg(F.max_by(F.struct("row", "col", "x", "y"), F.struct("z", -F.col("row"), -F.col("col"))).alias("m"))
    first = F.row_number().over(Window.partitionBy("m.row", "m.col").orderBy("parent"))
    one = top.withColumn("k", first).where("k = 1")
    return one.select(F.concat(F.lit("green:"), F.col("parent").cast("string")).alias("cand_id"), F.lit("greenfield").alias("kind"), "m.x", "m.y", F.lit(siting.candidate_height_m).alias("tx_height_m"))


def prune(candidates: DataFrame, gaps: DataFrame, radius: float, most: int, weight: str = "demand") -> DataFrame:
    """The ``most`` candidates with most demand in straight-line reach (ties: smaller id); naive_demand is null if none need go."""
    if candidates.limit(most + 1).count() <= most:
        return candidates.withColumn("naive_demand", F.lit(None).cast("double"))
    got = weight_within(candidates, gaps, radius, "cand_id", weight).withColumnRenamed("total", "naive_demand")
    return candidates.join(got, "cand_id", "left").fillna(0.0, ["naive_demand"]).orderBy(F.desc("naive_demand"), "cand_id").limit(most)


def reachable(cover: DataFrame, gaps: DataFrame) -> DataFrame:
    """One row: gaps that any candidate covers, and their demand."""
    return gaps.join(cover.select("gap_id").distinct(), "gap_id", "left_semi").agg(F.count("*").alias("gaps"), F.coalesce(F.sum("demand"), F.lit(0.0)).alias("demand"))


def greedy(cover: DataFrame, gaps: DataFrame, sites: int, demand: Column | str = "demand") -> DataFrame:
    """(greedy_rank, cand_id, marginal_demand, cumulative_demand): each round takes the candidate that adds most (ties: smallest id), while it adds anything.

    A round is one aggregation over the cover pairs still open; only the winner's id reaches the driver.
    """
    spark = cover.sparkSession
    d = F.col(demand) if isinstance(demand, str) else demand
    # Kept by gap, so that what a winner covers goes without an exchange.
    open_ = cover.select("cand_id", "gap_id").distinct().join(gaps.select("gap_id", d.cast("double").alias("d")), "gap_id").repartition("gap_id").cache()
    kind = dict(cover.dtypes)["cand_id"]
    picks, total = [], 0.0
    taken = []
    for rank in range(1, sites + 1):
        live = open_
        if taken:
            done = open_.where(F.col("cand_id").isin(taken)).select("gap_id").distinct()
            live = open_.join(done, "gap_id", "left_anti")
        best = live.groupBy("cand_id").agg(F.sum("d").alias("gain")).orderBy(F.desc("gain"), "cand_id").first()
        if best is None or best["gain"] <= 0:
            break
        total += best["gain"]
        taken.append(best["cand_id"])
        picks.append((rank, best["cand_id"], best["gain"], total))
    open_.unpersist()
    return spark.createDataFrame(picks, f"greedy_rank long, cand_id {kind}, marginal_demand double, cumulative_demand double")


def greedy_local(cover: dict, demand: dict, sites: int) -> list[tuple]:
    """The same on the driver for small cover sets: lazy greedy over a heap."""
    heap = [(-sum(demand[g] for g in gs), c) for c, gs in cover.items()]
    heapq.heapify(heap)
    open_, out = set(demand), []
    while heap and len(out) < sites:
        gain, c = heapq.heappop(heap)
        now = -sum(demand[g] for g in cover[c] if g in open_)
        if heap and (now, c) > heap[0]:
            heapq.heappush(heap, (now, c))
            continue
        if now >= 0:
            break
        out.append((c, -now))
        open_ -= set(cover[c])
    return out


def exact_sites(cover: DataFrame, gaps: DataFrame, sites: int, most_pairs: int = 2_000_000) -> DataFrame:
    """(cand_id, total_demand, proven): the exact solver works on the driver, so the cover's size is checked first. It searches to the end."""
    pairs = cover.select("cand_id", "gap_id").distinct().cache()
    n = pairs.count()
    if n > most_pairs:
        raise ValueError(f"{n} cover pairs exceed {most_pairs}: prune the candidates first")
    sets: dict = {}
    for r in pairs.join(gaps.select("gap_id"), "gap_id", "left_semi").toLocalIterator():
        sets.setdefault(r["cand_id"], []).append(r["gap_id"])
    demand = {r["gap_id"]: float(r["demand"]) for r in gaps.join(pairs.select("gap_id").distinct(), "gap_id", "left_semi").select("gap_id", "demand").toLocalIterator()}
    pairs.unpersist()
    chosen, value, proven = exact(sets, demand, sites)
    kind = dict(cover.dtypes)["cand_id"]
    return cover.sparkSession.createDataFrame([(c, value, proven) for c in chosen], f"cand_id {kind}, total_demand double, proven boolean")
