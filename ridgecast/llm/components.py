"""Connected components of an edge list by alternating large-star and small-star steps (Kiveris et al., 2014).

Every step is a join against a pre-aggregated minimum, so a node with very many edges is a skewed join that AQE
splits, never a collected group. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgecast.llm.store import materialize


def components(edges: DataFrame, x: str = "x", y: str = "y", most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable. Loops and repeats are fine."""
    e = edges.where(F.col(x) != F.col(y)).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    e = materialize(e, "edges")
    for _ in range(most_rounds):
        if _is_settled(e):
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("a"), F.col("u").alias("b"), F.col("m").alias("v"))
        e = materialize(small.select(F.explode(F.array("a", "b")).alias("u"), "v").where("u != v").distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _is_settled(e: DataFrame) -> bool:
    """Every node has one edge at most, to a node that has none: the edges are stars around the smallest nodes."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    ends = e.select(F.col("u").alias("node"), one.alias("out"), zero.alias("into")).unionByName(e.select(F.col("v").alias("node"), zero.alias("out"), one.alias("into")))
    per = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return per.where("out > 1 or (out = 1 and into = 1)").isEmpty()
