"""Checks that stop a run: each returns what it checked, or raises with the figure that broke it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CheckFailed(ValueError):
    """A run's inputs or results contradict each other."""


def require(figures: DataFrame, **limits: float) -> DataFrame:
    """``figures``, a frame of one row, after a check that the size of each named column is at most its limit; null has nothing to say."""
    row = figures.first()
    over = {c: row[c] for c, most in limits.items() if row[c] is not None and abs(row[c]) > most}
    if over:
        raise CheckFailed(", ".join(f"{c} is {v}, at most {limits[c]} is allowed" for c, v in over.items()))
    return figures


def identities(registry: DataFrame, degrees: Column, seconds: Column, ground: Column, height: Column, top: Column) -> DataFrame:
    """(drifted, median_residual_m): rows whose degrees differ from their total seconds by over a tenth of one, and the median of how far
    ground and height are from the height above sea level; unknown values count in neither."""
    drift = F.abs(seconds / 3600.0 - F.abs(degrees))
    return registry.agg(F.count_if(drift > 0.1 / 3600).alias("drifted"), F.median(F.abs(ground + height - top)).alias("median_residual_m"))


def conserved(before: DataFrame, after: DataFrame, column: str, tolerance: float = 0.02) -> DataFrame:
    """``after``, if its sum of ``column`` is that of ``before`` within a share of ``tolerance``."""
    a, b = (t.agg(F.coalesce(F.sum(column), F.lit(0.0)).cast("double").alias("s")).first()["s"] for t in (before, after))
    if abs(b - a) > tolerance * abs(a):
        raise CheckFailed(f"{column} was {a} and is {b}: more than {tolerance:.0%} apart")
    return after


def same_rows(plan: DataFrame, again: DataFrame, what: str) -> DataFrame:
    """``plan``, if ``again`` has the same rows."""
    if not plan.exceptAll(again).unionByName(again.exceptAll(plan)).isEmpty():
        raise CheckFailed(f"{what} differs when it is made again")
    return plan


def recomputed(table: DataFrame, sample: DataFrame, key: str, columns: list[str], tolerance: float = 0.02) -> DataFrame:
    """``table``, if the rows of ``sample``, made in another way, agree with it within a share of ``tolerance``; none may be missing."""
    met = sample.select(key, *(F.col(c).alias(f"_{c}") for c in columns)).join(table.select(key, *columns), key, "left")
    off = F.lit(False)
    for c in columns:
        off |= F.coalesce(F.abs(F.col(c) - F.col(f"_{c}")) > tolerance * F.abs(f"_{c}"), F.col(c).isNull() != F.col(f"_{c}").isNull())
    bad = met.where(off).limit(5).collect()
    if bad:
        raise CheckFailed(f"recomputed rows differ: {[r.asDict() for r in bad]}")
    return table
