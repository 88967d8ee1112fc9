"""Best server per receiver, summaries, bands, roll-ups, surfaces and the quality gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgecast.config import Config, Radio
from ridgecast.functions.formulas import service_band


def best_server(links: DataFrame, receivers: DataFrame, rx: str, tx: str, threshold: float = Radio().threshold_dbm) -> DataFrame:
    """Every receiver with its strongest link (ties: smallest transmitter), link and server counts; without a link it is uncovered."""
    order = F.struct(-F.col("rsrp_dbm"), F.col(tx))
    best = links.groupBy(rx).agg(
        F.max("rsrp_dbm").alias("best_rsrp_dbm"),
        *[F.min_by(c, order).alias(f"best_{c}") for c in (tx, "is_los", "distance_m")],
        F.count("*").alias("n_links"),
        F.count_if(F.col("rsrp_dbm") >= threshold).alias("n_servers"),
    )
    return with_receivers(best, receivers, rx, threshold)


def with_receivers(best: DataFrame, receivers: DataFrame, rx: str, threshold: float = Radio().threshold_dbm) -> DataFrame:
    """Every receiver with what ``best`` has for it; without a link it is uncovered."""
    out = receivers.join(best, rx, "left")
    for c in [c for c in ("n_links", "n_servers") if c in best.columns]:
        out = out.withColumn(c, F.coalesce(c, F.lit(0)))
    return out.withColumn("is_covered", F.coalesce(F.col("best_rsrp_dbm") >= threshold, F.lit(False)))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def summary(coverage: DataFrame, threshold: float = Radio().threshold_dbm) -> DataFrame:
    """One row: coverage by cells, people and demand, and the cells with no link or a single server."""
    on = F.col("is_covered")
    total = lambda w, c=None: F.coalesce(F.sum(w if c is None else F.when(c, w)), F.lit(0.0))
    return coverage.agg(
        F.lit(float(threshold)).alias("threshold_dbm"),
        F.count("*").alias("cells"),
        F.count_if(on).alias("cells_covered"),
        _share(F.count_if(on).cast("double"), F.count("*")).alias("cells_covered_frac"),
        total("pop").alias("population"),
        _share(total(F.col("pop"), on), total("pop")).alias("population_covered_frac"),
        total(F.col("pop"), ~on).alias("population_uncovered"),
        _share(total(F.col("demand"), on), total("demand")).alias("demand_covered_frac"),
        total(F.col("demand"), ~on).alias("demand_uncovered"),
        F.count_if(F.col("n_links") == 0).alias("cells_no_link"),
        F.median(F.when(on, F.col("best_rsrp_dbm"))).alias("median_served_rsrp_dbm"),
        F.count_if(F.col("n_servers") == 1).alias("cells_single_server"),
    )


BANDS = ("no_link", "gap", "single", "multi", "over")


def with_band(coverage: DataFrame) -> DataFrame:
    return coverage.withColumn("band", service_band(F.col("best_rsrp_dbm"), F.col("n_servers")))


def band_summary(coverage: DataFrame) -> DataFrame:
    return with_band(coverage).groupBy("band").agg(F.count("*").alias("cells"), F.rint(F.sum("pop")).cast("long").alias("population"))


def roll_up(cells: DataFrame, parent: Column, cell_km2: float = 0.737) -> DataFrame:
    """Cells to parents in one pass: counts and people add up, ground measures are means, signal is a median; nulls do not count.

    Needs pop, demand, is_covered, band, best_rsrp_dbm, n_servers, and the means' columns tree_frac, built_frac, relief_m, elev_mean_m where present.
    """
    on = F.col("is_covered")
    aggs = [
        F.sum("pop").alias("pop"),
        F.sum(F.when(on, F.col("pop")).otherwise(0.0)).alias("cov_pop"),
        F.sum("demand").alias("demand"),
        F.count("*").alias("cells"),
        F.count_if(on).alias("cov_cells"),
        F.avg("n_servers").alias("n_srv"),
        F.median("best_rsrp_dbm").alias("rsrp"),
    ]
    aggs += [F.avg(c).alias(c) for c in ("tree_frac", "built_frac", "relief_m", "elev_mean_m") if c in cells.columns]
    for b in BANDS:
        aggs += [F.count_if(F.col("band") == b).alias(f"cells_{b}"), F.sum(F.when(F.col("band") == b, F.col("pop")).otherwise(0.0)).alias(f"pop_{b}")]
    g = cells.groupBy(parent.alias("parent")).agg(*aggs)
    return g.withColumn("pop_pct", F.when(F.col("pop") > 0, 100.0 * F.col("cov_pop") / F.col("pop"))).withColumn("cell_pct", 100.0 * F.col("cov_cells") / F.col("cells")).withColumn("pop_km2", F.col("pop") / (F.col("cells") * cell_km2))


def two_surfaces(links: DataFrame, rx: str, tx: str, new_prefix: str = "NEW:") -> DataFrame:
    """Per pixel in one pass: best signal of all transmitters, and of those that exist already."""
    return links.groupBy(rx).agg(F.max("rsrp_dbm").alias("rsrp_all"), F.max(F.when(~F.col(tx).startswith(new_prefix), F.col("rsrp_dbm"))).alias("rsrp_cur"))


def newly_covered(surfaces: DataFrame, threshold: float = Radio().threshold_dbm) -> DataFrame:
    cur, upg = F.coalesce(F.col("rsrp_cur"), F.lit(-125.0)) >= threshold, F.coalesce(F.col("rsrp_all"), F.lit(-125.0)) >= threshold
    return surfaces.agg(F.count("*").alias("pixels"), F.avg(cur.cast("double")).alias("cov_current"), F.avg(upg.cast("double")).alias("cov_upgraded"), F.count_if(~cur & upg).alias("newly"))


def orphans(links: DataFrame, receivers: DataFrame, rx: str) -> DataFrame:
    """Receiver keys of links that no receiver has."""
    return links.select(rx).distinct().join(receivers.select(rx), rx, "left_anti")


def quality_gate(towers: DataFrame, receivers: DataFrame, links: DataFrame, coverage: DataFrame, rx: str, config: Config = Config()) -> DataFrame:
    """(check_no, check_name, status, detail): every check runs; status is PASS, FAIL or SKIP. No links at all is a FAIL."""
    g = config.gate
    nulls = lambda d: d.agg(F.count("*").alias("n"), F.count_if(F.col("x").isNull() | F.col("y").isNull()).alias("missing"))
    ok = lambda c: F.when(F.coalesce(c, F.lit(False)), "PASS").otherwise("FAIL")
    frac = F.coalesce(F.col("missing") / F.col("n"), F.lit(0.0))
    rows = []

    def add(no, name, frame, status, detail):
        rows.append(frame.select(F.lit(no).alias("check_no"), F.lit(name).alias("check_name"), status.alias("status"), detail.cast("double").alias("detail")))

    t, r = nulls(towers), nulls(receivers)
    add(1, "towers", t, ok(F.col("n") >= g.min_towers), F.col("n"))
    add(2, "tower_nulls", t, ok(frac <= g.max_null_fraction), frac)
    add(3, "receiver_nulls", r, ok(frac <= g.max_null_fraction), frac)
    add(4, "receivers", r, ok(F.col("n") >= g.min_receivers) if config.scope == "state" else F.lit("SKIP"), F.col("n"))
    span = links.agg(F.min("rsrp_dbm").alias("lo"), F.max("rsrp_dbm").alias("hi"))
    add(5, "rsrp_range", span, ok((F.col("lo") >= g.min_rsrp_dbm) & (F.col("hi") <= g.max_rsrp_dbm)), F.round("hi", 4))
    add(6, "orphan_links", orphans(links, receivers, rx).agg(F.count("*").alias("n")), ok(F.col("n") == 0), F.col("n"))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    rows_of = coverage.select(one.alias("c"), F.coalesce(F.col("is_covered").cast("long"), zero).alias("on"), zero.alias("n"))
    both = rows_of.unionByName(receivers.select(zero.alias("c"), zero.alias("on"), one.alias("n"))).agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("c", "on", "n")])
    add(7, "coverage_rows", both, ok(F.col("c") == F.col("n")), F.col("c"))
    add(8, "covered_share", both, ok((F.col("on") > 0) & (F.col("on") < F.col("c"))), F.col("on"))
    out = rows[0]
    for x in rows[1:]:
        out = out.unionByName(x)
    return out
