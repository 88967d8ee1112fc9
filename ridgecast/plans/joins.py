"""Registered queries, continued: joins that assemble tables, scans, masks and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgecast.functions import cells, polygon
from ridgecast.operators import demand, raster, siting
from ridgecast.plans import oracle as o
from ridgecast.plans import relational as r
from ridgecast.plans.fixtures import ctes, frame
from ridgecast.plans.relational import query, rounded
from ridgecast.sources.text import bbox_scan


def in_counties(df: DataFrame, code: str, prefixes: list[str] | None) -> DataFrame:
    """Rows whose code begins with one of ``prefixes``, of any lengths; None: all."""
    if prefixes is None:
        return df
    some = F.lit(False)
    for n in sorted({len(p) for p in prefixes}):
        some |= F.substring(code, 1, n).isin([p for p in prefixes if len(p) == n])
    return df.where(some)


@query(f"with {ctes('receivers')} select cell_id, lpad(county::varchar, 2, '0') as code from receivers where substr(lpad(county::varchar, 2, '0'), 1, 1) in ('0', '2')")
def county_prefix_filter(spark, d):
    t = frame(spark, d, "receivers").select("cell_id", F.lpad(F.col("county").cast("string"), 2, "0").alias("code"))
    return in_counties(t, "code", ["0", "2"])


@query(f"with {ctes('county_vintages')}, g as (select case when a.pop > 0 then (b.pop-a.pop)/a.pop::double else 0e0 end as growth from county_vintages a join county_vintages b using (county) where a.vintage=1995 and b.vintage=2000) select round(median(growth), 6) as median_growth, round(min(growth), 6) as min_growth, round(max(growth), 6) as max_growth from g")
def growth_stats(spark, d):
    g = demand.growth(frame(spark, d, "county_vintages"), "county", 1995, 2000)
    return g.agg(F.round(F.median("growth"), 6).alias("median_growth"), F.round(F.min("growth"), 6).alias("min_growth"), F.round(F.max("growth"), 6).alias("max_growth"))


@query(f"""with {ctes('counties', 'receivers', 'county_vintages')}, people as (select county, sum(pop) as pop from receivers group by county),
    grown as (select a.county, case when a.pop > 0 then (b.pop-a.pop)/a.pop::double else 0e0 end as growth from county_vintages a join county_vintages b using (county) where a.vintage=1995 and b.vintage=2000)
    select county, state, round(coalesce(pop, 0e0), 4) as pop, round(coalesce(growth, 0e0), 6) as growth from counties left join people using (county) left join grown using (county)""")
def block_features(spark, d):
    """Areas with people and growth: both are left joins, what is missing is zero. One column of the source is left out by name."""
    c = frame(spark, d, "counties").drop("xmin", "xmax", "ymin", "ymax")
    people = frame(spark, d, "receivers").groupBy("county").agg(F.sum("pop").alias("pop"))
    g = demand.growth(frame(spark, d, "county_vintages"), "county", 1995, 2000)
    out = c.join(people, "county", "left").join(g, "county", "left").fillna(0.0, ["pop", "growth"])
    return out.select("county", "state", F.round("pop", 4).alias("pop"), F.round("growth", 6).alias("growth"))


@query(f"""with {ctes('receivers', 'places')}, {o.axial_ctes('receivers', 5000.0, 'rc', 'cell_id, pop, growth')}, picked as (select *, {r.WEIGHT_SQL}::double as w from places where category in ({', '.join(map(repr, r.WEIGHTS))})), {o.axial_ctes('picked', 5000.0, 'pc', 'w')},
    scores as (select q+a as q, r+b as r, sum(w) as poi_score from pc, {r.STEPS_SQL} group by 1, 2)
    select cell_id, coalesce(poi_score, 0e0) as poi_score, round(pop*(1e0+growth) + 1000e0*coalesce(poi_score, 0e0), 4) as demand from rc left join scores using (q, r)""")
def demand_assembly(spark, d):
    """Receivers with the tourism score of their cell (none: zero) and the demand of both."""
    q, w = cells.point_to_axial(F.col("x"), F.col("y"), 5000.0)
    rc = frame(spark, d, "receivers").withColumn("cell", cells.cell_id(q, w, 8))
    scores = demand.poi_scores(frame(spark, d, "places"), r.WEIGHTS, 5000.0, 2)
    t = rc.drop("poi_score", "demand").join(scores, "cell", "left").fillna(0.0, ["poi_score"])
    return t.select("cell_id", "poi_score", F.round(demand.demand(F.col("pop") * (1 + F.col("growth")), F.col("poi_score")), 4).alias("demand"))


def require_complete(df: DataFrame, column: str) -> DataFrame:
    """``df``, after a check that ``column`` is never null."""
    if not df.where(F.col(column).isNull()).limit(1).isEmpty():
        raise ValueError(f"{column} is missing for some rows")
    return df


@query(f"with {o.COVERAGE}, {r.ZONAL} select cell_id, round(elev_mean_m, 4) as elev_mean_m, round(tree_frac, 6) as tree_frac, best_asr_id, coalesce(t.height_agl_m, 45e0) as server_height_m from coverage c left join feats using (county) left join towers t on t.asr_id = c.best_asr_id where best_asr_id is not null and elev_mean_m is not null")
def coverage_features(spark, d):
    """Coverage with its zone's features, which none may lack, and the height of the serving tower."""
    # The check reads the table once more.
    c = r.coverage_of(spark, d, 0).where("best_asr_id is not null").join(r.zonal_of(spark, d), "county", "left").cache()
    t = frame(spark, d, "towers").select(F.col("asr_id").alias("best_asr_id"), F.coalesce("height_agl_m", F.lit(45.0)).alias("server_height_m"))
    return require_complete(c, "elev_mean_m").join(t, "best_asr_id", "left").select("cell_id", F.round("elev_mean_m", 4).alias("elev_mean_m"), F.round("tree_frac", 6).alias("tree_frac"), "best_asr_id", "server_height_m")


@query(f"""with {r.SETS}, {r.greedy_ctes('demand', r.SITES, 'g')}, picks as ({' union all '.join(f'select {k}::bigint as greedy_rank, cand_id, gain as marginal_demand from g{k}' for k in range(1, r.SITES + 1))})
    select cand_id, count(*) as gap_cells_served, p.cand_id is not null as selected_greedy, any_value(greedy_rank) as greedy_rank, any_value(marginal_demand) as marginal_demand from cover_sets left join picks p using (cand_id) group by cand_id, p.cand_id""")
def site_table(spark, d):
    """Every candidate with what it serves and, where it was picked, its rank (null elsewhere)."""
    sets, gaps = frame(spark, d, "cover_sets"), frame(spark, d, "cover_gaps")
    picks = siting.greedy(sets, gaps, r.SITES).drop("cumulative_demand")
    served = sets.groupBy("cand_id").agg(F.count("*").alias("gap_cells_served"))
    return served.join(picks, "cand_id", "left").select("cand_id", "gap_cells_served", F.col("greedy_rank").isNotNull().alias("selected_greedy"), "greedy_rank", "marginal_demand")


@query(f"with {ctes('places')} select place_id, category, x, y from places where x between 50000e0 and 200000e0 and y between 50000e0 and 350000e0 and category in ('ECONOMY', 'SMALL')")
def poi_bbox_scan(spark, d):
    """A window over struct leaves and an IN list."""
    p = frame(spark, d, "places")
    p = p.withColumn("bbox", F.struct(F.col("x").alias("xmin"), F.col("x").alias("xmax"), F.col("y").alias("ymin"), F.col("y").alias("ymax")))
    p = p.withColumn("categories", F.struct(F.col("category").alias("primary")))
    return bbox_scan(p, 50_000.0, 50_000.0, 200_000.0, 350_000.0).where(F.col("categories.primary").isin("ECONOMY", "SMALL")).select("place_id", F.col("categories.primary").alias("category"), F.col("bbox.xmin").alias("x"), F.col("bbox.ymin").alias("y"))


@query(f"with {ctes('counties')} select county from counties order by md5(county::varchar), county limit 3")
def zone_sample(spark, d):
    """Three zones to recompute by hand: the same ones in every run."""
    return frame(spark, d, "counties").orderBy(F.md5(F.col("county").cast("string")), "county").limit(3).select("county")


@query(f"with {r.GAPS}, {r.COLO}, {r.GREEN} select kind, count(*) as candidates from (select kind from colo union all select kind from green) group by kind")
def candidate_kinds(spark, d):
    gaps = r.gaps_of(spark, d)
    both = siting.colocation(frame(spark, d, "towers"), gaps).unionByName(r.greenfield_of(spark, gaps))
    return both.groupBy("kind").agg(F.count("*").alias("candidates"))


IN_RING, _ = r.ring_sql()


@query(f"with grid as (select id as pix, (id%200+0.5e0)*2000e0 as x, 400000e0-(id//200+0.5e0)*2000e0 as y from range(40000) t(id)) select pix from grid where {IN_RING}")
def pixels_in_polygon(spark, d):
    """Pixels whose centre lies in the polygon."""
    return raster.pixel_centres(spark, 200, 200, 0.0, 400_000.0, 2000.0).where(polygon.contains(r.RING, F.col("x"), F.col("y"))).select("pix")


@query(f"with {r.BURN}, masked as (select b.pix, case when {IN_RING} then greatest(value, -125e0) else -9999e0 end as value from burned b join grid using (pix)) select pix, round(value, 4) as value from masked")
def surface_burn(spark, d):
    """Inside the area unreached pixels are modelled and weak (-125), outside there is no data (-9999)."""
    grid = raster.pixel_centres(spark, 200, 200, 0.0, 400_000.0, 2000.0).select("pix", polygon.contains(r.RING, F.col("x"), F.col("y")).alias("inside"))
    t = r.burned_of(spark, d).join(grid, "pix")
    return rounded(t.select("pix", F.when(F.col("inside"), F.greatest("value", F.lit(-125.0))).otherwise(-9999.0).alias("value")))


@query(f"with {o.COVERAGE}, {ctes('speedtests')}, {r.TESTED} select cell_id, is_covered, tests, devices from tested")
def coverage_speedtests(spark, d):
    c = r.coverage_of(spark, d, 0).select("cell_id", "is_covered")
    return c.join(r.tests_of(spark, d, frame(spark, d, "receivers")), "cell_id", "left").fillna(0, ["tests", "devices"])


H3 = "(613237248420216831 + event_id*8)"


@query(f"select event_id, cast(({H3} >> 52) & 15 as int) as res, (({H3} & {~(15 << 52)}) | {7 << 52} | {(1 << 24) - 1}) as parent_r7, lower(hex({H3})) as text from events")
def h3_bits(spark, d):
    """Resolution, parent and text form of H3 ids, by their bits alone."""
    h = F.lit(613237248420216831).cast("long") + F.col("event_id") * 8
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", cells.h3_resolution(h).alias("res"), cells.h3_parent(h, 7).alias("parent_r7"), cells.h3_to_string(h).alias("text"))


@query(f"with {o.COVERAGE} select cell_id, row_number() over (order by best_rsrp_dbm desc nulls last, cell_id) as place from coverage where n_servers = 1 qualify place <= 20")
def weakest_redundancy(spark, d):
    """Twenty best-served cells that hang on one tower."""
    from pyspark.sql import Window

    top = r.coverage_of(spark, d, 2).where("n_servers = 1").orderBy(F.desc_nulls_last("best_rsrp_dbm"), "cell_id").limit(20)
    return top.select("cell_id", F.row_number().over(Window.orderBy(F.desc_nulls_last("best_rsrp_dbm"), "cell_id")).cast("long").alias("place"))
