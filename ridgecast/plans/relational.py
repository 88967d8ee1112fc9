"""The registered queries of the coverage domain, each next to its oracle."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgecast.config import Config, Gate, Radio
from ridgecast.functions import cells, formulas, polygon
from ridgecast.operators import blocks, checks, coverage, demand, kernel, publish, raster, siting, spatial
from ridgecast.plans import oracle as o
from ridgecast.plans.fixtures import PARENT_M, PIXEL_M, SIDE, ctes, frame, pixels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
RADIO = Radio()


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLES[name or f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 4, skip: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes])


def rounded_fast(df: DataFrame, digits: int = 4) -> DataFrame:
    """``rounded`` by arithmetic, half away from zero as in SQL: for finite values below 1e13, of which there are very many."""
    one = 10.0**digits
    near = lambda c: F.signum(c) * F.floor(F.abs(c) * one + 0.5) / one
    return df.select(*[near(F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# Towers and links


@query(f"""with {ctes("towers")} select asr_id, x, y, case when height_agl_m > 0 then height_agl_m end as height_agl_m, coalesce(case when height_agl_m > 0 then height_agl_m end, 45e0) as tx_height_m
    from towers where x is not null and y is not null and x between 10000e0 and 390000e0 and y between 10000e0 and 390000e0""")
def towers_clean(spark, d):
    """Zero heights are unknown, null coordinates go, the padded box is inclusive, unknown heights get the default."""
    h = F.when(F.col("height_agl_m") > 0, F.col("height_agl_m"))
    pad = RADIO.max_link_m
    inside = F.col("x").between(50_000.0 - pad, 350_000.0 + pad) & F.col("y").between(50_000.0 - pad, 350_000.0 + pad)
    return frame(spark, d, "towers").where(F.col("x").isNotNull() & F.col("y").isNotNull() & inside).select("asr_id", "x", "y", h.alias("height_agl_m"), F.coalesce(h, F.lit(RADIO.default_tx_height_m)).alias("tx_height_m"))


def transmitters_of(spark, d) -> DataFrame:
    return frame(spark, d, "towers").select("asr_id", "x", "y", F.coalesce("height_agl_m", F.lit(RADIO.default_tx_height_m)).alias("tx_height_m"))


@query(f"with {o.BASE} select tx as asr_id, rx as cell_id, round(sqrt((rx_x-tx_x)*(rx_x-tx_x)+(rx_y-tx_y)*(rx_y-tx_y)), 4) as distance_m from pairs")
def dwithin_pairs(spark, d):
    return rounded_fast(blocks.pairs(transmitters_of(spark, d), frame(spark, d, "receivers"), "asr_id", "cell_id", RADIO.max_link_m))


def links_of(spark, d, floor_dbm: float | None = None) -> DataFrame:
    return blocks.links(transmitters_of(spark, d), frame(spark, d, "receivers"), kernel.FormulaTerrain(), "asr_id", "cell_id", RADIO, floor_dbm)


def best_of(spark, d, towers=None, most=None, new_prefix="") -> DataFrame:
    """A row per receiver with a link; ``most`` as for ``blocks.per_receiver``."""
    return blocks.per_receiver(transmitters_of(spark, d) if towers is None else towers, frame(spark, d, "receivers"), kernel.FormulaTerrain(), "asr_id", "cell_id", RADIO, new_prefix, most)


ROUND_LINKS = "asr_id, cell_id, round(rsrp_dbm, 4) as rsrp_dbm, round(path_loss_db, 4) as path_loss_db, round(diffraction_db, 4) as diffraction_db, round(clutter_db, 4) as clutter_db, round(distance_m, 4) as distance_m, is_los"


@query(f"with {o.LINKS} select {ROUND_LINKS} from links")
def link_rsrp(spark, d):
    return rounded_fast(links_of(spark, d))


def coverage_of(spark, d, most=None) -> DataFrame:
    """Every receiver with its best link. With ``most`` servers are counted up to it (at 0 there is no count), and links are not."""
    best = best_of(spark, d, most=most).drop("low_rsrp_dbm")
    return coverage.with_receivers(best, frame(spark, d, "receivers"), "cell_id")


COVERAGE_COLUMNS = "cell_id, pop, demand, x, y, best_rsrp_dbm, best_asr_id, best_is_los, best_distance_m, n_links, n_servers, is_covered"


@query(f"with {o.COVERAGE} select cell_id, round(pop, 4) as pop, round(demand, 4) as demand, round(x, 4) as x, round(y, 4) as y, round(best_rsrp_dbm, 4) as best_rsrp_dbm, best_asr_id, best_is_los, round(best_distance_m, 4) as best_distance_m, n_links, n_servers, is_covered from coverage")
def best_server(spark, d):
    return rounded(coverage_of(spark, d).select(*COVERAGE_COLUMNS.split(", ")))


@query(f"""with {o.COVERAGE} select -105e0 as threshold_dbm, count(*) as cells, count(*) filter (is_covered) as cells_covered,
    round(count(*) filter (is_covered) / count(*)::double, 4) as cells_covered_frac, round(sum(pop), 4) as population, round(coalesce(sum(pop) filter (is_covered), 0) / sum(pop), 4) as population_covered_frac,
    round(coalesce(sum(pop) filter (not is_covered), 0), 4) as population_uncovered, round(coalesce(sum(demand) filter (is_covered), 0) / sum(demand), 4) as demand_covered_frac,
    round(coalesce(sum(demand) filter (not is_covered), 0), 4) as demand_uncovered, count(*) filter (n_links = 0) as cells_no_link, round(median(best_rsrp_dbm) filter (is_covered), 4) as median_served_rsrp_dbm,
    count(*) filter (n_servers = 1) as cells_single_server from coverage""")
def coverage_summary(spark, d):
    # It tells no link, one server and more apart.
    c = coverage_of(spark, d, 2)
    return rounded(coverage.summary(c.withColumn("n_links", F.col("best_rsrp_dbm").isNotNull().cast("long"))))


# Quality


@query(f"""with {o.COVERAGE} select 1 as check_no, 'towers' as check_name, case when count(*) >= 100 then 'PASS' else 'FAIL' end as status, count(*)::double as detail from towers
    union all select 2, 'tower_nulls', case when avg((x is null or y is null)::int) <= 0 then 'PASS' else 'FAIL' end, avg((x is null or y is null)::int) from towers
    union all select 3, 'receiver_nulls', case when avg((x is null or y is null)::int) <= 0 then 'PASS' else 'FAIL' end, avg((x is null or y is null)::int) from receivers
    union all select 4, 'receivers', 'SKIP', count(*)::double from receivers
    union all select 5, 'rsrp_range', case when min(rsrp_dbm) >= -200 and max(rsrp_dbm) <= -30 then 'PASS' else 'FAIL' end, round(max(rsrp_dbm), 4) from links
    union all select 6, 'orphan_links', case when count(*) = 0 then 'PASS' else 'FAIL' end, count(*)::double from (select distinct cell_id from links) l where not exists (select 1 from receivers r where r.cell_id = l.cell_id)
    union all select 7, 'coverage_rows', case when (select count(*) from coverage) = (select count(*) from receivers) then 'PASS' else 'FAIL' end, (select count(*) from coverage)::double
    union all select 8, 'covered_share', case when count(*) filter (is_covered) between 1 and count(*)-1 then 'PASS' else 'FAIL' end, (count(*) filter (is_covered))::double from coverage""")
def dq_gate(spark, d):
    # Four checks read the links; the weakest and the strongest of each receiver answer them, and are computed once. No link is below the kernel's floor: the weakest
    # matter only to a gate above it.
    gate = Gate()
    best, receivers = best_of(spark, d, most=0 if gate.min_rsrp_dbm <= RADIO.keep_floor_dbm else None).cache(), frame(spark, d, "receivers")
    links = best.select("cell_id", F.explode(F.array(*[c for c in ("low_rsrp_dbm", "best_rsrp_dbm") if c in best.columns])).alias("rsrp_dbm"))
    got = coverage.with_receivers(best, receivers, "cell_id")
    return coverage.quality_gate(frame(spark, d, "towers"), receivers, links, got, "cell_id", Config(gate=gate, scope="demo"))


@query(f"with {o.LINKS} select distinct cell_id from links where not exists (select 1 from receivers r where r.cell_id = links.cell_id)")
def orphan_links(spark, d):
    return coverage.orphans(best_of(spark, d, most=0), frame(spark, d, "receivers"), "cell_id")


@query("""select count(*) filter (abs(total/3600e0 - abs(deg)) > 0.1e0/3600e0) as drifted, round(median(abs(ground + agl - amsl)), 4) as median_residual_m from
    (select cast(s_suppkey*37%324000 as double) as total, (case when s_suppkey%2=0 then -1e0 else 1e0 end)*(floor((s_suppkey*37%324000)/3600e0) + floor((s_suppkey*37%3600)/60e0)/60e0 + (s_suppkey*37%60)/3600e0) as deg,
    cast(100+s_suppkey%300 as double) as ground, case when s_suppkey%7=0 then null else cast(30+s_suppkey%90 as double) end as agl, cast(100+s_suppkey%300+30+s_suppkey%90+s_suppkey%3 as double) as amsl from supplier)""")
def asr_identity_checks(spark, d):
    """Redundant columns agree: degrees against total seconds, ground plus height against height above sea level (median over known rows)."""
    k = F.col("s_suppkey") * 37
    deg = formulas.dms_to_degrees(F.floor(k % 324000 / 3600.0), F.floor(k % 3600 / 60.0), (k % 60).cast("double"), F.when(F.col("s_suppkey") % 2 == 0, "S").otherwise("N"), "S")
    s = spark.read.parquet(f"{d}/supplier.parquet").select((k % 324000).cast("double").alias("total"), deg.alias("deg"), (100 + F.col("s_suppkey") % 300).cast("double").alias("ground"), F.when(F.col("s_suppkey") % 7 != 0, (30 + F.col("s_suppkey") % 90).cast("double")).alias("agl"), (130 + F.col("s_suppkey") % 300 + F.col("s_suppkey") % 90 + F.col("s_suppkey") % 3).cast("double").alias("amsl"))
    got = checks.identities(s, F.col("deg"), F.col("total"), F.col("ground"), F.col("agl"), F.col("amsl"))
    return rounded(checks.require(got, drifted=0, median_residual_m=1.0))


def unique(df: DataFrame, key: str) -> DataFrame:
    """``df``, after a check that no key repeats."""
    if not df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        raise ValueError(f"{key} repeats")
    return df


@query(f"with {ctes('towers')} select t.asr_id, t.x, s.s_name as owner from towers t join supplier s on t.usi = s.s_suppkey")
def inner_1to1(spark, d):
    owners = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("usi"), F.col("s_name").alias("owner"))
    return unique(frame(spark, d, "towers"), "usi").join(unique(owners, "usi"), "usi").select("asr_id", "x", "owner")


# Demand


@query(f"""with {ctes('county_vintages')} select a.county, round(case when a.pop > 0 then (b.pop-a.pop)/a.pop::double else 0e0 end, 4) as growth
    from county_vintages a join county_vintages b using (county) where a.vintage=1995 and b.vintage=2000""")
def county_growth(spark, d):
    return rounded(demand.growth(frame(spark, d, "county_vintages"), "county", 1995, 2000))


SQUARES = "squares as (select a*8+b as square_id, a*50000e0 as xmin, (a+1)*50000e0 as xmax, b*50000e0 as ymin, (b+1)*50000e0 as ymax from range(8) s(a), range(8) t(b))"


@query(f"""with {ctes('counties', 'receivers')}, {SQUARES}, people as (select county, sum(pop) as pop, max(growth) as growth from receivers group by county),
    met as (select square_id, county, (least(c.xmax, s.xmax)-greatest(c.xmin, s.xmin))*(least(c.ymax, s.ymax)-greatest(c.ymin, s.ymin)) as a from counties c, squares s
        where least(c.xmax, s.xmax) > greatest(c.xmin, s.xmin) and least(c.ymax, s.ymax) > greatest(c.ymin, s.ymin))
    select square_id, round(sum(pop*a/6.4e9), 3) as pop, round(sum(pop*a/6.4e9*(1+coalesce(growth, 0e0))), 3) as pop_grown from met join people using (county) group by square_id""")
def areal_population(spark, d):
    k = spark.range(64).select(F.col("id").alias("square_id"), F.expr("id div 8").alias("a"), (F.col("id") % 8).alias("b"))
    squares = k.select("square_id", (F.col("a") * 50000.0).alias("xmin"), ((F.col("a") + 1) * 50000.0).alias("xmax"), (F.col("b") * 50000.0).alias("ymin"), ((F.col("b") + 1) * 50000.0).alias("ymax"))
    people = frame(spark, d, "receivers").groupBy("county").agg(F.sum("pop").alias("pop"), F.max("growth").alias("growth"))
    met = spatial.rectangle_overlap(squares, frame(spark, d, "counties"), 80_000.0).join(people, F.col("r_county") == F.col("county"))
    out = spatial.interpolate(met, "square_id", F.col("pop"), F.lit(6.4e9), F.col("growth"))
    return rounded(checks.conserved(people, out, "pop"), 3)


# The categories of the provided data with weights of our own.
WEIGHTS = {"ECONOMY": 3.5, "LARGE": 3.0, "MEDIUM": 2.5, "PROMO": 1.5, "SMALL": 0.5}
STEPS_SQL = "(select a, b from range(-2, 3) s(a), range(-2, 3) t(b) where abs(a+b) <= 2)"
WEIGHT_SQL = "case category " + " ".join(f"when '{k}' then {v!r}" for k, v in WEIGHTS.items()) + " end"


@query(f"""with {ctes('places')}, picked as (select *, {WEIGHT_SQL}::double as w from places where category in ({', '.join(map(repr, WEIGHTS))})), {o.axial_ctes('picked', 5000.0, 'hexed', 'w')}
    select {o.cell_sql('(q+a)', '(r+b)', 8)} as cell, sum(w) as poi_score from hexed, {STEPS_SQL} group by 1""")
def poi_kring_score(spark, d):
    return demand.poi_scores(frame(spark, d, "places"), WEIGHTS, 5000.0, 2)


@query(f"with {ctes('places')} select category, count(*) as places from places where category in ({', '.join(map(repr, WEIGHTS))}) group by 1")
def poi_category_counts(spark, d):
    return demand.category_counts(frame(spark, d, "places"), WEIGHTS)


@query(f"with {ctes('receivers')} select cell_id, round(pop*(1e0+growth) + 1000e0*poi_score, 4) as demand from receivers")
def demand_score(spark, d):
    return frame(spark, d, "receivers").select("cell_id", F.round(demand.demand(F.col("pop") * (1 + F.col("growth")), F.col("poi_score")), 4).alias("demand"))


@query("""select event_id, round((case when event_id%2=0 then -1e0 else 1e0 end)*(event_id%90 + (event_id*7%60)/60e0 + (event_id*13%600)/10e0/3600e0), 8)+0e0 as degrees, try_cast(nullif(trim(case when event_id%5=0 then '  ' when event_id%7=0 then 'n/a' else concat(event_id%90, '.5 ') end), '') as double) as number from events""")
def dms_to_deg(spark, d):
    e = F.col("event_id")
    deg = formulas.dms_to_degrees((e % 90).cast("double"), (e * 7 % 60).cast("double"), (e * 13 % 600) / 10.0, F.when(e % 2 == 0, "S").otherwise("N"), "S")
    raw = F.when(e % 5 == 0, "  ").when(e % 7 == 0, "n/a").otherwise(F.concat((e % 90).cast("string"), F.lit(".5 ")))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", (F.round(deg, 8) + 0.0).alias("degrees"), formulas.blank_to_double(raw).alias("number"))


SIN = "sin(radians(lat))"
Q_SQL = f"((1-{formulas.E2!r})*({SIN}/(1-{formulas.E2!r}*{SIN}*{SIN}) - ln((1-{formulas.E1!r}*{SIN})/(1+{formulas.E1!r}*{SIN}))/(2*{formulas.E1!r})))"
RHO_SQL = f"({formulas.A!r}*sqrt({formulas.CONST!r}-{formulas.CONE!r}*{Q_SQL})/{formulas.CONE!r})"
THETA_SQL = f"({formulas.CONE!r}*(radians(lon)-({formulas.LAM0!r})))"


@query(f"with {ctes('speedtests')} select event_id, round({RHO_SQL}*sin({THETA_SQL}), 3) as x, round({formulas.RHO0!r}-{RHO_SQL}*cos({THETA_SQL}), 3) as y, round(lon, 6) as lon_back, round(lat, 6) as lat_back from speedtests")
def albers_forward(spark, d):
    """Degrees to metres, and back by the inverse."""
    x, y = formulas.albers(F.col("lon"), F.col("lat"))
    p = frame(spark, d, "speedtests").select("event_id", x.alias("x"), y.alias("y"))
    lon, lat = formulas.albers_inverse(F.col("x"), F.col("y"))
    return p.select("event_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.round(lon, 6).alias("lon_back"), F.round(lat, 6).alias("lat_back"))


# Rasters


BOXES_SQL = "select s_suppkey as key, -(90+s_suppkey%20)+0.25e0 as west, -(90+s_suppkey%20)+0.25e0+(1+s_suppkey%3) as east, 30+s_suppkey%15+0.5e0 as south, 30+s_suppkey%15+0.5e0+(1+s_suppkey%2) as north from supplier"


@query(f"""with boxes as ({BOXES_SQL}) select key, concat(case when lat>=0 then 'N' else 'S' end, lpad(abs(lat)::varchar, 2, '0'), case when lon>=0 then 'E' else 'W' end, lpad(abs(lon)::varchar, 3, '0')) as name from
    (select key, unnest(generate_series(floor(south)::int, greatest(ceil(north)::int-1, floor(south)::int))) as lat, west, east from boxes) a, lateral (select unnest(generate_series(floor(west)::int, greatest(ceil(east)::int-1, floor(west)::int))) as lon) b""")
def tile_enumeration(spark, d):
    s = F.col("s_suppkey")
    west, south = -(90 + s % 20) + 0.25, 30 + s % 15 + 0.5
    boxes = spark.read.parquet(f"{d}/supplier.parquet").select(s.alias("key"), west.alias("west"), (west + 1 + s % 3).alias("east"), south.alias("south"), (south + 1 + s % 2).alias("north"))
    return raster.degree_tiles(boxes, 1)


@query(f"""with {ctes('receivers')}, boxes as (select county, min(x) as a, min(y) as b, max(x) as p, max(y) as q from receivers group by county)
    select county, floor(a/90e0)*90e0 as x0, floor(b/90e0)*90e0 as y0, ceil(p/90e0)*90e0 as x1, ceil(q/90e0)*90e0 as y1, cast(round((ceil(p/90e0)*90e0-floor(a/90e0)*90e0)/90e0) as bigint) as width, cast(round((ceil(q/90e0)*90e0-floor(b/90e0)*90e0)/90e0) as bigint) as height from boxes""")
def grid_snap(spark, d):
    b = frame(spark, d, "receivers").groupBy("county").agg(F.min("x").alias("a"), F.min("y").alias("b"), F.max("x").alias("p"), F.max("y").alias("q"))
    return b.select("county", *[v.alias(k) for k, v in formulas.snap_bounds(F.col("a"), F.col("b"), F.col("p"), F.col("q")).items()])


@query("select id as pix, id//200 as row, id%200 as col, (id%200+0.5e0)*2000e0 as x, 400000e0-(id//200+0.5e0)*2000e0 as y from range(40000) t(id)")
def pixel_centres(spark, d):
    return raster.pixel_centres(spark, 200, 200, 0.0, 400_000.0, 2000.0)


@query(f"with {ctes('places')} select cast(floor((400500e0-y)/90e0) as bigint) as row, cast(floor(x/90e0) as bigint) as col, max(cast(least(round_even(coalesce(height, 5e0), 0), 250) as int)) as height from places group by 1, 2")
def building_burn(spark, d):
    return raster.burn_heights(frame(spark, d, "places"), 0.0, 400_500.0, 90.0)


T = kernel.FormulaTerrain()
ROWS, COLS = T.rows, T.cols


def land(r, c):
    return np.array(T.classes)[(r * 13 + c * 29) % 8]


def heights(r, c):
    return 200 + np.abs((c * 7 + r * 3) % 200 - 100)


def buildings(r, c):
    return np.where((r * 7 + c * 11) % 17 == 0, (r + c) % 40, 0)


def layer(spark, name: str) -> DataFrame:
    made = {"dem": (heights, "i2"), "land": (land, "u1"), "bldg": (buildings, "u1")}
    return raster.tiles_of(spark, name, ROWS, COLS, *made[name])


PIX = f"px as (select r, c, 200+abs((c*7+r*3)%200-100) as z, [10,20,30,40,50,60,80,90][1+(r*13+c*29)%8] as k, case when (r*7+c*11)%17=0 then (r+c)%40 else 0 end as b from range({ROWS}) s(r), range({COLS}) t(c))"


@query(f"with {PIX} select cast(c//512 as int) as tx, cast(r//512 as int) as ty, count(*) filter (k=10) as tree_px, count(*) filter (k=50) as built_px, count(*) filter (b>0) as bldg_px from px group by 1, 2")
def map_algebra_masks(spark, d):
    masks = [("land", lambda a: a == 10, "tree_px"), ("land", lambda a: a == 50, "built_px"), ("bldg", lambda a: a > 0, "bldg_px")]
    total = lambda tiles, name: raster.map_algebra(tiles, "u1", lambda a: a.sum(dtype=np.int64).reshape(1, 1), "i8", name)
    out = None
    for src, f, name in masks:
        m = raster.map_algebra(layer(spark, src), "u1", f, "u1", name)
        one = total(m, name).select("layer", "tx", "ty", F.lit(1).alias("rows"), F.lit(1).alias("cols"), "data")
        got = raster.pixels(one, "i8", "long").select((F.col("col") / raster.TILE).cast("int").alias("tx"), (F.col("row") / raster.TILE).cast("int").alias("ty"), F.col("value").alias(name))
        out = got if out is None else out.join(got, ["tx", "ty"])
    return out


def zones_of(spark, d) -> DataFrame:
    return frame(spark, d, "counties").select("county", "xmin", "ymin", "xmax", "ymax")


def zonal_of(spark, d) -> DataFrame:
    z = zones_of(spark, d)
    stats = lambda tiles, dtype, p: raster.zonal(tiles, z, "county", dtype, T.x0, T.y0, T.cell_m).select("county", *[F.col(c).alias(f"{p}_{c}") for c in ("sum", "n", "min", "max")])
    mask = lambda src, f, p: stats(raster.map_algebra(layer(spark, src), "u1", f, "u1", p), "u1", p)
    got = stats(layer(spark, "dem"), "i2", "dem").join(mask("land", lambda a: a == 10, "tree"), "county").join(mask("land", lambda a: a == 50, "built"), "county").join(stats(layer(spark, "bldg"), "u1", "bldg"), "county").join(mask("bldg", lambda a: a > 0, "on"), "county")
    n = F.col("dem_n")
    return got.select(
        "county",
        (F.col("dem_sum") / n).alias("elev_mean_m"),
        (F.col("dem_max") - F.col("dem_min")).alias("relief_m"),
        (F.col("tree_sum") / n).alias("tree_frac"),
        (F.col("built_sum") / n).alias("built_frac"),
        F.col("bldg_max").alias("bldg_max_m"),
        F.col("on_sum").alias("bldg_px"),
        (F.col("bldg_sum") / F.greatest(F.col("on_sum"), F.lit(1.0))).alias("bldg_mean_m"),
    )


ZONAL = f"""{ctes('counties')}, {PIX}, zoned as (select county, z, k, b from px join counties on 45e0+c*90e0 >= xmin and 45e0+c*90e0 < xmax and 400455e0-r*90e0 >= ymin and 400455e0-r*90e0 < ymax),
    feats as (select county, sum(z)/count(*)::double as elev_mean_m, cast(max(z)-min(z) as double) as relief_m, count(*) filter (k=10)/count(*)::double as tree_frac, count(*) filter (k=50)/count(*)::double as built_frac,
    cast(max(b) as double) as bldg_max_m, cast(count(*) filter (b>0) as double) as bldg_px, sum(b)/greatest(count(*) filter (b>0), 1)::double as bldg_mean_m from zoned group by county)"""


@query(f"with {ZONAL} select county, round(elev_mean_m, 4) as elev_mean_m, relief_m, round(tree_frac, 6) as tree_frac, round(built_frac, 6) as built_frac, bldg_max_m, bldg_px, round(bldg_mean_m, 4) as bldg_mean_m from feats")
def zonal_stats(spark, d):
    z = zonal_of(spark, d)
    return z.select("county", F.round("elev_mean_m", 4).alias("elev_mean_m"), "relief_m", F.round("tree_frac", 6).alias("tree_frac"), F.round("built_frac", 6).alias("built_frac"), "bldg_max_m", "bldg_px", F.round("bldg_mean_m", 4).alias("bldg_mean_m"))


@query(f"with {o.COVERAGE}, {ZONAL} select is_covered, round(avg(elev_mean_m), 3) as elev_mean_m, round(avg(relief_m), 3) as relief_m, round(avg(tree_frac), 5) as tree_frac, round(avg(bldg_mean_m), 3) as bldg_mean_m from coverage join feats using (county) group by is_covered")
def gap_vs_covered_means(spark, d):
    c = coverage_of(spark, d, 0).select("county", "is_covered").join(zonal_of(spark, d), "county")
    return c.groupBy("is_covered").agg(F.round(F.avg("elev_mean_m"), 3).alias("elev_mean_m"), F.round(F.avg("relief_m"), 3).alias("relief_m"), F.round(F.avg("tree_frac"), 5).alias("tree_frac"), F.round(F.avg("bldg_mean_m"), 3).alias("bldg_mean_m"))


BURN = f"""{o.COVERAGE}, {o.axial_ctes('coverage', 5000.0, 'celled', 'best_rsrp_dbm')}, hexes as (select q, r, max(best_rsrp_dbm) as v from celled group by q, r),
    grid as (select id as pix, (id%200+0.5e0)*2000e0 as x, 400000e0-(id//200+0.5e0)*2000e0 as y from range(40000) t(id)), {o.axial_ctes('grid', 5000.0, 'gridded', 'pix')},
    burned as (select pix, case when h.q is null then -9999e0 else coalesce(v, -125e0) end as value from gridded g left join hexes h on g.q = h.q and g.r = h.r)"""


def burned_of(spark, d) -> DataFrame:
    """Pixels take the signal of the cell that holds their centre: outside any cell is -9999, a cell without a link -125."""
    q, r = cells.point_to_axial(F.col("x"), F.col("y"), 5000.0)
    hexes = coverage_of(spark, d, 0).groupBy(q.alias("q"), r.alias("r")).agg(F.max("best_rsrp_dbm").alias("v"), F.lit(True).alias("cell"))
    grid = raster.pixel_centres(spark, 200, 200, 0.0, 400_000.0, 2000.0).select("pix", q.alias("q"), r.alias("r"))
    return grid.join(hexes, ["q", "r"], "left").select("pix", F.when(F.col("cell").isNull(), -9999.0).otherwise(F.coalesce("v", F.lit(-125.0))).alias("value"))


@query(f"with {BURN} select pix, round(value, 4) as value from burned")
def rsrp_burn(spark, d):
    return rounded(burned_of(spark, d))


@query(f"with {BURN} select count(*) filter (value > -9000 and value < -105) as gap_px, count(*) filter (value >= -105) as covered_px, count(*) filter (value <= -9000) as outside_px from burned")
def gap_mask(spark, d):
    v = F.col("value")
    return burned_of(spark, d).agg(F.count_if((v > -9000) & (v < -105)).alias("gap_px"), F.count_if(v >= -105).alias("covered_px"), F.count_if(v <= -9000).alias("outside_px"))


@query(f"with {ctes('receivers')} select cell_id, {o.row_sql('y')} as row, {o.col_sql('x')} as col, cast({o.height_sql('x', 'y')} as bigint) as elev, cast({o.class_sql('x', 'y')} as bigint) as land, cast({o.building_sql('x', 'y')} as bigint) as bldg from receivers")
def nearest_sample(spark, d):
    r, c = raster.pixel_of(F.col("x"), F.col("y"), T.x0, T.y0, ROWS, COLS)
    p = frame(spark, d, "receivers").select("cell_id", r.alias("row"), c.alias("col"))
    at = F.element_at(F.array(*[F.lit(k).cast("long") for k in T.classes]), ((F.col("row") * 13 + F.col("col") * 29) % 8 + 1).cast("int"))
    return p.select("cell_id", "row", "col", (200 + F.abs((F.col("col") * 7 + F.col("row") * 3) % 200 - 100)).alias("elev"), at.alias("land"), F.when((F.col("row") * 7 + F.col("col") * 11) % 17 == 0, (F.col("row") + F.col("col")) % 40).otherwise(0).cast("long").alias("bldg"))


@query(f"with {ctes('towers')} select count(*) as towers, round(median(z - s), 4) as median_residual_m, round(quantile_cont(abs(z - s), 0.9), 4) as p90_abs_m from (select {o.height_sql('x', 'y')}::double as z, cast(100+usi%300 as double) as s from towers)")
def terrain_residuals(spark, d):
    """Terrain under towers against their stated ground heights."""
    r, c = raster.pixel_of(F.col("x"), F.col("y"), T.x0, T.y0, ROWS, COLS)
    e = frame(spark, d, "towers").select((200 + F.abs((c * 7 + r * 3) % 200 - 100) - (100 + F.col("usi") % 300)).cast("double").alias("e"))
    return e.agg(F.count("*").alias("towers"), F.round(F.median("e"), 4).alias("median_residual_m"), F.round(F.percentile(F.abs("e"), F.lit(0.9)), 4).alias("p90_abs_m"))


# Siting


def gaps_of(spark, d) -> DataFrame:
    """Receivers without service; they are read several times, the kernel's links behind them are computed once."""
    return coverage_of(spark, d, 0).where("not is_covered").select("cell_id", "x", "y", "demand").cache()


GAPS = o.COVERAGE + ", gaps as (select cell_id, x, y, demand from coverage where not is_covered)"
COLO = f"""colo as (select concat('colo:', asr_id) as cand_id, 'colocation' as kind, x, y, greatest(coalesce(height_agl_m, 45e0), 60e0) as tx_height_m from towers t
    where exists (select 1 from gaps g where (g.x-t.x)*(g.x-t.x)+(g.y-t.y)*(g.y-t.y) <= 2.25e8))"""


@query(f"with {GAPS}, {COLO} select * from colo")
def colocation_candidates(spark, d):
    return siting.colocation(frame(spark, d, "towers"), gaps_of(spark, d))


def parents_of(gaps: DataFrame) -> DataFrame:
    """Blocks that hold a gap, and the pixels of their boxes, a kilometre wider on each side."""
    bx, by = F.floor(F.col("x") / PARENT_M), F.floor(F.col("y") / PARENT_M)
    p = gaps.select(bx.alias("bx"), by.alias("by")).distinct()
    x0, x1, y0, y1 = (F.col(c) * PARENT_M + o for c, o in (("bx", -1000.0), ("bx", PARENT_M + 1000.0), ("by", -1000.0), ("by", PARENT_M + 1000.0)))
    clip = lambda v: F.least(F.lit(SIDE), F.greatest(F.lit(0), v)).cast("long")
    return p.select((F.col("bx") * 1000 + F.col("by")).alias("parent"), clip(F.floor((400455.0 - y1) / PIXEL_M)).alias("row0"), clip(F.ceil((400455.0 - y0) / PIXEL_M)).alias("row1"), clip(F.floor((x0 - 45.0) / PIXEL_M)).alias("col0"), clip(F.ceil((x1 - 45.0) / PIXEL_M)).alias("col1"))


CLIP = lambda v: f"least({SIDE}, greatest(0, {v}))::bigint"
GREEN = f"""blocks as (select distinct floor(x/20000e0) as bx, floor(y/20000e0) as "by" from gaps),
    parents as (select (bx*1000+"by")::bigint as parent, {CLIP('floor((400455e0-("by"*20000e0+21000e0))/90e0)')} as row0, {CLIP('ceil((400455e0-("by"*20000e0-1000e0))/90e0)')} as row1, {CLIP('floor((bx*20000e0-1000e0-45e0)/90e0)')} as col0, {CLIP('ceil((bx*20000e0+21000e0-45e0)/90e0)')} as col1 from blocks),
    boxes as (select parent, row, unnest(range(col0, col1)) as col from (select parent, unnest(range(row0, row1)) as row, col0, col1 from parents)),
    tops as (select parent, max(200+abs((col*7+row*3)%200-100))::bigint as top from boxes group by parent),
    peaks as (select parent, min(row*{SIDE}+col) as pix from boxes join tops using (parent) where 200+abs((col*7+row*3)%200-100) = top group by parent),
    green as (select concat('green:', parent) as cand_id, 'greenfield' as kind, 45e0+(pix%{SIDE})*90e0 as x, 400455e0-(pix//{SIDE})*90e0 as y, 60e0 as tx_height_m from peaks qualify row_number() over (partition by pix order by parent) = 1)"""


def greenfield_of(spark, gaps) -> DataFrame:
    return siting.greenfield(parents_of(gaps), pixels(spark), PIXEL_M)


@query(f"with {GAPS}, {GREEN} select * from green")
def greenfield_candidates(spark, d):
    return greenfield_of(spark, gaps_of(spark, d))


@query(f"with {GAPS}, {COLO}, reach as (select cand_id, sum(demand) as naive_demand from colo c join gaps g on (g.x-c.x)*(g.x-c.x)+(g.y-c.y)*(g.y-c.y) <= 1.6e9 group by cand_id) select c.*, case when (select count(*) from colo) > 10 then round(coalesce(naive_demand, 0e0), 3) end as naive_demand from colo c left join reach using (cand_id) order by coalesce(naive_demand, 0e0) desc, cand_id limit 10")
def naive_demand_topk(spark, d):
    gaps = gaps_of(spark, d)
    return siting.prune(siting.colocation(frame(spark, d, "towers"), gaps), gaps, RADIO.max_link_m, 10).withColumn("naive_demand", F.round("naive_demand", 3))


CPAIRS = "cpairs as (select c.cand_id as tx, g.cell_id as rx, c.x as tx_x, c.y as tx_y, c.tx_height_m as th, g.x as rx_x, g.y as rx_y from colo c, gaps g where (g.x-c.x)*(g.x-c.x)+(g.y-c.y)*(g.y-c.y) <= 1.6e9)"


def cover_of(spark, d, gaps) -> DataFrame:
    c = siting.colocation(frame(spark, d, "towers"), gaps)
    g = gaps.select(F.col("cell_id").alias("gap_id"), "x", "y")
    return blocks.links(c, g, kernel.FormulaTerrain(), "cand_id", "gap_id", RADIO, RADIO.threshold_dbm)


@query(f"with {GAPS}, {COLO}, {CPAIRS}, {o.kernel_ctes('cpairs', 'cover')} select asr_id as cand_id, cell_id as gap_id, round(rsrp_dbm, 4) as rsrp_dbm from cover where rsrp_dbm >= -105e0")
def cover_pairs(spark, d):
    return cover_of(spark, d, gaps_of(spark, d)).select("cand_id", "gap_id", F.round("rsrp_dbm", 4).alias("rsrp_dbm"))


SETS = ctes("cover_sets", "cover_gaps")
SITES = Config().siting.sites


@query(f"with {SETS} select count(*) as gaps, sum(demand) as demand from cover_gaps where gap_id in (select gap_id from cover_sets)")
def reachable_ceiling(spark, d):
    return siting.reachable(frame(spark, d, "cover_sets"), frame(spark, d, "cover_gaps"))


def greedy_ctes(weight: str, n: int, p: str) -> str:
    """``n`` greedy picks, one after another, each computed once: CTEs ``p``1 ... ``p``n of (cand_id, gain)."""
    out = [f"{p}d as materialized (select cand_id, gap_id, {weight} as d from cover_sets join cover_gaps using (gap_id))"]
    for k in range(1, n + 1):
        taken = " union all ".join(f"select cand_id from {p}{j}" for j in range(1, k))
        open_ = f"{p}d" if k == 1 else f"(select * from {p}d where gap_id not in (select gap_id from {p}d where cand_id in ({taken})))"
        out.append(f"{p}{k} as materialized (select cand_id, sum(d) as gain from {open_} group by cand_id having sum(d) > 0 order by gain desc, cand_id limit 1)")
    return ", ".join(out)


@query(f"""with {SETS}, {greedy_ctes('demand', SITES, 'g')}, picks as ({' union all '.join(f'select {k}::bigint as greedy_rank, cand_id, gain as marginal_demand from g{k}' for k in range(1, SITES + 1))})
    select *, sum(marginal_demand) over (order by greedy_rank) as cumulative_demand from picks""")
def greedy_sites(spark, d):
    return siting.greedy(frame(spark, d, "cover_sets"), frame(spark, d, "cover_gaps"), SITES)


WEIGHTS_TRIED = (0.0, 1000.0, 3000.0)


def sensitivity_sql(n: int = SITES) -> str:
    parts = [greedy_ctes(f"demand+{w!r}*poi", n, f"w{i}_") for i, w in enumerate(WEIGHTS_TRIED)]
    picks = lambda i: "(" + " union all ".join(f"select cand_id from w{i}_{k}" for k in range(1, n + 1)) + ")"
    rows = " union all ".join(f"select {w!r}::double as weight, (select count(*) from {picks(i)}) as sites, (select count(*) from {picks(i)} a where cand_id in {picks(1)}) as shared" for i, w in enumerate(WEIGHTS_TRIED))
    return f"with {SETS}, {', '.join(parts)} {rows}"


@query(sensitivity_sql())
def tourism_sensitivity(spark, d):
    """How many sites each tourism weight shares with the configured weight's plan."""
    sets, gaps = frame(spark, d, "cover_sets"), frame(spark, d, "cover_gaps")
    plans = [(w, siting.greedy(sets, gaps, SITES, F.col("demand") + w * F.col("poi")).select("cand_id")) for w in WEIGHTS_TRIED]
    base = plans[1][1]
    out = None
    for w, p in plans:
        row = p.agg(F.lit(w).alias("weight"), F.count("*").alias("sites")).join(p.intersect(base).agg(F.count("*").alias("shared"), F.lit(w).alias("weight")), "weight").select("weight", "sites", "shared")
        out = row if out is None else out.unionByName(row)
    return out


@query()
def exact_sites(spark, d):
    """The configured number of sites over the kernel's cover, and whether they are proven best; branch and bound has no SQL form."""
    gaps = gaps_of(spark, d).select(F.col("cell_id").alias("gap_id"), "x", "y", "demand")
    cover = cover_of(spark, d, gaps.withColumnRenamed("gap_id", "cell_id"))
    return siting.exact_sites(cover, gaps, SITES).agg(F.coalesce(F.max("total_demand"), F.lit(0.0)).alias("total_demand"), F.coalesce(F.bool_and("proven"), F.lit(True)).alias("proven"), F.count("*").alias("sites"))


RING = [(120_000.0, 120_000.0), (280_000.0, 140_000.0), (260_000.0, 290_000.0), (110_000.0, 260_000.0)]


def ring_sql() -> tuple[str, str]:
    cross, near = [], []
    for (x0, y0), (x1, y1) in zip(RING, RING[1:] + RING[:1], strict=True):
        cross.append(f"((({y0!r} > y) <> ({y1!r} > y)) and x < {x1 - x0!r}*(y-{y0!r})/{y1 - y0!r}+{x0!r})::int")
        dx, dy = x1 - x0, y1 - y0
        t = f"least(1e0, greatest(0e0, ((x-{x0!r})*{dx!r}+(y-{y0!r})*{dy!r})/{dx * dx + dy * dy!r}))"
        near.append(f"sqrt(pow(x-({x0!r}+{t}*{dx!r}), 2)+pow(y-({y0!r}+{t}*{dy!r}), 2))")
    return f"(({'+'.join(cross)})%2=1)", f"least({', '.join(near)})"


@query(f"with {ctes('towers')} select asr_id, {ring_sql()[0]} as nrqz, round(case when {ring_sql()[0]} then 0e0 else {ring_sql()[1]} end, 3) as zone_distance_m from towers")
def nrqz_flag(spark, d):
    x, y = F.col("x"), F.col("y")
    return frame(spark, d, "towers").select("asr_id", polygon.contains(RING, x, y).alias("nrqz"), F.round(polygon.distance(RING, x, y), 3).alias("zone_distance_m"))


# Validation by speed tests


def qk_sql(z: int) -> str:
    n = 1 << z
    x = f"least({n - 1}, greatest(0, floor((lon+180e0)/360e0*{n})))::bigint"
    y = f"least({n - 1}, greatest(0, floor((1-asinh(tan(radians(lat)))/pi())/2*{n})))::bigint"
    bits = "||".join(f"cast(((tx>>{i})&1)+2*((ty>>{i})&1) as varchar)" for i in range(z - 1, -1, -1))
    return f"keyed as (select *, {bits} as quadkey from (select *, {x} as tx, {y} as ty from speedtests))"


@query(f"with {ctes('speedtests')}, {qk_sql(16)} select event_id, tx as tile_x, ty as tile_y, quadkey from keyed")
def quadkey(spark, d):
    x, y = formulas.tile_xy(F.col("lon"), F.col("lat"), 16)
    return frame(spark, d, "speedtests").select("event_id", x.alias("tile_x"), y.alias("tile_y"), formulas.quadkey(x, y, 16).alias("quadkey"))


PREFIXES = f"""edges as (select * from (values (-82.6e0, 40.6e0), (-77.7e0, 37.2e0)) t(lon, lat)), {qk_sql(8).replace('keyed as', 'corner as').replace('from speedtests', 'from edges')}, span as (select min(tx) as x0, max(tx) as x1, min(ty) as y0, max(ty) as y1 from corner),
    tiles as (select tx, ty from span, range(256) s(tx), range(256) t(ty) where tx between x0 and x1 and ty between y0 and y1), prefixes as (select {"||".join(f"cast(((tx>>{i})&1)+2*((ty>>{i})&1) as varchar)" for i in range(7, -1, -1))} as prefix from tiles)"""


@query(f"with {PREFIXES} select prefix from prefixes")
def quadkey_prefixes(spark, d):
    """Keys at zoom 8 that cover a box: its north edge has the smallest y."""
    x0, y0 = formulas.tile_xy(F.lit(-82.6), F.lit(40.6), 8)
    x1, y1 = formulas.tile_xy(F.lit(-77.7), F.lit(37.2), 8)
    t = spark.range(1).select(F.explode(F.sequence(x0, x1)).alias("x"), y0.alias("y0"), y1.alias("y1")).select("x", F.explode(F.sequence("y0", "y1")).alias("y"))
    return t.select(formulas.quadkey(F.col("x"), F.col("y"), 8).alias("prefix"))


@query(f"with {ctes('speedtests')}, {PREFIXES}, {qk_sql(16)} select quadkey, count(*) as tiles, sum(tests)::bigint as tests, sum(devices)::bigint as devices, round(sum(d_kbps*tests)/sum(tests), 3) as d_kbps from keyed where substr(quadkey, 1, 8) in (select prefix from prefixes) group by 1")
def speedtest_cells(spark, d):
    """Tiles under all prefixes of the box."""
    prefixes = [r["prefix"] for r in quadkey_prefixes(spark, d).collect()]
    return rounded(demand.speedtest_cells(frame(spark, d, "speedtests"), prefixes=prefixes), 3)


TESTED = f"""{o.axial_ctes('speedtests', 5000.0, 'placed', 'tests, devices')}, {o.axial_ctes('coverage', 5000.0, 'celled', 'cell_id, is_covered')},
    per as (select q, r, sum(tests)::bigint as tests, sum(devices)::bigint as devices from placed group by q, r), tested as (select cell_id, is_covered, coalesce(tests, 0) as tests, coalesce(devices, 0) as devices from celled left join per using (q, r))"""


def tests_of(spark, d, receivers) -> DataFrame:
    """(cell_id, tests, devices): all speed tests in the hexagon of each receiver."""
    cell = cells.cell_id(*cells.point_to_axial(F.col("x"), F.col("y"), 5000.0), 8).alias("cell")
    per = frame(spark, d, "speedtests").groupBy(cell).agg(F.sum("tests").alias("tests"), F.sum("devices").alias("devices"))
    return receivers.select("cell_id", cell).join(per, "cell").drop("cell")


@query(f"""with {o.COVERAGE}, {ctes('speedtests')}, {TESTED}, m as (select is_covered, tests, devices, n from tested, (values (1), (5), (20)) t(n)),
    a as (select n as min_tests, count(*) filter (not is_covered and tests>=n and devices>=2) as gap_hit, count(*) filter (not is_covered) as gap_cells, count(*) filter (is_covered and tests>=n and devices>=2) as control_hit, count(*) filter (is_covered) as control_cells from m group by n)
    select *, round(gap_hit/greatest(1, gap_cells)::double, 4) as gap_rate, round(control_hit/greatest(1, control_cells)::double, 4) as control_rate, case when control_hit/greatest(1, control_cells)::double < 0.1 then 'not usable' else 'lower bound' end as verdict from a""")
def false_negative_rate(spark, d):
    return rounded(demand.false_negatives(coverage_of(spark, d, 0), tests_of(spark, d, frame(spark, d, "receivers")), "cell_id"))


# Publishing


@query(f"with {o.BANDED} select band, count(*) as cells, cast(round_even(sum(pop), 0) as bigint) as population from banded group by band")
def service_bands(spark, d):
    # The highest band begins at five servers.
    return coverage.band_summary(coverage_of(spark, d, 5))


def _lod(up: int, size: float = 2000.0):
    bands = ", ".join(f"count(*) filter (band='{b}') as cells_{b}, round(coalesce(sum(pop) filter (band='{b}'), 0), 4) as pop_{b}" for b in coverage.BANDS)
    k = 3**up
    parent_sql = o.cell_sql(f"floor(q/{k}e0)::bigint", f"floor(r/{k}e0)::bigint", 8 - up)
    sql = f"""with {o.BANDED}, {o.axial_ctes('banded', size, 'celled', 'pop, demand, is_covered, band, best_rsrp_dbm, n_servers')}
        select {parent_sql} as parent, round(sum(pop), 4) as pop, round(coalesce(sum(pop) filter (is_covered), 0), 4) as cov_pop, round(sum(demand), 4) as demand, count(*) as cells, count(*) filter (is_covered) as cov_cells, round(avg(n_servers), 4) as n_srv, round(median(best_rsrp_dbm), 4) as rsrp,
        {bands}, round(case when sum(pop) > 0 then 100e0*coalesce(sum(pop) filter (is_covered), 0)/sum(pop) end, 4) as pop_pct, round(100e0*count(*) filter (is_covered)/count(*), 4) as cell_pct, round(sum(pop)/(count(*)*0.737e0), 4) as pop_km2 from celled group by 1"""

    def run(spark, d):
        q, r = cells.point_to_axial(F.col("x"), F.col("y"), size)
        c = coverage.with_band(coverage_of(spark, d, blocks.ALL)).withColumn("cell", cells.cell_id(q, r, 8))
        return rounded(coverage.roll_up(c, cells.parent(F.col("cell"), 8, up)), 4)

    query(sql, f"lod_rollup_r{8 - up}")(run)


for _up in (1, 2, 3):
    _lod(_up)


#: Footprints keep links down to here.
FOOTPRINT_FLOOR = -115.0


def named():
    """Every tenth transmitter is a new one."""
    new = F.substring("asr_id", 2, 20).cast("long") % 10 == 0
    return F.when(new, F.concat(F.lit("NEW:"), "asr_id")).otherwise(F.col("asr_id"))


FOOTPRINTS = "foot as (select * replace (case when cast(substr(asr_id, 2) as bigint)%10=0 then concat('NEW:', asr_id) else asr_id end as asr_id) from links where rsrp_dbm >= -115e0)"


@query(f"""with {o.COVERAGE}, {FOOTPRINTS}, per as (select asr_id, count(*) as n, count(*) filter (rsrp_dbm >= -105) as n_served, cast(round_even(coalesce(sum(pop) filter (rsrp_dbm >= -105), 0), 0) as bigint) as pop_served from foot join receivers using (cell_id) group by asr_id)
    select asr_id, (coalesce(sum(n) over (order by asr_id rows between unbounded preceding and 1 preceding), 0)*12)::bigint as "offset", n, n_served, pop_served from per""")
def footprint_index(spark, d):
    t = transmitters_of(spark, d).withColumn("asr_id", named())
    per = blocks.per_transmitter(t, frame(spark, d, "receivers"), kernel.FormulaTerrain(), "asr_id", "cell_id", RADIO, FOOTPRINT_FLOOR)
    return publish.offsets(per.withColumn("pop_served", F.rint("served").cast("long")), "asr_id")


@query()
def footprint_blob(spark, d):
    """Records of existing and new transmitters."""
    t = transmitters_of(spark, d).withColumn("asr_id", named())
    return blocks.footprints(t, frame(spark, d, "receivers"), kernel.FormulaTerrain(), "asr_id", "cell_id", RADIO, FOOTPRINT_FLOOR)


@query(f"""with {o.LINKS}, {FOOTPRINTS} select asr_id, row_number() over (partition by asr_id order by rsrp_dbm desc, cell_id) - 1 as place, cell_id, greatest(-128, least(127, round_even(rsrp_dbm, 0)))::bigint as rsrp,
    least(255, round_even(diffraction_db, 0))::bigint as diff, least(255, round_even(clutter_db, 0))::bigint as clut, is_los as los from foot""")
def footprint_records(spark, d):
    """What the published blobs hold, record by record in their order."""
    return publish.unpacked(footprint_blob(spark, d), "asr_id")


@query(f"with {o.LINKS}, per as (select asr_id, count(*) as n from links group by asr_id) select count(*) as transmitters, cast(median(n) as double) as median_n, quantile_cont(n, 0.95) as p95_n, max(n) as max_n from per")
def footprint_sizes(spark, d):
    per = blocks.per_transmitter(transmitters_of(spark, d), frame(spark, d, "receivers"), kernel.FormulaTerrain(), "asr_id", "cell_id", RADIO)
    return per.agg(F.count("*").alias("transmitters"), F.median("n").alias("median_n"), F.percentile("n", F.lit(0.95)).alias("p95_n"), F.max("n").alias("max_n"))


NEW = "select case when cast(substr(asr_id, 2) as bigint)%10=0 then concat('NEW:', asr_id) else asr_id end as asr_id, cell_id, rsrp_dbm from links"


def surfaces_of(spark, d) -> DataFrame:
    best = best_of(spark, d, transmitters_of(spark, d).withColumn("asr_id", named()), 0, "NEW:")
    return best.select("cell_id", F.col("best_rsrp_dbm").alias("rsrp_all"), F.col("old_rsrp_dbm").alias("rsrp_cur"))


@query(f"with {o.LINKS}, named as ({NEW}) select cell_id, round(max(rsrp_dbm), 4) as rsrp_all, round(max(rsrp_dbm) filter (asr_id not like 'NEW:%'), 4) as rsrp_cur from named group by cell_id")
def surface_two_in_one(spark, d):
    return rounded(surfaces_of(spark, d))


@query(f"with {o.LINKS}, named as ({NEW}), s as (select max(rsrp_dbm) as a, max(rsrp_dbm) filter (asr_id not like 'NEW:%') as c from named group by cell_id) select count(*) as pixels, round(avg((coalesce(c, -125e0) >= -105)::int), 4) as cov_current, round(avg((coalesce(a, -125e0) >= -105)::int), 4) as cov_upgraded, count(*) filter (coalesce(c, -125e0) < -105 and a >= -105) as newly from s")
def newly_covered(spark, d):
    return rounded(coverage.newly_covered(surfaces_of(spark, d)))


@query(f"with {GAPS}, {COLO} select asr_id as tx_id, x, y, coalesce(height_agl_m, 45e0) as tx_height_m from towers union all select concat('NEW:', cand_id), x, y, tx_height_m from colo")
def union_transmitters(spark, d):
    t = frame(spark, d, "towers")
    new = siting.colocation(t, gaps_of(spark, d)).select(F.concat(F.lit("NEW:"), "cand_id").alias("tx_id"), "x", "y", "tx_height_m")
    return t.select(F.col("asr_id").alias("tx_id"), "x", "y", F.coalesce("height_agl_m", F.lit(RADIO.default_tx_height_m)).alias("tx_height_m")).unionByName(new)


@query(f"""with {ctes('towers')} select concat('{{"type":"Feature","geometry":{{"type":"Point","coordinates":[', usi, ',', usi+1, ']}},"properties":{{"asr_id":"', asr_id, '"', case when height_agl_m is null then '' else concat(',"height":', cast(height_agl_m as bigint)) end, '}}}}') as value from towers""")
def geojson_features(spark, d):
    t = frame(spark, d, "towers").withColumn("height", F.col("height_agl_m").cast("long")).withColumn("next", F.col("usi") + 1)
    return publish.geojson(t, publish.point("usi", "next"), ["asr_id", "height"])


@query(f"with {ctes('places')} select name, place_id, x, y from places where x between 100000e0 and 300000e0 and y between 100000e0 and 300000e0")
def gazetteer(spark, d):
    places = publish.gazetteer(frame(spark, d, "places"), "name", "x", "y", (100_000.0, 100_000.0, 300_000.0, 300_000.0))
    return publish.require_rows(places, "gazetteer").select("name", "place_id", "x", "y")
