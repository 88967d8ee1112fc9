"""Registered queries, continued: pixel surfaces, areas with buffers, projected rings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgecast.functions import formulas, polygon
from ridgecast.operators import coverage, kernel, raster, spatial
from ridgecast.plans import oracle as o
from ridgecast.plans import relational as r
from ridgecast.plans.fixtures import ctes, frame
from ridgecast.plans.relational import RADIO, query, rounded

#: The surface's grid: pixels on a side, and their width in metres.
GRID, GRID_M = 100, 4000.0
PIXEL_PAIRS = f"""grid as (select id as pix, (id%{GRID}+0.5e0)*{GRID_M!r} as x, 400000e0-(id//{GRID}+0.5e0)*{GRID_M!r} as y from range({GRID * GRID}) t(id)),
    ppairs as (select asr_id as tx, pix as rx, t.x as tx_x, t.y as tx_y, coalesce(height_agl_m, 45e0) as th, g.x as rx_x, g.y as rx_y from towers t, grid g where (g.x-t.x)*(g.x-t.x)+(g.y-t.y)*(g.y-t.y) <= 1.6e9)"""


@query(f"""with {ctes('towers')}, {PIXEL_PAIRS}, {o.kernel_ctes('ppairs', 'reached')}, named as (select cell_id, case when cast(substr(asr_id, 2) as bigint)%10=0 then concat('NEW:', asr_id) else asr_id end as asr_id, rsrp_dbm from reached where rsrp_dbm >= -125e0)
    select cell_id as pix, round(max(rsrp_dbm), 4) as rsrp_all, round(max(rsrp_dbm) filter (asr_id not like 'NEW:%'), 4) as rsrp_cur from named group by cell_id""")
def surface_pixels(spark, d):
    """Best signal at every pixel that any transmitter reaches, of all and of existing ones: transmitters meet pixels by blocks of the link radius."""
    t = frame(spark, d, "towers").select("asr_id", "x", "y", F.coalesce("height_agl_m", F.lit(RADIO.default_tx_height_m)).alias("tx_height_m"))
    t = t.withColumn("asr_id", F.when(F.substring("asr_id", 2, 20).cast("long") % 10 == 0, F.concat(F.lit("NEW:"), "asr_id")).otherwise(F.col("asr_id")))
    grid = raster.pixel_centres(spark, GRID, GRID, 0.0, 400_000.0, GRID_M).select("pix", "x", "y")
    p = spatial.distance_join(t, grid, RADIO.max_link_m)
    p = p.select("asr_id", F.col("r_pix").alias("pix"), F.col("x").alias("tx_x"), F.col("y").alias("tx_y"), "tx_height_m", F.col("r_x").alias("rx_x"), F.col("r_y").alias("rx_y"))
    return rounded(coverage.two_surfaces(kernel.links(p, kernel.FormulaTerrain(), "asr_id", "pix", RADIO), "pix", "asr_id"))


BUFFER_M = 20_000.0


@query(f"with {ctes('towers', 'counties')} select asr_id from towers t where exists (select 1 from counties c where state = 2 and sqrt(pow(greatest(xmin-x, x-xmax, 0e0), 2)+pow(greatest(ymin-y, y-ymax, 0e0), 2)) <= {BUFFER_M!r})")
def area_of_interest(spark, d):
    """Towers in the areas of one state or within a buffer around any of them; areas meet the grid cells that their buffered boxes touch."""
    cell = 80_000.0
    at = lambda v: F.floor(v / cell)
    c = frame(spark, d, "counties").where("state = 2")
    c = c.withColumn("gx", F.explode(F.sequence(at(F.col("xmin") - BUFFER_M), at(F.col("xmax") + BUFFER_M)))).withColumn("gy", F.explode(F.sequence(at(F.col("ymin") - BUFFER_M), at(F.col("ymax") + BUFFER_M))))
    t = frame(spark, d, "towers").select("asr_id", "x", "y", at(F.col("x")).alias("gx"), at(F.col("y")).alias("gy"))
    near = polygon.box_distance(t["x"], t["y"], c["xmin"], c["ymin"], c["xmax"], c["ymax"]) <= BUFFER_M
    return t.join(c, (t["gx"] == c["gx"]) & (t["gy"] == c["gy"]) & near, "left_semi").select("asr_id")


#: A box in degrees whose long edges bend when projected.
CORNERS = [(-80.5, 37.5), (-78.5, 37.5), (-78.5, 39.25), (-80.5, 39.25)]
EDGES_SQL = "edges as (select * from (values " + ", ".join(f"({i}, {a[0]!r}::double, {a[1]!r}::double, {b[0]!r}::double, {b[1]!r}::double)" for i, (a, b) in enumerate(zip(CORNERS, CORNERS[1:] + CORNERS[:1], strict=True))) + ") t(edge, lon0, lat0, lon1, lat1))"
STEP = 0.25


def albers_sql(lon: str, lat: str) -> tuple[str, str]:
    s = f"sin(radians({lat}))"
    q = f"({1 - formulas.E2!r}*({s}/(1-{formulas.E2!r}*{s}*{s}) - ln((1-{formulas.E1!r}*{s})/(1+{formulas.E1!r}*{s}))/{2 * formulas.E1!r}))"
    rho = f"({formulas.A!r}*sqrt({formulas.CONST!r}-{formulas.CONE!r}*{q})/{formulas.CONE!r})"
    theta = f"({formulas.CONE!r}*(radians({lon})-({formulas.LAM0!r})))"
    return f"{rho}*sin({theta})", f"{formulas.RHO0!r}-{rho}*cos({theta})"


@query(f"""with {EDGES_SQL}, sized as (select *, greatest(1, ceil(greatest(abs(lon1-lon0), abs(lat1-lat0))/{STEP!r}))::int as n from edges),
    points as (select edge, i, lon0+(lon1-lon0)*i/n as lon, lat0+(lat1-lat0)*i/n as lat from sized, lateral (select unnest(range(n)) as i))
    select row_number() over (order by edge, i) - 1 as place, round({albers_sql('lon', 'lat')[0]}, 3) as x, round({albers_sql('lon', 'lat')[1]}, 3) as y from points""")
def projected_zone(spark, d):
    """The zone's ring in metres, with points along its edges, for a parallel is no straight line in the projection."""
    ring = [(i, x, y) for i, (x, y) in enumerate(polygon.densify(CORNERS, STEP))]
    x, y = formulas.albers(F.col("lon"), F.col("lat"))
    return spark.createDataFrame(ring, "place long, lon double, lat double").select("place", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))
