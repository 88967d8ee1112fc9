"""How the domain's tables are made from the provided ones: the same SQL for Spark and for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names of the provided tables stand in braces.
SQL = {
    "towers": """select concat('S', s_suppkey) as asr_id, cast(((s_suppkey+7)*15485863)%400009 as double)+0.37e0 as x,
        cast(((s_suppkey+7)*32452843)%400033 as double)+0.37e0 as y,
        case when s_suppkey%7=0 then null else cast(30+s_suppkey%90 as double) end as height_agl_m, s_suppkey as usi from {supplier}""",
    "receivers": """select c_custkey as cell_id, cast(((c_custkey+101)*49979687)%400031 as double)+0.61e0 as x,
        cast(((c_custkey+101)*67867967)%400067 as double)+0.61e0 as y, c_nationkey as county, greatest(c_acctbal, 0e0) as pop,
        cast(c_nationkey-12 as double)/100e0 as growth, cast(c_custkey%5 as double) as poi_score,
        greatest(c_acctbal, 0e0)*(1e0+cast(c_nationkey-12 as double)/100e0)+1000e0*cast(c_custkey%5 as double) as demand from {customer}""",
    "counties": """select n_nationkey as county, n_regionkey as state, cast((n_nationkey%5)*80000 as double) as xmin,
        cast((n_nationkey%5+1)*80000 as double) as xmax, cast(cast(floor(n_nationkey/5) as int)*80000 as double) as ymin,
        cast((cast(floor(n_nationkey/5) as int)+1)*80000 as double) as ymax from {nation}""",
    "county_vintages": """select c_nationkey as county, cast(year(o_orderdate) as int) as vintage, count(*) as pop
        from {orders} join {customer} on o_custkey=c_custkey group by c_nationkey, year(o_orderdate)""",
    "places": """select p_partkey as place_id, p_name as name, p_type as category, cast(((p_partkey+13)*86028121)%400009 as double)+0.29e0 as x,
        cast(((p_partkey+13)*104395301)%400033 as double)+0.29e0 as y,
        case when p_partkey%5=0 then null else p_size*1.5e0 end as height from {part}""",
    "speedtests": """select event_id, user_id, ts, -82.6e0+cast((event_id*7919)%4900 as double)/1000e0 as lon, cast((event_id*7919)%4900 as double)/4900e0*400000e0 as x, cast((event_id*104729)%3400 as double)/3400e0*400000e0 as y,
        37.2e0+cast((event_id*104729)%3400 as double)/1000e0 as lat, 1+event_id%9 as tests, 1+event_id%3 as devices, value*100e0 as d_kbps from {events}""",
    "cover_sets": "select distinct l_suppkey as cand_id, l_orderkey as gap_id from {lineitem}",
    "cover_gaps": "select distinct l_orderkey as gap_id, cast(1+l_orderkey%7 as double) as demand, cast(l_orderkey%3 as double) as poi from {lineitem}",
}
TABLES = ("supplier", "customer", "nation", "orders", "part", "events", "lineitem")
PARENT_M = 20_000.0


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in SQL[name]}
    return spark.sql(SQL[name], **used)


def ctes(*names: str) -> str:
    """``name as (...)`` for each name, for DuckDB."""
    return ", ".join(f"{n} as ({SQL[n].format(**{t: t for t in TABLES})})" for n in names)


#: Pixels of the test terrain on a side, and their width in metres.
SIDE, PIXEL_M = 4450, 90.0


def pixels(spark: SparkSession) -> DataFrame:
    """Every pixel of the test terrain: row, col, x, y, z."""
    p = spark.range(SIDE * SIDE).select(F.expr(f"id div {SIDE}").alias("row"), F.expr(f"id % {SIDE}").alias("col"))
    return p.select("row", "col", (45.0 + F.col("col") * PIXEL_M).alias("x"), (400455.0 - F.col("row") * PIXEL_M).alias("y"), (200 + F.abs((F.col("col") * 7 + F.col("row") * 3) % 200 - 100)).alias("z"))
