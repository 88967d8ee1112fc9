"""DuckDB text of the link kernel and what is built on it."""

from __future__ import annotations

from ridgecast.plans.fixtures import ctes

K2R = 2.0 * 1.333 * 6371000.0
WAVE = 299792458.0 / 700e6


def height_sql(x: str, y: str) -> str:
    return f"(200 + abs(({col_sql(x)}*7 + {row_sql(y)}*3)%200 - 100))"


def col_sql(x: str) -> str:
    return f"least(4449, greatest(0, cast(round_even(({x}-45e0)/90e0, 0) as bigint)))"


def row_sql(y: str) -> str:
    return f"least(4449, greatest(0, cast(round_even((400455e0-{y})/90e0, 0) as bigint)))"


def class_sql(x: str, y: str) -> str:
    return f"[10,20,30,40,50,60,80,90][1 + ({row_sql(y)}*13 + {col_sql(x)}*29)%8]"


def building_sql(x: str, y: str) -> str:
    return f"(case when ({row_sql(y)}*7 + {col_sql(x)}*11)%17=0 then ({row_sql(y)} + {col_sql(x)})%40 else 0 end)"


def knife_sql(v: str) -> str:
    return f"(case when {v} > -0.78e0 then greatest(0e0, 6.9e0 + 20e0*log10(sqrt(({v}-0.1e0)*({v}-0.1e0)+1e0)+({v}-0.1e0))) else 0e0 end)"


def kernel_ctes(pairs: str, name: str = "links_all") -> str:
    """Links of ``pairs`` (tx, rx, tx_x, tx_y, th, rx_x, rx_y): a row per sample, the worst edge, the worst on either side."""
    p = name + "_"
    edge = lambda a, b, near, far: (f"((e + ({a})*({b})/{K2R!r}) - ({near} + (({far}) - ({near}))*(({a})/(({a})+({b})))))", f"sqrt(2e0*(({a})+({b}))/({WAVE!r}*({a})*({b})))")
    h, s = edge("d1", "d - d1", "z0", "z1")
    hl, sl = edge("d1", "dp - d1", "z0", "zp")
    hr, sr = edge("d1 - dp", "(d - dp) - (d1 - dp)", "zp", "z1")
    clutter = "case {c} when 10 then 12e0 when 20 then 5e0 when 50 then 15e0 when 90 then 2e0 when 95 then 2e0 else 0e0 end"
    b = building_sql("rx_x", "rx_y")
    v_b = f"(({b}-1.5e0)*sqrt(2e0/({WAVE!r}*15e0)))"
    return f"""
    {p}s as (select tx, rx, i, d, d*f as d1, {height_sql("(tx_x+(rx_x-tx_x)*f)", "(tx_y+(rx_y-tx_y)*f)")}::double as e, th,
        {clutter.format(c=class_sql("rx_x", "rx_y"))} as cl, case when {b} > 1.5e0 then least({knife_sql(v_b)}, 30e0) else 0e0 end as bl
        from (select *, sqrt((rx_x-tx_x)*(rx_x-tx_x)+(rx_y-tx_y)*(rx_y-tx_y)) as d from {pairs}), (select i, case when i=127 then 1e0 else i*(1e0/127e0) end as f from range(128) t(i))),
    {p}z as (select *, first_value(e) over w + th as z0, last_value(e) over w + 1.5e0 as z1 from {p}s window w as (partition by tx, rx order by i rows between unbounded preceding and unbounded following)),
    {p}h as (select *, case when i between 1 and 126 then {h} end as h from {p}z),
    {p}v as (select *, case when h > 0 then h*{s} end as v from {p}h),
    {p}m as (select tx, rx, any_value(d) as d, any_value(cl) as cl, any_value(bl) as bl, max(v) as v, arg_max(i, v) as p, arg_max(d1, v) as dp, arg_max(e, v) as zp from {p}v group by tx, rx),
    {p}w as (select a.tx, a.rx, case when a.i < m.p then {hl} end as hl, case when a.i < m.p then {sl} end as sl, case when a.i > m.p then {hr} end as hr, case when a.i > m.p then {sr} end as sr
        from {p}z a join (select tx, rx, p, dp, zp from {p}m where v is not null) m using (tx, rx) where a.i between 1 and 126 and a.i <> m.p),
    {p}e as (select tx, rx, max(case when hl > 0 then hl*sl end) as vl, max(case when hr > 0 then hr*sr end) as vr from {p}w group by tx, rx),
    {p}l as (select tx, rx, d, v is null as is_los, greatest(cl, bl) as clutter_db,
        20e0*log10(greatest(d, 1e0)/1000e0) + 20e0*log10(700e0) + 32.44e0 as free,
        coalesce({knife_sql("v")}, 0e0) + coalesce({knife_sql("vl")}, 0e0) + coalesce({knife_sql("vr")}, 0e0) as diffraction_db from {p}m left join {p}e using (tx, rx)),
    {name} as (select tx as asr_id, rx as cell_id, 60e0 - 10e0*log10(600e0) - free - diffraction_db - clutter_db - 8e0 as rsrp_dbm, free + diffraction_db + clutter_db as path_loss_db,
        diffraction_db, clutter_db, d as distance_m, is_los from {p}l)"""


PAIRS = """pairs as (select t.asr_id as tx, r.cell_id as rx, t.x as tx_x, t.y as tx_y, coalesce(t.height_agl_m, 45e0) as th, r.x as rx_x, r.y as rx_y
    from towers t, receivers r where (r.x-t.x)*(r.x-t.x)+(r.y-t.y)*(r.y-t.y) <= 1.6e9)"""
BASE = ctes("towers", "receivers") + ", " + PAIRS
LINKS = BASE + ", " + kernel_ctes("pairs") + ", links as (select * from links_all where rsrp_dbm >= -125e0)"
COVERAGE = (
    LINKS
    + """, best as (select cell_id, max(rsrp_dbm) as best_rsrp_dbm, count(*) as n_links, count(*) filter (rsrp_dbm >= -105e0) as n_servers from links group by cell_id),
    one as (select cell_id, asr_id as best_asr_id, is_los as best_is_los, distance_m as best_distance_m from links qualify row_number() over (partition by cell_id order by rsrp_dbm desc, asr_id) = 1),
    coverage as (select r.*, best_rsrp_dbm, best_asr_id, best_is_los, best_distance_m, coalesce(n_links, 0) as n_links, coalesce(n_servers, 0) as n_servers,
        coalesce(best_rsrp_dbm >= -105e0, false) as is_covered from receivers r left join best using (cell_id) left join one using (cell_id))"""
)
BANDED = COVERAGE + ", banded as (select *, case when best_rsrp_dbm is null and n_servers < 1 then 'no_link' when n_servers < 1 then 'gap' when n_servers = 1 then 'single' when n_servers <= 4 then 'multi' else 'over' end as band from coverage)"


def axial_ctes(source: str, size: float, name: str, keep: str) -> str:
    """``name`` with q, r of the hexagon of corner radius ``size`` that holds each point of ``source``."""
    return f"""{name}_f as (select *, (sqrt(3e0)/3e0*x - y/3e0)/{size!r} as fq, (2e0/3e0*y)/{size!r} as fr from {source}),
    {name}_r as (select *, round_even(fq, 0) as rq, round_even(fr, 0) as rr, round_even(-fq-fr, 0) as rs from {name}_f),
    {name} as (select {keep}, cast(case when abs(rq-fq) > abs(rr-fr) and abs(rq-fq) > abs(rs-(-fq-fr)) then -rr-rs else rq end as bigint) as q,
        cast(case when not (abs(rq-fq) > abs(rr-fr) and abs(rq-fq) > abs(rs-(-fq-fr))) and abs(rr-fr) > abs(rs-(-fq-fr)) then -rq-rs else rr end as bigint) as r from {name}_r)"""


def cell_sql(q: str, r: str, level: int) -> str:
    return f"({level}*4398046511104 + ({q}+1048576)*2097152 + ({r}+1048576))"
