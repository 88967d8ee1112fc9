"""Operators against brute force and hand-made cases."""

import io
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgecast import config
from ridgecast.functions import cells, formulas, polygon
from ridgecast.operators import checks, coverage, demand, kernel, publish, raster, siting, spatial
from ridgecast.sources import geo, text, tiff


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_distance_join_equals_naive_join_and_has_no_nested_loop(spark):
    rng = np.random.default_rng(3)
    a = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-500, 500, (60, 2)))], "id int, x double, y double")
    b = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-500, 500, (80, 2)))], "id int, x double, y double")
    got = spatial.distance_join(a, b, 120.0)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    naive = {(p.id, q.id) for p in a.collect() for q in b.collect() if (p.x - q.x) ** 2 + (p.y - q.y) ** 2 <= 120**2}
    rows = [(r.id, r.r_id) for r in got.collect()]
    assert set(rows) == naive and len(rows) == len(naive)
    assert spatial.distance_join(a.limit(0), b, 10.0).count() == 0


def test_best_server_keeps_every_receiver_and_breaks_ties_by_id(spark):
    links = spark.createDataFrame([("b", 1, -90.0, True, 5.0), ("a", 1, -90.0, False, 7.0), ("a", 2, -120.0, True, 9.0)], "asr_id string, cell_id int, rsrp_dbm double, is_los boolean, distance_m double")
    rx = spark.createDataFrame([(1, 10.0, 1.0), (2, 20.0, 2.0), (3, 30.0, 3.0)], "cell_id int, pop double, demand double")
    got = {r.cell_id: r for r in coverage.best_server(links, rx, "cell_id", "asr_id").collect()}
    assert got[1].best_asr_id == "a" and got[1].best_is_los is False and got[1].n_servers == 2
    assert not got[2].is_covered and got[2].n_links == 1 and got[2].n_servers == 0
    assert got[3].best_rsrp_dbm is None and got[3].n_links == 0 and not got[3].is_covered


def test_summary_weights_and_empty_weights(spark):
    c = spark.createDataFrame([(10_000.0, 1.0, -95.0, 1, 1, True), (1_000.0, 3.0, None, 0, 0, False)], "pop double, demand double, best_rsrp_dbm double, n_links int, n_servers int, is_covered boolean")
    r = coverage.summary(c).first()
    assert (r.cells_covered_frac, r.population_covered_frac, r.demand_covered_frac) == (0.5, 10 / 11, 0.25)
    assert r.median_served_rsrp_dbm == -95 and r.cells_no_link == 1 and r.cells_single_server == 1
    none = coverage.summary(c.withColumn("pop", F.lit(0.0))).first()
    assert none.population_covered_frac == 0


def test_gate_can_fail(spark):
    t = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
    rx = spark.createDataFrame([(1, 1.0, None)], "cell_id int, x double, y double")
    links = spark.createDataFrame([], "cell_id int, rsrp_dbm double")
    cov = spark.createDataFrame([(1, False)], "cell_id int, is_covered boolean")
    got = {r.check_no: r.status for r in coverage.quality_gate(t, rx, links, cov, "cell_id", config.Config(scope="state")).collect()}
    assert got == {1: "FAIL", 2: "PASS", 3: "FAIL", 4: "FAIL", 5: "FAIL", 6: "PASS", 7: "PASS", 8: "FAIL"}


def test_roll_up_conserves(spark):
    rows = [(float(i), float(i % 7), i % 2 == 0, ["no_link", "gap", "single", "multi", "over"][i % 5], None if i % 3 else -90.0 - i, i % 6) for i in range(50)]
    c = spark.createDataFrame(rows, "pop double, demand double, is_covered boolean, band string, best_rsrp_dbm double, n_servers int").withColumn("p", F.col("pop").cast("int") % 4)
    r = coverage.roll_up(c, F.col("p")).toPandas()
    assert r.cells.sum() == 50 and r["pop"].sum() == sum(range(50))
    assert sum(r[f"cells_{b}"].sum() for b in coverage.BANDS) == 50
    assert sum(r[f"pop_{b}"].sum() for b in coverage.BANDS) == sum(range(50))


#: The widest set spoils the two that together cover most.
MISLED = {"wide": [10, 11, 12, 13, 14], "north": [10, 11, 12, 15, 16], "south": [13, 14, 17, 18, 19]}
GAPS = range(10, 20)


@pytest.mark.parametrize("p", [1, 2, 3, 10])
def test_greedy_forms_agree(spark, p):
    cover = spark.createDataFrame([(c, g) for c, gs in MISLED.items() for g in gs], "cand_id string, gap_id int")
    weight = {g: 2.0 if g == 12 else 1.0 for g in GAPS}
    gaps = spark.createDataFrame(list(weight.items()), "gap_id int, demand double")
    got = [(r.cand_id, r.marginal_demand) for r in siting.greedy(cover, gaps, p).orderBy("greedy_rank").collect()]
    assert got == siting.greedy_local(MISLED, weight, p)
    assert sum(g for _, g in got) == {1: 6, 2: 11, 3: 11, 10: 11}[p]


def test_exact_beats_a_misled_greedy():
    weight = dict.fromkeys(GAPS, 1.0) | {10: 1.5, 14: 1.5}
    assert siting.greedy_local(MISLED, weight, 2)[0][0] == "wide"
    assert siting.exact(MISLED, weight, 2) == (["north", "south"], 11.0, True)


def test_orphans_are_links_of_unknown_receivers(spark):
    links = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (9, "b")], "cell_id int, asr_id string")
    got = coverage.orphans(links, spark.createDataFrame([(1,), (3,)], "cell_id int"), "cell_id")
    assert sorted(r.cell_id for r in got.collect()) == [2, 9]


def test_prefixes_of_any_lengths(spark):
    from ridgecast.plans.joins import in_counties

    df = spark.createDataFrame([("12",), ("13",), ("204",), ("3",)], "code string")
    assert sorted(r.code for r in in_counties(df, "code", ["1", "20"]).collect()) == ["12", "13", "204"]
    assert in_counties(df, "code", None).count() == 4 and in_counties(df, "code", []).count() == 0


def test_a_terrain_too_large_is_refused(spark):
    terrain = kernel.ArrayTerrain(np.zeros((20, 20), np.int16), np.zeros((20, 20), np.uint8), 0.0, 0.0)
    pairs = spark.createDataFrame([("t", 1, 0.0, 0.0, 10.0, 90.0, 0.0)], "tx string, rx int, tx_x double, tx_y double, tx_height_m double, rx_x double, rx_y double")
    with pytest.raises(ValueError, match="too large"):
        kernel.links(pairs, terrain, "tx", "rx", most_bytes=100)
    assert kernel.links(pairs, terrain, "tx", "rx").count() == 1


def test_exact_equals_enumeration():
    from itertools import combinations

    rng = np.random.default_rng(5)
    for _ in range(10):
        cover = {f"c{i}": rng.choice(20, rng.integers(1, 8), replace=False).tolist() for i in range(9)}
        d = {g: float(rng.integers(1, 9)) for g in range(20)}
        best = max(sum(d[g] for g in set().union(*(cover[c] for c in k))) for k in combinations(cover, 3))
        chosen, value, proven = siting.exact(cover, d, 3)
        assert proven and value == best


def test_areal_shares_add_up(spark):
    src = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0)], "s int, xmin double, ymin double, xmax double, ymax double")
    dst = spark.createDataFrame([(i, i * 3.0, 0.0, i * 3.0 + 3.0, 10.0) for i in range(4)], "t int, xmin double, ymin double, xmax double, ymax double")
    met = spatial.rectangle_overlap(dst, src, 4.0)
    got = {r.t: r.overlap_m2 for r in met.collect()}
    assert got == {0: 30.0, 1: 30.0, 2: 30.0, 3: 10.0}
    back = spatial.interpolate(met, "t", F.lit(100.0), F.lit(100.0), F.lit(None).cast("double")).agg(F.sum("pop")).first()[0]
    assert back == pytest.approx(100)


def test_polygon_overlap_with_hexagons(spark):
    hexagon = [(10 * math.cos(math.radians(60 * i)), 10 * math.sin(math.radians(60 * i))) for i in range(6)]
    a = spark.createDataFrame([(1, [(-20.0, -20.0), (0.0, -20.0), (0.0, 20.0), (-20.0, 20.0)])], "a int, ring array<struct<x:double,y:double>>")
    b = spark.createDataFrame([(7, hexagon)], "b int, ring array<struct<x:double,y:double>>")
    assert spatial.polygon_overlap(a, b, 15.0, "a", "b").first().overlap_m2 == pytest.approx(polygon.area(hexagon) / 2)


def test_cells_partition_the_plane(spark):
    rng = np.random.default_rng(2)
    pts = spark.createDataFrame([(float(x), float(y)) for x, y in rng.uniform(-5000, 5000, (300, 2))], "x double, y double")
    q, r = cells.point_to_axial(F.col("x"), F.col("y"), 300.0)
    t = pts.withColumn("q", q).withColumn("r", r)
    cx, cy = cells.centre(F.col("q"), F.col("r"), 300.0)
    t = t.withColumn("d", F.hypot(F.col("x") - cx, F.col("y") - cy)).withColumn("cell", cells.cell_id(F.col("q"), F.col("r"), 8))
    assert t.agg(F.max("d")).first()[0] <= 300.0
    assert t.where((cells.cell_q(F.col("cell")) != F.col("q")) | (cells.cell_r(F.col("cell")) != F.col("r"))).count() == 0
    assert t.select(F.size(cells.disk(F.col("q"), F.col("r"), 2))).first()[0] == 19
    h = F.lit(613237248420216831).cast("long")
    assert pts.select(cells.h3_resolution(h), cells.h3_resolution(cells.h3_parent(h, 7)), cells.h3_from_string(cells.h3_to_string(h)) == h).first()[:] == (8, 7, True)


def test_projection_round_trip_and_quadkeys(spark):
    p = spark.createDataFrame([(-81.6326, 38.3498), (-79.8398, 38.4331)], "lon double, lat double")
    x, y = formulas.albers(F.col("lon"), F.col("lat"))
    t = p.withColumn("x", x).withColumn("y", y)
    lon, lat = formulas.albers_inverse(F.col("x"), F.col("y"))
    for r in t.withColumn("a", lon).withColumn("b", lat).collect():
        assert (r.a, r.b) == pytest.approx((r.lon, r.lat), abs=1e-10)
    assert p.select(formulas.quadkey(F.lit(3).cast("long"), F.lit(5).cast("long"), 3)).first()[0] == "213"
    tx, ty = formulas.tile_xy(F.col("lon"), F.col("lat"), 16)
    assert [r[0][:4] for r in p.select(formulas.quadkey(tx, ty, 16)).collect()] == ["0320", "0320"]


def test_snap_and_dms(spark):
    b = spark.range(1).select(*formulas.snap_bounds(F.lit(-1.0), F.lit(91.0), F.lit(800.0), F.lit(450.0)).values()).first()
    assert tuple(b) == (-90.0, 90.0, 810.0, 450.0, 10, 4)
    d = spark.range(1).select(formulas.dms_to_degrees(F.lit(81), F.lit(39), F.lit(14.8), F.lit("W"), "W")).first()[0]
    assert d == pytest.approx(-81.654111, abs=1e-6)


def test_polygon_predicates(spark):
    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    p = spark.createDataFrame([(5.0, 5.0), (13.0, 14.0), (-2.0, 5.0)], "x double, y double")
    got = p.select(polygon.contains(ring, F.col("x"), F.col("y")), polygon.distance(ring, F.col("x"), F.col("y"))).collect()
    assert [tuple(r) for r in got] == [(True, 0.0), (False, 5.0), (False, 2.0)]
    assert len(polygon.densify(ring, 2.5)) == 16


def test_zonal_partials_cross_tiles(spark):
    tiles = raster.tiles_of(spark, "z", 20, 30, lambda r, c: r * 100 + c, "i4", tile=8)
    zones = spark.createDataFrame([(1, 0.5, 2.5, 20.5, 17.5)], "k int, xmin double, ymin double, xmax double, ymax double")
    got = raster.zonal(tiles, zones, "k", "i4", 0.0, 19.0, 1.0, tile=8).first()
    r, c = np.meshgrid(np.arange(20), np.arange(30), indexing="ij")
    v = (r * 100 + c)[(19 - r >= 2.5) & (19 - r < 17.5) & (c >= 0.5) & (c < 20.5)]
    assert (got["sum"], got["n"], got["min"], got["max"]) == (v.sum(), v.size, v.min(), v.max())


def test_burn_takes_the_tallest_rounded_half_to_even(spark):
    b = spark.createDataFrame([(10.0, -10.0, 2.5), (20.0, -20.0, None), (100.0, -10.0, float("nan")), (100.0, -20.0, 900.0)], "x double, y double, height double")
    got = {(r.row, r.col): r.height for r in raster.burn_heights(b, 0.0, 0.0, 90.0).collect()}
    assert got == {(0, 0): 5, (0, 1): 250}


def test_warp_and_mosaic():
    a = np.arange(12.0).reshape(3, 4)
    assert raster.warp(a, np.array([0.5]), np.array([0.5]))[0] == pytest.approx(2.5)
    assert np.isnan(raster.warp(a, np.array([9.0]), np.array([0.0]))[0])
    assert raster.warp(np.array([[1, 1, 2], [1, 3, 2], [1, 1, 2]]), np.array([1.0]), np.array([1.0]), "mode")[0] == 1
    assert raster.mosaic([np.array([1, 0]), np.array([0, 2])], 0).tolist() == [1, 2]
    with pytest.raises(ValueError, match="no tile"):
        raster.mosaic([], 0)


def test_tiff_round_trip(spark, tmp_path):
    a = (np.arange(700 * 600) % 30000).astype(np.int16).reshape(700, 600)
    b = tiff.write_tiff(a, 100.0, 900.0, 90.0, nodata=-9999)
    assert (tiff.read_tiff(b) == a).all() and tiff.read_tiles(b)[1] == (100.0, 900.0, 90.0)
    one = np.full((5, 4), 1.5, np.float32)
    assert (tiff.read_tiff(tiff.write_tiff(one, 0.0, 0.0, 1.0)) == one).all()
    (tmp_path / "x.tif").write_bytes(b)
    t = tiff.read_tile_table(spark, str(tmp_path / "x.tif"), "dem")
    assert raster.pixels(t, "i2", "short").agg(F.sum("value")).first()[0] == int(a.sum())


def test_packing_rounds_clips_and_comes_back(spark):
    got = publish.records(publish.pack([1, 2, 3], [-94.5, -104.5, -200.0], [0.0, 400.0, 2.5], [15.0, 0.0, 1.0], [True, False, True]))
    assert got["rsrp"].tolist() == [-94, -104, -128] and got["diff"].tolist() == [0, 255, 2] and got.nbytes == 36


def test_ragged_text_json_and_cache(spark, tmp_path):
    (tmp_path / "a.dat").write_bytes("x|1|caf\xe9\nshort\ny|2|z|more\n".encode("latin-1"))
    assert [tuple(r) for r in text.read_ragged(spark, str(tmp_path / "a.dat"), {"id": 0, "note": 2}).collect()] == [("x", "caf\xe9"), ("y", "z")]
    assert [tuple(r) for r in text.read_header_json(spark, '[["a","b"],["1",null]]').collect()] == [("1", None)]
    with pytest.raises(ValueError, match="not JSON"):
        text.header_rows("<html>", "text/html")
    src = tmp_path / "src.bin"
    src.write_bytes(b"data")
    got = text.cached(src.as_uri(), str(tmp_path / "cache"))
    assert got.read_bytes() == b"data" and text.cached("file:///gone/src.bin", str(tmp_path / "cache")) == got


def test_wkb_geoparquet_and_shapefile(spark, tmp_path):
    import pyarrow as pa

    for p in ((1.5, -2.25), (0.0, 1e-3), (-1234567.875, 3.0e9)):
        assert geo.read_wkb(geo.wkb_point(*p)) == ("point", p)
    kind, rings = geo.read_wkb(geo.wkb_polygon([[(0, 0), (1, 0), (0, 1)]]))
    assert kind == "polygon" and rings == [[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]]
    df = geo.points_to_wkb(spark.createDataFrame([(1.5, -2.25), (-8.0, 1e-3)], "x double, y double"))
    x, y = geo.point_xy(F.col("geom"))
    assert [tuple(r) for r in df.select(x, y).collect()] == [(1.5, -2.25), (-8.0, 1e-3)]
    geo.write_geoparquet(pa.table({"geom": [geo.wkb_point(1, 2)]}), str(tmp_path / "g.parquet"))
    assert geo.read_geoparquet(spark, str(tmp_path / "g.parquet")).count() == 1
    pts = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)]
    body = struct.pack("<i4d2i1i", 5, 0, 0, 1, 1, 1, 4, 0) + b"".join(struct.pack("<dd", *p) for p in pts)
    out = io.BytesIO()
    out.write(b"\0" * 100 + struct.pack(">ii", 1, len(body) // 2) + body)
    (tmp_path / "a.shp").write_bytes(out.getvalue())
    field = b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([5]) + b"\0" * 15
    (tmp_path / "a.dbf").write_bytes(b"\3\0\0\0" + struct.pack("<IHH", 1, 65, 6) + b"\0" * 20 + field + b"\r" + b" abc  ")
    assert geo.read_shapefile(str(tmp_path / "a.shp"), str(tmp_path / "a.dbf")) == [{"NAME": "abc", "rings": [pts]}]


def test_geojson_leaves_out_nulls_and_nans(spark):
    t = spark.createDataFrame([(1, 2, None, float("nan"), "n")], "x int, y int, a int, b double, c string")
    assert publish.geojson(t, publish.point("x", "y"), ["a", "b", "c"]).first()[0] == '{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]},"properties":{"c":"n"}}'
    with pytest.raises(ValueError, match="empty"):
        publish.require_rows(t.limit(0), "gazetteer")


def test_categories_must_match(spark):
    p = spark.createDataFrame([("a", 0.0, 0.0)], "category string, x double, y double")
    assert demand.poi_scores(p, {"a": 2.0}, 10.0, 1).agg(F.sum("poi_score"), F.count("*")).first()[:] == (14.0, 7)
    with pytest.raises(ValueError, match="no place"):
        demand.category_counts(p, {"a": 1.0, "b": 1.0})


def test_prune_keeps_all_when_few(spark):
    c = spark.createDataFrame([("a", 0.0, 0.0), ("b", 50.0, 0.0)], "cand_id string, x double, y double")
    g = spark.createDataFrame([(1, 49.0, 0.0, 5.0)], "gap_id int, x double, y double, demand double")
    assert {r.naive_demand for r in siting.prune(c, g, 10.0, 5).collect()} == {None}
    assert [r.cand_id for r in siting.prune(c, g, 10.0, 1).collect()] == ["b"]


def test_stream_windows(spark, tmp_path):
    rows = [(f"2024-01-0{d} 12:00:00", -80.0, 38.0, 2, 100.0 * d) for d in (1, 1, 2, 3, 4)]
    spark.createDataFrame(rows, "t string, lon double, lat double, tests int, d_kbps double").select(F.to_timestamp("t").alias("ts"), "lon", "lat", "tests", "d_kbps").coalesce(1).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("ts timestamp, lon double, lat double, tests int, d_kbps double").parquet(str(tmp_path / "in"))
    from ridgecast.streaming.speedtests import windowed_cells

    q = windowed_cells(s).writeStream.format("memory").queryName("cells_out").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    got = {str(r.start)[:10]: (r.tiles, r.d_kbps) for r in spark.table("cells_out").collect()}
    assert got["2024-01-01"] == (2, 100.0) and "2024-01-04" not in got


def test_config_file(tmp_path):
    p = tmp_path / "c.yml"
    p.write_text("radio: {freq_mhz: 800}\ntourism_weight: 5\n")
    c = config.load(p)
    assert c.radio.freq_mhz == 800 and c.tourism_weight == 5 and config.load().siting.sites == 20
    assert config.layer_path("gold", "coverage", root="/d/") == "/d/gold/coverage"


# Checks that stop a run


def test_identities_and_limits(spark):
    rows = [(36000.0, 10.0, 100.0, 30.0, 130.0), (36000.0, -10.0, 100.0, 31.0, 130.5), (None, 1.0, 1.0, None, 5.0)]
    df = spark.createDataFrame(rows, "s double, d double, g double, h double, t double")
    got = checks.identities(df, F.col("d"), F.col("s"), F.col("g"), F.col("h"), F.col("t"))
    assert tuple(got.first()) == (0, 0.25)
    assert checks.require(got, drifted=0, median_residual_m=1.0) is got
    drifted = checks.identities(df.withColumn("d", F.col("d") + 0.001), F.col("d"), F.col("s"), F.col("g"), F.col("h"), F.col("t"))
    with pytest.raises(checks.CheckFailed, match="drifted is 2"):
        checks.require(drifted, drifted=0)
    with pytest.raises(checks.CheckFailed, match="median_residual_m"):
        checks.require(got, median_residual_m=0.1)
    nothing = checks.identities(df.limit(0), F.col("d"), F.col("s"), F.col("g"), F.col("h"), F.col("t"))
    assert checks.require(nothing, drifted=0, median_residual_m=1.0) is nothing


def test_conservation_repetition_and_recomputation(spark):
    a = spark.createDataFrame([(1, 100.0), (2, 50.0), (3, None)], "k int, v double")
    b = a.withColumn("v", F.col("v") * 1.01)
    assert checks.conserved(a, b, "v") is b and checks.same_rows(a, a, "plan") is a
    assert checks.recomputed(a, b.where("k < 3"), "k", ["v"]) is a
    for broken in (lambda: checks.conserved(a, a.limit(1), "v"), lambda: checks.same_rows(a, b, "plan"), lambda: checks.recomputed(a, b.withColumn("v", F.lit(7.0)), "k", ["v"]), lambda: checks.recomputed(a.where("k > 1"), b, "k", ["v"])):
        with pytest.raises(checks.CheckFailed):
            broken()


def test_register_of_two_files(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "r.zip", "w") as z:
        z.writestr("places.dat", "1|T|x\n2|X|y\n3|T|z\nshort\n")
        z.writestr("states.dat", "1|a|C\n2|b|C\n3|c|D\n")
    parts = {"places.dat": ({"id": 0, "kind": 1, "name": 2}, {"kind": "T"}), "states.dat": ({"id": 0, "status": 2}, {"status": "C"})}
    got = text.read_register(spark, str(tmp_path / "r.zip"), str(tmp_path / "out"), parts, "id")
    assert [tuple(r) for r in got.collect()] == [("1", "x")]
    text.write_layer(got, str(tmp_path / "layer"))
    text.write_layer(got, str(tmp_path / "layer"))
    assert spark.read.parquet(str(tmp_path / "layer")).count() == 1


def test_paths_of_readers():
    assert config.reader_path("s3a://bucket/a/b.tif") == "/vsis3/bucket/a/b.tif"
    assert config.reader_path("/data/b.tif") == "/data/b.tif" and config.reader_path("file:///x") == "file:///x"


def test_gaps_and_whole_numbers(spark):
    a = np.array([[1.5, np.nan], [-9999.0, 40000.0]])
    tiles = spark.createDataFrame([("z", 0, 0, 2, 2, bytearray(a.tobytes()))], raster.TILES)
    got = raster.to_int16(tiles, "float64", "filled", nodata=-9999.0).first()
    assert got.layer == "filled" and np.frombuffer(got.data, "int16").tolist() == [2, 0, 0, 32767]


def test_unpacked_blobs_and_runs_of_records(spark):
    links = spark.createDataFrame([("a", 7, -90.4, 300.0, 2.0, True), ("a", 8, -80.0, 0.0, 2.5, False), ("b", 9, -200.0, 1.0, 0.0, True)], "tx string, rx long, rsrp_dbm double, diffraction_db double, clutter_db double, is_los boolean")
    blobs = publish.footprint_blobs(links, "tx", "rx")
    got = sorted(tuple(r) for r in publish.unpacked(blobs, "tx").collect())
    assert got == [("a", 0, 8, -80, 0, 2, False), ("a", 1, 7, -90, 255, 2, True), ("b", 0, 9, -128, 1, 0, True)]
    blob = next(r.blob for r in blobs.collect() if r.tx == "a")
    assert publish.records(bytes(blob), slice(1, 2))["cell"].tolist() == [7] and len(publish.records(bytes(blob), slice(5, 9))) == 0
