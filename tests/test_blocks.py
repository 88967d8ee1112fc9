"""Links by packed rows against links pair by pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgecast.config import Radio
from ridgecast.operators import blocks, coverage, kernel, spatial
from ridgecast.plans import catalog


def plain_loss(elev, length, z_tx, z_rx, wavelength, k=1.333):
    """Deygout's construction, sample by sample."""
    n = len(elev)
    d = [length * i / (n - 1) for i in range(n)]

    def worst(a, b, za, zb):
        best, at = 0.0, None
        for i in range(a + 1, b):
            d1, d2 = d[i] - d[a], d[b] - d[i]
            rise = elev[i] + d1 * d2 / (2 * k * kernel.EARTH_M) - (za + (zb - za) * d1 / (d1 + d2))
            v = rise * np.sqrt(2 * (d1 + d2) / (wavelength * d1 * d2))
            if v > best:
                best, at = v, i
        return (float(kernel.knife_edge(best)) if at is not None else 0.0), at

    loss, at = worst(0, n - 1, z_tx, z_rx)
    if at is None:
        return 0.0, False
    return loss + worst(0, at, z_tx, elev[at])[0] + worst(at, n - 1, elev[at], z_rx)[0], True


def test_diffraction_equals_a_plain_version():
    rng = np.random.default_rng(3)
    elev = 200 + 40 * rng.random((60, 33))
    elev[:10] = 100.0
    length = np.append(rng.uniform(50, 40_000, 59), 0.0)
    z_tx, z_rx = elev[:, 0] + rng.uniform(20, 120, 60), elev[:, -1] + 1.5
    loss, blocked = kernel.diffraction(elev, length, z_tx, z_rx, 700.0, 1.333)
    for i in range(59):
        want = plain_loss(elev[i], length[i], z_tx[i], z_rx[i], kernel.LIGHT_M_S / 700e6)
        assert loss[i] == pytest.approx(want[0], abs=1e-9) and blocked[i] == want[1]
    assert loss[59] == 0 and not blocked[59]


def test_a_floor_only_leaves_out_what_lies_below_it():
    rng = np.random.default_rng(4)
    x, y, u, v = rng.uniform(0, 400_000, (4, 500))
    u, v = x + (u - 200_000) / 10, y + (v - 200_000) / 10
    t, h = kernel.FormulaTerrain(), np.full(500, 45.0)
    whole = kernel.link_budget(t, x, y, h, u, v)["rsrp_dbm"]
    some = kernel.link_budget(t, x, y, h, u, v, floor_dbm=-115.0, step=64)["rsrp_dbm"]
    assert 0 < (whole >= -115).sum() < 500 and ((some >= -115) == (whole >= -115)).all() and (some[whole >= -115] == whole[whole >= -115]).all()


@pytest.fixture
def points(spark, monkeypatch):
    monkeypatch.setattr(blocks, "RECEIVERS", 16)
    monkeypatch.setattr(blocks, "TRANSMITTERS", 8)
    rng = np.random.default_rng(5)
    t = [(f"S{i}" if i % 4 else f"NEW:S{i}", *map(float, rng.integers(-30_000, 90_000, 2)), 45.0) for i in range(40)]
    t += [("S1a", *t[1][1:]), ("S0", *t[1][1:]), t[2], ("S_", None, 1.0, 45.0)]  # equal signals, a repeated row, an unknown place
    r = [(i, *map(float, rng.integers(-30_000, 90_000, 2)), float(i)) for i in range(150)] + [(7, 100.0, 100.0, 7.0), (999, None, 0.0, 1.0)]
    return spark.createDataFrame(t, "asr_id string, x double, y double, tx_height_m double"), spark.createDataFrame(r, "cell_id long, x double, y double, pop double")


def links_by_pairs(t, r):
    p = spatial.distance_join(t, r, 40_000.0)
    p = p.select("asr_id", F.col("r_cell_id").alias("cell_id"), F.col("x").alias("tx_x"), F.col("y").alias("tx_y"), "tx_height_m", F.col("r_x").alias("rx_x"), F.col("r_y").alias("rx_y"))
    return kernel.links(p, kernel.FormulaTerrain(), "asr_id", "cell_id")


def test_packed_rows_give_the_links_of_all_pairs(points):
    t, r = points
    rows = lambda d: sorted(map(tuple, d.collect()))
    want = links_by_pairs(t, r).cache()
    assert rows(blocks.links(t, r, kernel.FormulaTerrain(), "asr_id", "cell_id")) == rows(want) and want.count() > 200
    assert rows(blocks.pairs(t, r, "asr_id", "cell_id", 40_000.0)) == rows(spatial.distance_join(t, r, 40_000.0).select("asr_id", F.col("r_cell_id").alias("cell_id"), "distance_m"))
    assert blocks.pairs(t.limit(0), r, "asr_id", "cell_id", 40_000.0).count() == 0
    served = F.col("rsrp_dbm") >= -105.0
    n = want.where("rsrp_dbm >= -115").groupBy("asr_id").agg(F.count("*"), F.count_if(served))
    got = blocks.per_transmitter(t, r, kernel.FormulaTerrain(), "asr_id", "cell_id", floor_dbm=-115.0)
    assert rows(got.select("asr_id", "n", "n_served")) == rows(n)


def test_best_link_of_packed_rows(points):
    """Ties go to the smallest transmitter; rows of one id add up."""
    t, r = points
    t = t.distinct()
    want = links_by_pairs(t, r).cache()
    ids = r.select("cell_id").distinct()
    columns = ["cell_id", "best_rsrp_dbm", "best_asr_id", "best_is_los", "best_distance_m", "n_links", "n_servers"]
    best = {x.cell_id: x for x in coverage.best_server(want, ids, "cell_id", "asr_id").where("n_links > 0").collect()}
    extra = {x.cell_id: x for x in want.groupBy("cell_id").agg(F.min("rsrp_dbm").alias("low"), F.max(F.when(~F.col("asr_id").startswith("NEW:"), F.col("rsrp_dbm"))).alias("old")).collect()}
    got = {x.cell_id: x for x in blocks.per_receiver(t, r, kernel.FormulaTerrain(), "asr_id", "cell_id", Radio()).collect()}
    assert got.keys() == best.keys() and any(x.best_asr_id == "S0" for x in got.values())
    for k, x in got.items():
        assert [x[c] for c in columns] == [best[k][c] for c in columns]
        assert (x.low_rsrp_dbm, x.old_rsrp_dbm) == (extra[k].low, extra[k].old)


@pytest.mark.parametrize("name", ["best_server", "coverage_summary", "dq_gate", "footprint_index", "footprint_sizes", "newly_covered", "link_rsrp", "dwithin_pairs"])
def test_no_row_per_pair_is_exchanged(spark, sf, name):
    plan = catalog.queries()[name](spark, sf)._jdf.queryExecution().analyzed().toString()
    assert "r_no" in plan and "tx_x" not in plan


@pytest.mark.parametrize("name", ["naive_demand_topk", "exact_sites", "cover_pairs", "candidate_kinds", "colocation_candidates", "greenfield_candidates"])
def test_gaps_are_computed_once(spark, sf, name, monkeypatch):
    made = []
    monkeypatch.setattr(catalog.relational, "coverage_of", lambda *a, f=catalog.relational.coverage_of: made.append(f(*a)) or made[-1])
    catalog.queries()[name](spark, sf)
    assert len(made) == 1 and made[0].where("not is_covered").select("cell_id", "x", "y", "demand").storageLevel.useMemory
