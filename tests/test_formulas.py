"""Published anchors, geometry and properties of the kernel."""

import numpy as np
import pytest

from ridgecast.config import Radio
from ridgecast.operators import kernel
from ridgecast.operators.kernel import ArrayTerrain, FormulaTerrain, building_loss, diffraction, fspl, knife_edge, link_budget


def flat(n=100, z=0, land=30, bldg=None, rows=1):
    return ArrayTerrain(np.full((rows, n), z, np.int16), np.full((rows, n), land, np.uint8), 0.0, 0.0, 90.0, bldg)


def one(t, length, tx_h=50.0, **kw):
    return {k: v[0] for k, v in link_budget(t, [0.0], [0.0], [tx_h], [length], [0.0], **kw).items()}


def test_free_space_and_knife_edge_anchors():
    assert fspl(10_000.0, 700.0) == pytest.approx(109.342, abs=1e-3)
    assert knife_edge(0.0) == pytest.approx(6.0329, abs=1e-3)
    assert knife_edge(1.0) == pytest.approx(13.9257, abs=1e-3)
    assert knife_edge(-0.78) == 0
    assert knife_edge(-np.inf) == 0


def test_building_anchors():
    got = building_loss([0, 1, 3.55, 8, 90], Radio())
    assert got == pytest.approx([0, 0, 14.8218, 24.0377, 30], abs=1e-3)
    assert (np.diff(building_loss(np.linspace(0, 60, 50), Radio())) >= 0).all()


@pytest.mark.parametrize("km", [2, 5, 10, 20, 30])
def test_flat_ground_costs_nothing(km):
    r = one(flat(600), km * 1000.0)
    assert r["is_los"] and r["diffraction_db"] == 0
    assert r["path_loss_db"] == pytest.approx(fspl(km * 1000.0, 700.0))


def test_ridges():
    t = flat()
    t.elevation[0, 25:32] = 200
    low = one(t, 5000.0)
    assert not low["is_los"] and low["diffraction_db"] == pytest.approx(56.44, abs=0.05)
    two = flat()
    two.elevation[0, 20:24] = 300
    single = one(two, 5000.0)["diffraction_db"]
    two.elevation[0, 38:42] = 260
    assert one(two, 5000.0)["diffraction_db"] > single


def test_horizon_flips_line_of_sight():
    assert one(flat(700), 0.8 * 34_189.5)["is_los"]
    far = one(flat(700), 1.2 * 34_189.5)
    assert not far["is_los"] and far["diffraction_db"] == pytest.approx(19.60, abs=0.05)


def test_budget_anchor():
    assert one(flat(500), 25_000.0)["rsrp_dbm"] == pytest.approx(-93.0823, abs=1e-3)


def test_clutter_is_the_larger_of_class_and_rooftop():
    none, zero = flat(64, 200, 50), flat(64, 200, 50, np.zeros((1, 64)))
    a, b = one(none, 3000.0), one(zero, 3000.0)
    assert a == b and a["clutter_db"] == 15
    assert one(flat(64, 200, 50, np.full((1, 64), 8.0)), 3000.0)["clutter_db"] == pytest.approx(24.0377, abs=1e-3)
    trees = one(flat(100, 0, 10), 5000.0)
    assert trees["clutter_db"] == 12 and one(flat(), 5000.0)["rsrp_dbm"] - trees["rsrp_dbm"] == pytest.approx(12)


def test_batches_equal_single_links():
    rng = np.random.default_rng(0)
    t = ArrayTerrain(rng.integers(0, 300, (300, 300)).astype(np.int16), rng.choice([10, 30, 50], (300, 300)).astype(np.uint8), 0.0, 26_910.0)
    p = rng.uniform(0, 26_910, (25, 4))
    whole = link_budget(t, p[:, 0], p[:, 1], np.full(25, 45.0), p[:, 2], p[:, 3])
    for i in range(25):
        single = link_budget(t, p[i : i + 1, 0], p[i : i + 1, 1], [45.0], p[i : i + 1, 2], p[i : i + 1, 3])
        assert single["rsrp_dbm"][0] == pytest.approx(whole["rsrp_dbm"][i], abs=1e-9)


def test_diffraction_is_finite_and_never_negative():
    rng = np.random.default_rng(1)
    e = rng.uniform(0, 500, (200, 128))
    loss, _ = diffraction(e, np.full(200, 10_000.0), e[:, 0] + 45, e[:, -1] + 1.5, 700.0, 1.333)
    assert np.isfinite(loss).all() and (loss >= 0).all()


def test_clamping_and_shape_check():
    t = flat(10, 7)
    assert t.height(np.array([-1e6, 1e6]), np.array([5e5, -5e5])).tolist() == [7, 7]
    with pytest.raises(ValueError, match="shape"):
        ArrayTerrain(np.zeros((2, 2)), np.zeros((2, 3)), 0, 0)


def test_formula_terrain_agrees_with_columns(spark):
    from pyspark.sql import functions as F

    from ridgecast.functions import formulas

    v = [-5.0, -0.78, -0.5, 0.0, 1.0, 7.5]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in v], "v double").select(formulas.knife_edge_db(F.col("v"))).collect()]
    assert got == pytest.approx(knife_edge(v).tolist())
    assert FormulaTerrain().height(np.array([45.0]), np.array([400_455.0]))[0] == 300
    assert kernel.LIGHT_M_S == formulas.LIGHT_M_S
