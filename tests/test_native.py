"""The kernel inside the JVM against its numpy form, and plans that keep pairs and links inside tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgecast.config import Radio
from ridgecast.operators import blocks, kernel, native, publish
from ridgecast.plans import catalog, relational


@pytest.fixture
def points(spark, monkeypatch):
    monkeypatch.setattr(blocks, "RECEIVERS", 16)
    monkeypatch.setattr(blocks, "TRANSMITTERS", 8)
    rng = np.random.default_rng(7)
    # Beyond the raster's edges, on edges of pixels, at one place; unknown heights.
    t = [(f"{'NEW:' if i % 3 == 0 else ''}S{i}", float(x), float(y), None if i % 9 == 0 else float(20 + i)) for i, (x, y) in enumerate(rng.integers(-6, 6, (40, 2)) * 4500.0)]
    r = [(i, float(x), float(y), float(i)) for i, (x, y) in enumerate(np.vstack([rng.uniform(-30_000, 30_000, (60, 2)), rng.integers(-300, 300, (30, 2)) * 90.0, [[9000.0, 9000.0]]]))]
    return spark.createDataFrame(t, "asr_id string, x double, y double, tx_height_m double"), spark.createDataFrame(r, "cell_id long, x double, y double, pop double")


def rows(df):
    # The last bit of a logarithm is the library's.
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in x]) for x in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def both(monkeypatch, make):
    got = rows(make())
    with monkeypatch.context() as m:
        m.setattr(native, "knows", lambda terrain: False)
        return got, rows(make())


@pytest.mark.parametrize("floor", [-125.0, -105.0])
def test_links_are_those_of_the_numpy_form(points, monkeypatch, floor):
    got, want = both(monkeypatch, lambda: blocks.links(*points, kernel.FormulaTerrain(), "asr_id", "cell_id", Radio(), floor))
    assert got == want and len(got) > 50


def test_receivers_and_transmitters_are_those_of_the_numpy_form(points, monkeypatch):
    t, r = points
    got, want = both(monkeypatch, lambda: blocks.per_receiver(t.unionByName(t), r, kernel.FormulaTerrain(), "asr_id", "cell_id"))
    assert got == want and len(got) > 20
    got, want = both(monkeypatch, lambda: blocks.per_transmitter(t, r, kernel.FormulaTerrain(), "asr_id", "cell_id", floor_dbm=-115.0))
    assert got == want and len(got) > 10


def test_footprints_are_the_blobs_of_the_links(points):
    t, r = points
    for towers, cells in ((t, r), (t.unionByName(t), r), (t, r.unionByName(r)), (t.limit(0), r)):
        got = blocks.footprints(towers, cells, kernel.FormulaTerrain(), "asr_id", "cell_id", floor_dbm=-115.0)
        want = publish.footprint_blobs(blocks.links(towers, cells, kernel.FormulaTerrain(), "asr_id", "cell_id", floor_dbm=-115.0), "asr_id", "cell_id")
        assert rows(got) == rows(want)


def test_pairs_and_links_take_no_step_through_python_and_footprints_no_exchange_of_links(points):
    t, r = points
    for df in (blocks.pairs(t, r, "asr_id", "cell_id", 40_000.0), blocks.links(t, r, kernel.FormulaTerrain(), "asr_id", "cell_id"), blocks.footprints(t, r, kernel.FormulaTerrain(), "asr_id", "cell_id")):
        above = plan(df).split("Exchange")[0]
        assert "InArrow" not in above and "Exchange" in plan(df)


def test_arithmetic_rounds_as_sql(spark):
    x = [1.00005, -1.00005, -97.12345678, 0.0, 39999.99996, -0.00004, 12.0]
    got = [v.x for v in relational.rounded_fast(spark.createDataFrame([(v,) for v in x], "x double")).collect()]
    assert got == [1.0001, -1.0001, -97.1235, 0.0, 40000.0, 0.0, 12.0]


@pytest.mark.parametrize("most", [0, 1, 2, 5, blocks.ALL])
def test_receivers_asked_for_less_are_those_of_all_links(points, most):
    """Links left out by a bound change nothing that is told: repeated transmitters tie, some lie beyond the raster or have no height, a receiver's id repeats."""
    t, r = points
    t, r = t.unionByName(t), r.unionByName(r.where("cell_id < 20"))
    run = lambda **k: blocks.per_receiver(t, r, kernel.FormulaTerrain(), "asr_id", "cell_id", **k)
    want = run().drop("n_links", "low_rsrp_dbm").withColumn("n_servers", F.least("n_servers", F.lit(most).cast("long")))
    want = want if most else want.drop("n_servers")
    assert rows(run(most=most)) == rows(want) and want.count() > 20
    assert rows(run(most=most, new_prefix="")) == rows(want.drop("old_rsrp_dbm"))


def test_numpy_form_is_asked_for_less(points, monkeypatch):
    got, want = both(monkeypatch, lambda: blocks.per_receiver(*points, kernel.FormulaTerrain(), "asr_id", "cell_id", most=2, new_prefix=""))
    assert got == want and len(got) > 20


@pytest.mark.parametrize("name, most", [("coverage_summary", 2), ("dq_gate", 0), ("false_negative_rate", 0), ("gap_mask", 0), ("lod_rollup_r5", blocks.ALL), ("lod_rollup_r6", blocks.ALL), ("best_server", None)])
def test_queries_ask_for_no_more_than_they_tell(spark, sf, monkeypatch, name, most):
    asked = []
    monkeypatch.setattr(blocks, "per_receiver", lambda *a, f=blocks.per_receiver: asked.append(a[-1]) or f(*a))
    catalog.queries()[name](spark, sf)
    assert asked == [most]


def test_vector_loops_are_the_plain_loops(spark):
    """To the last bit, on edges between pixels as well."""
    context = spark.sparkContext
    loader, code = native._build(context._jvm)
    assert "ridgecast.Lanes" in code
    new = context._gateway.new_array
    made = [loader.loadClass(f"ridgecast.{c}").getConstructors()[0].newInstance(new(context._jvm.java.lang.Object, 0)) for c in ("Loops", "Lanes")]

    def array(values):
        out = new(context._jvm.double, len(values))
        for i, x in enumerate(values):
            out[i] = float(x)
        return out

    rng = np.random.default_rng(8)
    share = np.linspace(0.0, 1.0, 32)
    f, square, weight = map(array, (share, share * share, rng.random(32)))
    for k in range(12):
        x, y, dx, dy = (rng.integers(1, 4000, 4) * 90.0 + [0, 0, -180_000, 0]) if k % 2 else rng.uniform(0, 300_000, 4)
        got = []
        for loops in made:
            e, v = array([0] * 32), array([0] * 32)
            most = loops.rise(f, square, weight, e, v, 0, 32, float(dx) / 8, float(x), 45.0, float(dy) / 8, float(y), 400_455.0, 90.0, 31.5, 260.0, -20.5)
            got.append((most, list(e), list(v), loops.over(f, weight, e, v, 8, 24, 250.0, 11.25)))
        assert got[0] == got[1]
