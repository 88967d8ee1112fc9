"""Exact siting searches to the end."""

from itertools import combinations

import numpy as np
import pytest

from ridgecast.operators import siting
from ridgecast.plans import catalog


def covered(cover, demand, chosen):
    return sum(demand[g] for g in set().union(*(cover[c] for c in chosen)))


def islands(n, candidates, gaps, seed):
    """Covers that share nothing with one another."""
    rng = np.random.default_rng(seed)
    cover = {f"c{i}_{j}": [i * gaps + int(g) for g in rng.choice(gaps, rng.integers(4, 9), replace=False)] for i in range(n) for j in range(candidates)}
    return cover, {g: float(rng.integers(1, 9)) for g in range(n * gaps)}


def best_of_islands(cover, demand, sites):
    """All choices on each island, then all ways to share out the sites."""
    best = [0.0] * (sites + 1)
    for i in sorted({c.split("_")[0] for c in cover}):
        cs = [c for c in cover if c.split("_")[0] == i]
        most = [max(covered(cover, demand, k) for k in combinations(cs, n)) for n in range(min(sites, len(cs)) + 1)]
        best = [max(best[s - n] + most[n] for n in range(min(s, len(cs)) + 1)) for s in range(sites + 1)]
    return best[sites]


def test_the_query_searches_to_the_end(spark, sf, monkeypatch):
    cover, demand = islands(10, 10, 25, 1)
    gaps = spark.createDataFrame([(g, 0.0, 0.0, d) for g, d in demand.items()], "cell_id long, x double, y double, demand double")
    pairs = spark.createDataFrame([(c, g, -90.0) for c, gs in cover.items() for g in gs], "cand_id string, gap_id long, rsrp_dbm double")
    monkeypatch.setattr(catalog.relational, "gaps_of", lambda *_: gaps)
    monkeypatch.setattr(catalog.relational, "cover_of", lambda *_: pairs)
    want = best_of_islands(cover, demand, 20)
    assert sum(d for _, d in siting.greedy_local(cover, demand, 20)) < want
    assert [tuple(r) for r in catalog.queries()["exact_sites"](spark, sf).collect()] == [(want, True, 20)]


@pytest.mark.parametrize("sites", [0, 1, 3, 5, 20])
def test_exact_equals_all_choices(sites):
    rng = np.random.default_rng(sites)
    for kind in range(6):
        cover = {i: rng.choice(24, rng.integers(1, 10), replace=False).tolist() for i in range(14)}
        # Equal demands tie; gaps without demand count for nothing.
        demand = {g: [1.0, float(rng.integers(0, 4)), float(rng.random())][kind % 3] for g in range(24)}
        want = max((covered(cover, demand, k) for k in combinations(cover, min(sites, 14))), default=0.0)
        chosen, value, proven = siting.exact(cover, demand, sites)
        assert proven and value == pytest.approx(want, abs=1e-9) and len(chosen) <= sites and covered(cover, demand, chosen) == pytest.approx(value, abs=1e-9)


def test_long_rows_of_candidates():
    """A thousand and more candidates, in one chain and apart: chains of pairs are best taken every other one."""
    chain = {i: [i, i + 1] for i in range(3000)}
    assert siting.exact(chain, dict.fromkeys(range(3001), 1.0), 20)[1:] == (40.0, True)
    apart = {i: [2 * i, 2 * i + 1] for i in range(3000)}
    assert siting.exact(apart, {g: float(g) for g in range(6000)}, 20)[1:] == (float(sum(range(5960, 6000))), True)


def test_no_cover():
    assert siting.exact({}, {}, 20) == ([], 0, True) and siting.exact({"a": [1]}, {1: 0.0}, 20) == ([], 0, True)
