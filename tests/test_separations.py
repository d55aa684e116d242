"""Sparse, independent and wide components against NumPy on whole arrays, at several partitionings."""

import numpy as np
import pytest

from specfold.operators import learned
from specfold.operators import separations as P

SCHEMA = "row_id long, mission_id string, telescop string, spectrum array<double>"
ODD = [(10_001, "a", "x", None), (10_002, "a", "x", [1.0, 2.0]), (10_003, None, "x", [0.0] * 12), (10_004, "a", "x", [float("nan")] * 12), (10_005, "a", "x", [None] * 12), (10_006, "lone", "x", [1.0] * 12)]


def frame(spark, groups, parts):
    rows = [(1_000 * g + i, "a", f"x{g}", v.tolist()) for g, y in enumerate(groups) for i, v in enumerate(y)]
    return spark.createDataFrame([*rows, *ODD], SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def sparse_groups():
    rng = np.random.default_rng(2)
    out = []
    for n in (80, 5):
        parts = np.zeros((2, 12))
        parts[0, 1:4], parts[1, 7:11] = [2, 3, 2], [1, -2, 2, 1]
        out.append(rng.normal(size=(n, 2)) * [3, 2] @ parts + rng.normal(0, 0.05, (n, 12)) + 4)
    return out


@pytest.mark.parametrize("parts", [1, 6])
def test_sparse(spark, sparse_groups, parts):
    got = {r["telescop"]: r for r in P.sparse_components(frame(spark, sparse_groups, parts), 2, 2.0).collect()}
    assert got.keys() == {"x0", "x1"}
    for g, y in enumerate(sparse_groups):
        x = y - y.mean(0)
        found = np.array(got[f"x{g}"]["components"])
        assert np.allclose(got[f"x{g}"]["mean"], y.mean(0)) and got[f"x{g}"]["n_rows"] == len(y)
        assert np.allclose(found, P.sparse_factors(x, 2, 2.0), atol=1e-6)  # rows and their triangular factor agree
    first = np.array(got["x0"]["components"])
    assert sorted(tuple(np.flatnonzero(np.abs(c) > 1e-9)) for c in first) == [(1, 2, 3), (7, 8, 9, 10)]


def test_sparse_factors_are_a_minimum():
    """Neither any single entry nor any direction of the rows can be moved to a lower value."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 9))
    x -= x.mean(0)
    u, s, v = np.linalg.svd(x, full_matrices=False)
    value = lambda u, v: 0.5 * ((x - u @ v) ** 2).sum() + 3.0 * np.abs(v).sum()
    direction = P.sparse_factors(x, 3, 3.0)
    # scale of each direction, and the rows' sides, by plain alternation with the directions held
    v, u = s[:3, None] * v[:3], u[:, :3].copy()
    for _ in range(4_000):
        for j in range(3):
            pull = u[:, j] @ (x - u @ v) + v[j] * (u[:, j] @ u[:, j])
            v[j] = np.sign(pull) * np.maximum(np.abs(pull) - 3.0, 0)
        for j in range(3):
            pull = (x - u @ v) @ v[j] + u[:, j] * (v[j] @ v[j])
            u[:, j] = pull / np.linalg.norm(pull)
    best = value(u, v)
    assert np.allclose(P.signed(v / np.linalg.norm(v, axis=1, keepdims=True)), direction, atol=1e-4)
    for _ in range(200):
        assert value(u, v + rng.normal(0, 1e-3, v.shape)) >= best - 1e-9


def mixed(n=1_200):
    rng = np.random.default_rng(7)
    sources = np.stack([rng.uniform(-1, 1, n), rng.choice([-1.0, 1.0], n), rng.laplace(size=n)], 1)
    return (sources - sources.mean(0)) / sources.std(0), sources @ rng.normal(size=(3, 12)) + rng.normal(size=12)


def plain_independent(y, k, seed, tol):
    x = y - y.mean(0)
    _, s, v = np.linalg.svd(x, full_matrices=False)
    white = P.signed(v[:k]) / s[:k, None] * np.sqrt(len(y))
    z, w = x @ white.T, P.first_turn(k, seed)
    for _ in range(200):
        g = np.tanh(z @ w.T)
        new = P.orthogonal(g.T @ z / len(z) - (1 - g * g).mean(0)[:, None] * w)
        moved, w = np.abs(np.abs((new * w).sum(1)) - 1).max(), new
        if moved < tol:
            break
    return P.signed(w @ white)


@pytest.mark.parametrize("parts, most_bytes", [(1, 1 << 20), (5, 0)])
def test_independent(spark, parts, most_bytes):
    truth, y = mixed()
    flat = np.tile(np.arange(12.0), (30, 1)) * np.arange(30)[:, None]  # one direction only: left out
    got = P.independent_components(frame(spark, [y[:1_000], flat], parts), 3, seed=3, tol=1e-7, most_bytes=most_bytes).collect()
    assert [r["telescop"] for r in got] == ["x0"] and got[0]["n_rounds"] < 100
    parts_ = np.array(got[0]["components"])
    assert np.allclose(parts_, plain_independent(y[:1_000], 3, 3, 1e-7), atol=1e-5)
    sources = (y[:1_000] - y[:1_000].mean(0)) @ parts_.T
    match = np.abs(np.corrcoef(sources.T, truth[:1_000].T)[:3, 3:])
    assert np.allclose(sources.std(0), 1) and (match.max(1) > 0.98).all() and sorted(match.argmax(1)) == [0, 1, 2]


@pytest.mark.parametrize("channels, parts, most_bytes", [(12, 3, 1 << 20), (16_384, 4, 64 << 20), (16_384, 2, 0)])
def test_wide(spark, channels, parts, most_bytes):
    rng = np.random.default_rng(1)
    n = 60
    y = rng.normal(size=(n, 4)) * [9, 6, 4, 2] @ rng.normal(size=(4, channels)) + 0.2 * rng.normal(size=(n, channels)) + 3
    found = P.wide_components(frame(spark, [y], parts), 3, extra=4, tol=1e-8, most_bytes=most_bytes).where("telescop = 'x0'").first()
    x = y - y.mean(0)
    _, s, v = np.linalg.svd(x, full_matrices=False)
    assert np.abs(np.array(found["components"]) - P.signed(v[:3])).max() < 1e-6 and np.allclose(found["mean"], y.mean(0))
    assert np.allclose(found["variance"], s[:3] ** 2 / (n - 1)) and np.allclose(found["ratio"], s[:3] ** 2 / (s**2).sum()) and found["n_passes"] < 20


@pytest.mark.parametrize("reject", [None, 3.0])
def test_models_of_wide_groups(spark, reject):
    """Subspace iterations give the models of the triangular factors: gaps, core, rejected rows and smoothing alike."""
    rng = np.random.default_rng(4)
    y = rng.normal(size=(90, 3)) * [8, 5, 3] @ rng.normal(size=(3, 40)) + 0.05 * rng.normal(size=(90, 40))
    y[4, 7], y[11, 3:6], y[:, :2] = np.nan, np.nan, np.nan
    y[20] += 300
    rows = spark.createDataFrame([(i, "a", f"p{i % 2}", v.tolist()) for i, v in enumerate(y)], SCHEMA).repartition(3)
    one, two = ({m["telescop"]: m for m in learned.fit_models(rows, 3, core=(18, 23), smooth=3, reject_sigma=reject, wide_channels=w).collect()} for w in (4_096, 30))
    assert one.keys() == two.keys() == {"p0", "p1"}
    for g in one:
        assert all(one[g][c] == two[g][c] for c in ("n_rows", "ch_first", "ch_last"))
        assert all(np.allclose(one[g][c], two[g][c], atol=1e-5) for c in ("mean", "components", "variance", "ratio"))
