"""Sweeps against one correction for each setting."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from specfold.functions import kernels as K
from specfold.operators import learned, sweeps

WINDOW = (20, 28)


def model_and_rows(seed, n=120, channels=64, k=6):
    rng = np.random.default_rng(seed)
    parts = np.linalg.qr(rng.normal(size=(channels - 8, k)))[0].T
    y = rng.normal(size=(n, channels))
    y[:, 4:-4] += rng.normal(size=(n, k)) * np.array([9, 6, 4, 2, 1, 0.5]) @ parts
    y[:, 20:28] += 3
    y[5:9, 10] = np.nan  # rows that share their missing channels, and others of their own
    y[30, rng.random(channels) < 0.3] = np.nan
    y[31, 40] = 0.0
    y[32, 4:-4] = np.nan
    y[33] = np.nan
    return y, K.Model(np.zeros(channels - 8), parts, np.ones(k), np.array([0.5, 0.2, 0.1, 0.05, 0.02, 0.01]), 4, channels - 5)


def plain(y, model, setting):
    """One row after another through the correction itself."""
    k = setting.n_components
    m = None if model is None else K.Model(model.mean, model.components[:k], model.variance[:k], model.ratio[:k], model.first, model.last)
    every = np.ones((len(y), 0 if m is None else m.last + 1), bool)
    out, used = (y, np.zeros(len(y), int)) if m is None else K.correct(y, m, every, every, setting.gates)
    free = np.ones(y.shape[1], bool)
    free[slice(*WINDOW)] = False
    rows = np.flatnonzero((np.isfinite(y) & free).any(1))
    noise = lambda x: sum(x[i][free & np.isfinite(x[i])].std() for i in rows)
    flux = lambda x: np.nansum(x[rows][:, ~free])
    return len(rows), [noise(y), noise(out), flux(y), flux(out), used[rows].sum()]


SETTINGS = sweeps.settings_of([1, 3, 6], [0.0, 0.04], [0.0, 2.0], [np.inf, 0.4, 1.5], [3, 5], [True, False])


@pytest.mark.parametrize("seed", range(3))
def test_all_settings_against_the_correction(seed):
    y, model = model_and_rows(seed)
    n, sums = sweeps.left_by(y, (model.components, model.ratio, model.first, model.last), SETTINGS, WINDOW)
    assert len(SETTINGS) == 144
    for place, setting in enumerate(SETTINGS):
        rows, want = plain(y, model, setting)
        assert n == rows and np.allclose(sums[:, place], want, rtol=1e-8, atol=1e-8), setting
    n, sums = sweeps.left_by(y, None, SETTINGS[:2], WINDOW)
    assert np.allclose(sums[:, 1], plain(y, None, SETTINGS[1])[1])


def test_empty_and_odd_blocks():
    y, model = model_and_rows(9)
    given = (model.components, model.ratio, model.first, model.last)
    for rows in (y[:0], np.full((3, 64), np.nan)):
        n, sums = sweeps.left_by(rows, given, SETTINGS, WINDOW)
        assert n == 0 and not sums.any()
    flat = np.zeros((2, 64))
    n, sums = sweeps.left_by(flat, given, SETTINGS, WINDOW)
    assert n == 2 and not sums.any()


@pytest.mark.parametrize("most_bytes", [1 << 26, 0])
def test_sweep_of_a_table(spark, most_bytes):
    """Groups, some without a model, over partitions, against learned.correct; the best of each."""
    rows = []
    for seed, mission in enumerate(("F1", "F2")):
        y, _ = model_and_rows(seed, n=60)
        rows += [(100 * seed + i, mission, "A", v.tolist()) for i, v in enumerate(y)]
    rows += [(900, "F3", "A", rows[0][3]), (901, "F3", "A", None), (902, None, None, rows[1][3]), (903, "F3", "A", [])]
    df = spark.createDataFrame(rows, "row_id long, mission_id string, telescop string, spectrum array<double>").repartition(5)
    models = learned.fit_models(df.where("row_id < 900"), 5).cache()
    settings = SETTINGS[::13]
    found = sweeps.sweep(df, models, settings, WINDOW, most_bytes=most_bytes).cache()
    got = {(r["mission_id"], r["setting"]): r for r in found.collect()}
    assert {m for m, _ in got} == {"F1", "F2", "F3", None} and len(got) == 4 * len(settings)
    assert got["F3", 0]["n_rows"] == 1 and got["F3", 0]["noise"] == pytest.approx(got["F3", 0]["noise_before"]) and got[None, 1]["n_used"] == 0
    free = np.array([not WINDOW[0] <= i < WINDOW[1] for i in range(64)])
    for place in (0, 3, 7):
        fixed = learned.correct(df.where("row_id < 900"), models, settings[place].gates, settings[place].n_components).collect()
        for mission in ("F1", "F2"):
            own = [np.array(r["spectrum"], float) for r in fixed if r["mission_id"] == mission]
            own = [(x, r) for x, r in zip(own, (r for r in fixed if r["mission_id"] == mission), strict=True) if np.isfinite(x[free]).any()]
            r = got[mission, place]
            assert r["n_rows"] == len(own)
            assert r["noise"] == pytest.approx(np.mean([x[free & np.isfinite(x)].std() for x, _ in own]), rel=1e-7)
            assert r["n_used"] == pytest.approx(np.mean([q["n_used"] for _, q in own]))
    for r in sweeps.best_settings(found, 0.5).collect():
        able = [q for (m, _), q in got.items() if m == r["mission_id"] and abs(q["flux"]) >= 0.5 * abs(q["flux_before"])]
        assert r["setting"] == min(able, key=lambda q: (q["noise"], q["setting"]))["setting"]
    assert sweeps.sweep(df.limit(0), models, settings, WINDOW).count() == 0


def test_many_settings_cost_less_than_three_corrections():
    y, model = model_and_rows(3, n=1_500, channels=512)
    given = (model.components, model.ratio, model.first, model.last)
    settings = sweeps.settings_of([2, 4, 6], [0.0, 0.03, 0.1], [0.0, 1.0, 4.0], [np.inf, 2.0, 0.7], [3, 5])
    assert len(set(settings)) == 162
    y = y[40:]  # spectra without missing channels
    begin = time.process_time()
    sweeps.left_by(y, given, settings, WINDOW)
    many = time.process_time() - begin
    begin = time.process_time()
    every = np.ones((len(y), model.last + 1), bool)
    K.correct(y, model, every, every, settings[0].gates)
    assert many < 3 * (time.process_time() - begin)
