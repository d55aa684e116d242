"""Kernels against plain NumPy, and their invariants."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from specfold.functions import kernels as K

RNG = np.random.default_rng(0)


def noisy(rows=6, n=64, holes=True):
    y = RNG.normal(0, 1, (rows, n)) + np.linspace(0, 5, n)
    if holes:
        y[0, 3] = np.nan
        y[1, 10:14] = np.inf
        y[2] = np.nan
    return y


def plain_baseline(y, order, window, clip=3.0, rounds=3):
    x = np.arange(len(y))
    good = np.isfinite(y)
    if window:
        good[window[0] : window[1]] = False
    if good.sum() <= order:
        return y
    use = good.copy()
    for _ in range(rounds):
        r = y - np.polyval(np.polyfit(x[use], y[use], order), x)
        s = r[use].std()
        if not np.isfinite(s) or s == 0:
            break
        new = use & (np.abs(np.where(np.isfinite(r), r, np.inf)) <= clip * s)
        if new.sum() == use.sum():
            break
        use = new
    if use.sum() <= order:
        use = good
    out = y - np.polyval(np.polyfit(x[use], y[use], order), x)
    out[~np.isfinite(y)] = np.nan
    return out


@pytest.mark.parametrize("order", [0, 1, 3])
def test_baseline_equals_polyfit(order):
    y = noisy()
    y[3, 50] = 40  # clipped
    got = K.baseline(y, order, (20, 30))
    for a, b in zip(got, y, strict=True):
        assert np.allclose(a, plain_baseline(b.copy(), order, (20, 30)), equal_nan=True, atol=1e-8)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(-5, 5), min_size=1, max_size=4))
def test_baseline_removes_polynomials(c):
    x = np.linspace(-1, 1, 50)
    assert np.abs(K.baseline(np.polyval(c, x)[None, :], len(c) - 1)).max() < 1e-8


def test_smooth_is_same_convolution():
    y = noisy(holes=False)
    for k in (1, 3, 4, 7):
        assert np.allclose(K.smooth(y, k), [np.convolve(r, np.ones(k) / k, "same") for r in y])
    assert K.smooth(y[:, :3], 7).shape == (6, 3)


def test_resample_keeps_means():
    y = noisy(2, 12, holes=False)
    v = np.broadcast_to(np.arange(12) * 1.0, y.shape)
    got = K.resample(y, v, 0.0, 3.0, 5)
    for i in range(2):
        for b in range(5):
            pick = np.rint(v[i] / 3.0) == b
            assert np.isclose(got[i, b], y[i][pick].mean()) if pick.any() else np.isnan(got[i, b])


def test_ripple_and_whiteness_of_white_noise():
    y = np.random.default_rng(1).normal(0, 1, (200, 512))
    free = np.ones(512, bool)
    assert abs(np.median(K.ripple_ratio(y, free)) - 1) < 0.05
    assert abs(np.median(K.whiteness(y, free, 4)) - 1) < 0.1
    wave = y + 3 * np.sin(np.arange(512) / 20)
    assert np.median(K.ripple_ratio(wave, free)) > 1.5 and np.median(K.whiteness(wave, free, 4)) > 1.2


def test_noise_fill_is_keyed_by_row():
    y = noisy(4, 64, holes=False)
    mask = np.zeros(y.shape, bool)
    mask[:, 5:9] = True
    a = K.fill_with_noise(y, mask, np.array([1, 2, 3, 4]), 42, True)
    b = K.fill_with_noise(y[::-1], mask, np.array([4, 3, 2, 1]), 42, True)[::-1]
    assert np.array_equal(a, b) and not np.allclose(a[:, 5:9], y[:, 5:9]) and np.array_equal(a[:, 9:], y[:, 9:])


def test_line_is_found_and_noise_is_not():
    y = np.random.default_rng(3).normal(0, 0.05, (30, 80))
    y[5:20, 40:44] += 3
    found = K.find_lines(y, (10, 70), 5, 4.0)
    assert found[8:16, 41:43].all() and not found[:, :30].any()
    assert K.find_lines(np.zeros((3, 80)), (10, 70), 5, 1.5) is None
    assert K.find_lines(y[6:7], (10, 70), 5, 1.5).shape == (1, 80)


def test_blur_keeps_constants():
    assert np.allclose(K.blur(np.full((7, 9), 3.0), 5), 3.0)


def test_components_are_removed():
    x = np.linspace(0, 1, 60)
    parts = np.stack([np.sin(9 * x), np.cos(23 * x)])
    c = np.random.default_rng(5).normal(0, 1, (40, 2))
    model = K.decompose(c @ parts + 1e-6 * np.random.default_rng(6).normal(0, 1, (40, 60)), 2)
    rows = np.random.default_rng(7).normal(0, 1, (5, 2)) @ model.components
    mask = np.ones(rows.shape, bool)
    out, used = K.correct(rows, model, mask, mask, K.Gates())
    assert np.abs(out).max() < 1e-6 and (used == 2).all()
    kept, used = K.correct(rows, model, mask, mask, K.Gates(), np.array([np.nan, np.nan]))
    assert np.array_equal(kept, rows) and (used == 0).all()


def test_kde_peak_finds_the_centre():
    v = np.random.default_rng(8).normal(12, 1, 2000)
    center, _ = K.kde_peak(v)
    assert abs(center - 12) < 0.5
    assert K.kde_peak(np.array([1.0])) is None
    limits = K.component_cutoffs(np.stack([v, v + 30], 1), 20.0, None)
    assert np.isfinite(limits[0]) and np.isnan(limits[1])


def test_small_ones():
    y = np.array([[0.0, 1, 4, 1, 0], [0, 0, 1, 4, 1]])
    assert np.allclose(K.shift_rows(y, np.array([1.0, -1.0]))[0, :4], [1, 4, 1, 0])
    assert K.detect_line(np.tile(y[:1], (4, 1)), kernel=3)[0] == 2 and K.width_at_half(y[0], 2) == 1
    t = K.taper(30, 10, 26)
    assert (t[:10] == 1).all() and (t[15:20] == 0).all() and 0 < t[10] < 1
    assert np.allclose(K.gauss_smooth(np.full((1, 9), 2.0), 1.5), 2.0)
    assert np.isfinite(K.peak_aligned_mean(y)).any()
    assert (K.lower_envelope(noisy(3, 64, False)) < noisy(3, 64, False).max()).all()
