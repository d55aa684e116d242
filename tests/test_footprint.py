"""Holes and outer rings against a plain flood, whatever the strips."""

import numpy as np
import pytest

from specfold.operators import footprint


def plain_holes(mask):
    ny, nx = mask.shape
    out = np.zeros_like(mask)
    todo = [(y, x) for y in range(ny) for x in range(nx) if (y in (0, ny - 1) or x in (0, nx - 1)) and not mask[y, x]]
    while todo:
        y, x = todo.pop()
        if 0 <= y < ny and 0 <= x < nx and not mask[y, x] and not out[y, x]:
            out[y, x] = True
            todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
    return ~mask & ~out


def plain_trim(mask, rings):
    filled = np.pad(mask | plain_holes(mask), rings)
    ny, nx = mask.shape
    inner = np.all([filled[dy : dy + ny, dx : dx + nx] for dy in range(2 * rings + 1) for dx in range(2 * rings + 1)], 0)
    kept = mask & inner
    return kept if kept.any() else mask


def spiral(n):
    """A wall that winds inwards, so that the way out passes every strip many times."""
    out = np.zeros((n, n), bool)
    y, x, dy, dx, length = n // 2, n // 2, 0, 1, 2
    while 0 <= y < n and 0 <= x < n:
        for _ in range(2):
            for _ in range(length):
                if 0 <= y < n and 0 <= x < n:
                    out[y, x] = True
                y, x = y + dy, x + dx
            dy, dx = dx, -dy
        length += 2
    return out


def masks():
    rng = np.random.default_rng(9)
    ring = np.zeros((12, 9), bool)
    ring[2:10, 1:8] = True
    ring[4:8, 3:6] = False
    ring[5, 4] = True
    yield ring
    yield spiral(25)
    yield ~spiral(21)
    yield rng.random((30, 22)) < 0.62
    yield np.zeros((6, 7), bool)
    yield np.ones((5, 5), bool)
    yield np.array([[True, False, True]])


@pytest.mark.parametrize("mask", masks(), ids=range(7))
def test_holes_and_rings(spark, mask):
    ny, nx = mask.shape
    m = spark.createDataFrame([(int(y), int(x), 1.0 if hit else float("nan")) for (y, x), hit in np.ndenumerate(mask)], "y int, x int, value double").repartition(3)
    pixels = m.where("not isnan(value)").select("y", "x")
    for strip in (4_000_000, nx * 4):
        assert {(r.y, r.x) for r in footprint.holes(pixels, ny, nx, strip_pixels=strip).collect()} == set(zip(*np.nonzero(plain_holes(mask)), strict=True))
    for rings in (1 + mask.size % 2,) if ny != 12 else (0, 1, 2):
        want = plain_trim(mask, rings) if rings else mask
        assert {(r.y, r.x) for r in footprint.trimmed(m, rings, ny, nx, strip_pixels=nx * 7).collect()} == set(zip(*np.nonzero(want), strict=True))


def test_borders():
    for text, want in (("5%", 5), ("12", 12), ("30as", 6), ('30"', 6), ("1'", 12), ("0.5arcmin", 6), ("x", 0), ("-3", 0), (" 2.5 % ", 2)):
        assert footprint.border_rings(text, 5.0, 100, 300) == want
