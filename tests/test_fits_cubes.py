"""Cubes written by executors, read back as bytes."""

import os

import numpy as np
import pytest

from specfold.operators import grid
from specfold.sources import fits


def image_of(path):
    with open(path, "rb") as f:
        head = fits.read_header(f)
        shape = [head[f"NAXIS{i}"] for i in range(head["NAXIS"], 0, -1)]
        data = np.frombuffer(f.read(4 * int(np.prod(shape))), ">f4").reshape(shape)
        f.seek(-f.tell() % fits.BLOCK, 1)
        axis = fits.read_header(f)
    return head, data, axis


@pytest.mark.parametrize("block_bytes", [1, 700, 16 << 20])
def test_planes_of_any_block_size(spark, tmp_path, block_bytes):
    rng = np.random.default_rng(1)
    frame = grid.Frame(10.0, 40.0, 0.01, 9, 7, 4.0, 5.0)
    want = np.full((70, 7, 9), np.nan, np.float32)
    rows = []
    for y in range(7):
        for x in range(9):
            if y != 3 and (x + y) % 4:  # pixels and a whole row that the cube lacks
                v = rng.normal(size=70)
                v[rng.integers(70)] = np.nan
                want[:, y, x] = v
                rows.append((y, x, v.tolist(), float(x), float(y)))
    cube = spark.createDataFrame(rows, "y int, x int, spectrum array<double>, coverage double, weight double").repartition(5)
    path = str(tmp_path / "c.fits")
    fits.write_cube(cube, frame, path, 70, 400.0, 3.0, {"BUNIT": "K"}, block_bytes=block_bytes)
    head, data, axis = image_of(path)
    assert np.array_equal(data, want, equal_nan=True)
    assert (head["BUNIT"], head["CRVAL3"], axis["EXTNAME"]) == ("K", 400.0, "SPECTRUM") and os.path.getsize(path) % fits.BLOCK == 0
    assert fits.tables_of(path)[0].n_rows == 70 and os.listdir(tmp_path) == ["c.fits"]


def test_odd_cubes(spark, tmp_path):
    frame = grid.Frame(10.0, 40.0, 0.01, 3, 2, 2.0, 2.0)
    empty = spark.createDataFrame([], "y int, x int, spectrum array<float>")
    path = str(tmp_path / "c.fits")
    fits.write_cube(empty, frame, path, 4, 0.0, 1.0)
    assert np.isnan(image_of(path)[1]).all()
    before = open(path, "rb").read()
    for row in ((0, 0, [1.0]), (0, 0, None), (2, 0, [1.0] * 4), (0, -1, [1.0] * 4)):  # neither lengths nor places that do not fit
        with pytest.raises(Exception, match="the cube has"):
            fits.write_cube(spark.createDataFrame([row], "y int, x int, spectrum array<float>"), frame, path, 4, 0.0, 1.0)
        assert open(path, "rb").read() == before and os.listdir(tmp_path) == ["c.fits"]  # what stood there stays
