"""The multi-index on tables where it prunes."""

import numpy as np
import pytest

from specfold.llm import multiindex as M


def unit_rows(rng, n, width):
    x = rng.normal(size=(n, width))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("total", [1_000_000, 4_000_000])
def test_a_vector_reaches_few_blocks_of_a_large_table(total):
    """The blocks of a table of that many vectors, of which a sample fits the codebooks; pairs at the threshold are made apart from it."""
    rng = np.random.default_rng(3)
    x = unit_rows(rng, 18_000, 64)
    known, probes, asking, ends = x[:12_288], x[12_288:15_000], x[15_000:15_300], x[16_000:]
    k = int(np.sqrt(total / 64))
    grid = M.Grid(M.kmeans(known[:, :32], k), M.kmeans(known[:, 32:], k, seed=12))
    shares = [np.bincount(np.argmin(s, 1), minlength=k) / len(x) for s in grid.squares(x)]
    members = rng.poisson(total * np.outer(*shares).ravel())
    block = max(1_024, min(M.BLOCK_BYTES // 512, total // M.SPREAD))
    cells, tiles = M.tiled(grid, members, block)
    assert sorted(cells.tolist()) == list(range(k * k)) and (np.diff(tiles) >= 0).all()
    first, parts = np.zeros(k * k, np.int64), np.ones(k * k, np.int64)
    first[cells], parts[cells] = M.packed(members[cells], block, tiles)
    held = np.bincount(first, members)
    n_blocks = int((first + parts)[members > 0].max())
    assert held.max() <= block and n_blocks < 4 * total / block
    most = M.visits(grid, probes, 0.9, 0.995, both=False)
    reached = [len(np.unique(first[r])) for r in grid.walk(grid.squares(asking), most)]
    assert np.mean(reached) < 0.1 * n_blocks
    met = []
    for one, other in M.partners(ends, 0.9, seed=99):
        a, b = grid.squares(one), grid.squares(other)
        met.append(((first[grid.walk(a, most)] == first[grid.cells(b)][:, None]) | (first[grid.walk(b, most)] == first[grid.cells(a)][:, None])).any(1))
    assert np.concatenate(met).mean() >= 0.99


def test_blocks_end_with_their_tiles():
    members, tiles = np.array([4, 4, 3, 3, 25, 2, 6, 6]), np.array([0, 0, 1, 1, 2, 3, 3, 4])
    first, parts = M.packed(members, 10, tiles)
    assert first.tolist() == [0, 0, 1, 1, 2, 5, 5, 6] and parts.tolist() == [1, 1, 1, 1, 3, 1, 1, 1]


def test_links_of_a_table_of_many_blocks(spark):
    """Against brute force where a vector reaches a part of the blocks: groups of near copies, a hot cell cut into parts, repeated rows. No link is counted twice or made up."""
    rng = np.random.default_rng(21)
    x = unit_rows(rng, 6_000, 32)
    x[:1_500] = x[0] + 0.03 * rng.normal(size=(1_500, 32))  # a quarter of all rows in one cell
    for i in range(300):
        x[2_000 + i] = x[3_000 + i // 3] + 0.05 * rng.normal(size=32)
    x[5_900:] = x[5_800:5_900]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in M.near_duplicates(df, block=32).collect()}
    count = near.sum(1)
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (found <= count).all() and found.sum() >= 0.999 * count.sum()
    for i in range(2_000):  # vectors that stand far apart stay alone
        assert got[i]["component_id"] <= i
    assert all(got[i]["component_id"] == 0 for i in range(1_500))
