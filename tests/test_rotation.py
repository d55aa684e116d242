"""Rotations against NumPy on whole arrays, and both ways in which rows meet their models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from specfold.operators import learned, modelled, rotation

K_, N, FIRST = 4, 24, 3


def brute(reference, science, parts, mean):
    """Coefficients, matrix and corrected spectra of one group."""
    one = lambda y: (y[:, FIRST : FIRST + N] - mean) @ parts.T
    r, s = one(reference), one(science)

    def turned(c):
        u = np.linalg.svd((c - c.mean(0)).T @ (c - c.mean(0)))[0]
        return u * np.sign(u[np.abs(u).argmax(0), np.arange(K_)])

    m = np.diag(np.where(np.abs(s.mean(0)) > 1e-10, r.mean(0) / s.mean(0), 1.0)) @ (turned(r) @ turned(s).T)
    out = science.copy()
    out[:, FIRST : FIRST + N] = s @ m.T @ parts + mean
    return s, m, s @ m.T, out


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    rows, models, want = [], [], {}
    for g in range(5):
        parts = np.linalg.qr(rng.normal(size=(N, K_)))[0].T
        mean = rng.normal(size=N)
        models.append((f"m{g % 2}", f"p{g}", parts.tolist(), mean.tolist(), FIRST, FIRST + N - 1))
        sets = []
        for kind, n in (("r", 40 + g), ("s", 60)):
            y = rng.normal(size=(n, FIRST + N + 2))
            y[:, FIRST : FIRST + N] = rng.normal(size=(n, K_)) * [5, 3, 2, 1] @ rng.normal(size=(K_, K_)) @ parts + mean + 0.5
            sets.append(y)
            rows += [(1_000 * g + 100 * (kind == "s") + i, f"m{g % 2}", f"p{g}", kind, v.tolist()) for i, v in enumerate(y)]
        want[g] = brute(*sets, parts, mean)
    holed = rng.normal(size=FIRST + N + 2)
    holed[7] = np.nan
    rows += [(9_000, "m0", "p0", "s", holed.tolist()), (9_001, "m0", "p0", "s", None), (9_002, "m9", "p0", "s", [1.0] * 40), (9_003, None, None, "s", [1.0] * 40), (9_004, "m0", "p0", "s", [1.0, 2.0]), (9_005, "m0", "p0", "r", [None] * 40)]
    df = spark.createDataFrame(rows, "row_id long, mission_id string, telescop string, kind string, spectrum array<double>").withColumn("coefficient", F.lit("clash"))
    return df, spark.createDataFrame(models, "mission_id string, telescop string, components array<array<double>>, mean array<double>, ch_first int, ch_last int"), want


@pytest.mark.parametrize("parts", [1, 7])
def test_rotation(table, parts, tmp_path):
    df, models, want = table
    df = df.repartition(parts)
    reference, science = df.where("kind = 'r'"), df.where("kind = 's'")
    done = {r["row_id"]: r for r in rotation.rotate(reference, science, models, str(tmp_path)).collect()}
    sums = [rotation.coefficient_sums(rotation.projected(r, models)) for r in (reference, science)]
    found = {r["telescop"]: r for r in rotation.matrices(*sums).collect()}
    for g, (before, matrix, after, out) in want.items():
        assert np.allclose(found[f"p{g}"]["matrix"], matrix, atol=1e-9) and found[f"p{g}"]["n_science"] == 60
        assert np.isclose(found[f"p{g}"]["condition_number"], np.linalg.cond(matrix)) and np.allclose(found[f"p{g}"]["strength"], np.linalg.norm(matrix, axis=1))
        for i in range(60):
            r = done[1_000 * g + 100 + i]
            assert np.allclose(r["coefficients"], before[i]) and np.allclose(r["corrected"], after[i]) and np.allclose(r["spectrum"], out[i])
    odd = {r["row_id"]: r["spectrum"] for r in science.where("row_id >= 9000").collect()}
    for i, before in odd.items():
        assert done[i]["corrected"] is None and str(done[i]["spectrum"]) == str(before)


def test_a_group_of_one_kind_stays(table):
    df, models, _ = table
    science = df.where("kind = 's' and telescop = 'p1'")
    done = rotation.rotate(df.where("kind = 'r' and telescop = 'p2'"), science, models).collect()
    assert all(np.allclose(r["coefficients"], r["corrected"]) for r in done) and len(done) == 60


def test_streams_give_what_broadcasts_give(spark, table, monkeypatch):
    df, models, _ = table
    monkeypatch.setattr(modelled, "SLICE_ROWS", 17)
    monkeypatch.setattr(modelled, "BLOCK_ROWS", 5)
    digits = lambda v: None if v is None else [round(x, 9) + 0.0 for x in v]
    rows = lambda d: sorted(str((r["row_id"], digits(r["coefficients"]), r["spectrum"])) for r in d.collect())
    assert rows(rotation.projected(df, models)) == rows(rotation.projected(df, models, most_bytes=0))
    full = models.withColumns({"variance": F.lit(None).cast("array<double>"), "ratio": F.array(*[F.lit(0.25)] * K_)})
    full = full.withColumn("variance", F.col("ratio"))
    known = df.where("row_id < 9000")
    one, two = ({r["row_id"]: r for r in learned.correct(known, full, most_bytes=m).collect()} for m in (1 << 20, 0))
    assert one.keys() == two.keys() and all(np.allclose(one[i]["spectrum"], two[i]["spectrum"]) and one[i]["n_used"] == two[i]["n_used"] for i in one)
    near = lambda d: sorted((r["row_id"], r["component"], round(r["coefficient"], 9)) for r in d.collect())
    assert near(learned.row_coefficients(known, full)) == near(learned.row_coefficients(known, full, most_bytes=0)) != []


def test_bytes_of_models(spark, table):
    _, models, _ = table
    assert 5 * K_ * N * 8 <= modelled.model_bytes(models) <= 5 * K_ * N * 8 * 3
    assert modelled.model_bytes(models.limit(0)) == 0
