"""Axes, selections, lines and maps where SQL does not look: errors, edges, and results that must not depend on size."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from specfold.errors import SchemaError
from specfold.functions import kernels as K
from specfold.operators import axes, cube, droprules, filters, grid, learned, lines
from specfold.operators import spectra as S
from specfold.plans import pipeline


def frame_of(spark, rows, columns="row_id long, spectrum array<double>"):
    return spark.createDataFrame(rows, columns)


def test_reference_pixels_and_parameters(spark):
    rows = spark.createDataFrame([(1, "a", 5.0), (2, "a", None), (3, "b", float("nan")), (4, "c", None)], "row_id long, file string, crpix1 double")
    heads = spark.createDataFrame([("a", 9.0), ("b", None)], "file string, crpix1 double")
    got = {r["row_id"]: r["crpix1"] for r in axes.with_reference_pixel(rows, heads).collect()}
    assert got == {1: 5.0, 2: 9.0, 3: 1.0, 4: 1.0}
    assert {r["crpix1"] for r in axes.with_reference_pixel(rows.drop("crpix1")).collect()} == {1.0}
    found = axes.spectral_parameters(rows.limit(0), headers={"velocity": 3.0}).first()
    assert found["velocity"] == 3.0 and found["deltav"] is None and found["crpix1"] == 1.0


def test_windows_of_ascending_and_descending_axes(spark):
    rows = spark.createDataFrame([(1, [0.0] * 10, 100.0, 10.0, 1.0), (2, [0.0] * 10, 190.0, -10.0, 1.0)], "row_id long, spectrum array<double>, velocity double, deltav double, crpix1 double")
    got = [(r["ch_first"], r["ch_last"]) for r in axes.window_channels(rows, 121.0, 149.0).orderBy("row_id").collect()]
    assert got == [(2, 5), (4, 7)]
    assert [(r["ch_first"], r["ch_last"]) for r in axes.window_channels(rows, 121_000.0, 149_000.0).orderBy("row_id").collect()] == got
    masks = [r["m"] for r in rows.select("row_id", axes.window_mask("spectrum", 120.0, 150.0).alias("m")).orderBy("row_id").collect()]
    assert [np.flatnonzero(m).tolist() for m in masks] == [[2, 3, 4, 5], [4, 5, 6, 7]]
    assert rows.select(F.size(axes.rolling("spectrum", 11)).alias("n")).first()["n"] == 0


def test_normalized_spectra_come_back(spark):
    rows = frame_of(spark, [(1, [1.0, 2.0, float("nan"), 4.0]), (2, [3.0, 3.0, 3.0, 3.0])]).withColumn("p", axes.normalized("spectrum"))
    for r in rows.select("spectrum", "p", axes.denormalized(F.col("p")).alias("back")).collect():
        assert np.allclose(r["back"], r["spectrum"], equal_nan=True)
    assert rows.where("row_id = 2").first()["p"]["values"] == [0.0] * 4


def test_rules_are_joined_on_equal_keys(spark):
    rows = spark.createDataFrame([(i, m, t, s) for i, (m, t, s) in enumerate([("A", "LFAV_PX01", 1), ("A", "LFAV", 2), ("B", "LFAV_PX01", 1), (None, "LFAV_PX01", 1), ("B", None, 3), ("B", "HFAV_PX06_S", None), ("C", "LFAVX", 4)])], "row_id long, mission_id string, telescop string, scan int")
    rules = droprules.rules_frame(spark, [("A", "flight", None, None), (droprules.EVERY, "telescope", "LFAV", None), ("B", "scan", None, 3), (droprules.EVERY, "scan_telescope", "HFAV_PX06", 9)])
    kept = droprules.apply_rules(rows, rules)
    assert {r["row_id"] for r in kept.collect()} == {5, 6}
    assert {r["rule_id"]: r["hits"] for r in droprules.rule_counts(rows, rules).collect()} == {0: 2, 1: 4, 2: 1, 3: 0}
    for most in (0, droprules.MOST_BROADCAST):
        old, droprules.MOST_BROADCAST = droprules.MOST_BROADCAST, most
        try:
            for df in (droprules.apply_rules(rows, rules), droprules.rule_counts(rows, rules)):
                assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()
                df.collect()
        finally:
            droprules.MOST_BROADCAST = old


def test_selections(spark):
    rows = spark.createDataFrame([(1, "F1", "M51", 1, 2, [1.0, -9.0]), (2, "F1", "m51edge", 2, 2, [1e-12, 0.0]), (3, "F2", "M51", 1, 3, [2.0, float("nan")]), (4, "F2", "TSYS", 1, 2, [1e9, 0.0])], "row_id long, mission_id string, object string, scan int, subscan int, spectrum array<double>")
    got = lambda **how: [r["row_id"] for r in filters.correction_rows(rows, filters.CorrectionRows(**how)).orderBy("row_id").collect()]
    assert got(part="m51") == [1, 3] and got(part="m51", faintest=1e-14) == [1, 2, 3] and got(flights=("2",), subscans=(3,)) == [3] and got(missions=("none",)) == []
    assert [r["row_id"] for r in rows.where(filters.in_cycles(cycles=[(1, 2)])).collect()] == [1, 4] and rows.where(filters.in_cycles()).count() == 4
    assert filters.parse_cycle(" 3:14") == (3, 14)
    for bad in ("3", "a:1", "3:"):
        with pytest.raises(ValueError):
            filters.parse_cycle(bad)


def test_lines(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(0, 0.1, (60, 50)) + 2 * np.exp(-((np.arange(50) - 31) ** 2) / 8)
    rows = frame_of(spark, [(i, v.tolist()) for i, v in enumerate(y)]).withColumn("g", F.lit(1))
    for method in lines.METHODS:
        found = lines.line_channels(rows, ["g"], method).first()
        assert abs(found["channel"] - 31) <= 1 and found["confidence"] > 0.1 and 3 <= found["width"] <= 7
    with pytest.raises(ValueError):
        lines.line_channels(rows, ["g"], "other")
    assert rows.limit(0).transform(lambda d: lines.line_channels(d, ["g"])).count() == 0
    mean = np.array([r["mean"] for r in lines.aligned_mean(rows).orderBy("pos").collect()])
    assert np.allclose(mean, K.peak_aligned_mean(y), equal_nan=True, atol=1e-12)
    low = np.array([r["spectrum"] for r in lines.enveloped(rows.orderBy("row_id")).collect()])
    assert np.quantile(low, 0.02) > -0.15  # the curve runs along the lower edge


def test_cutoffs_do_not_depend_on_the_number_of_rows(spark):
    rng = np.random.default_rng(2)
    ratios = np.abs(np.concatenate([rng.normal(8, 2, 4_000), rng.normal(30, 5, 500)]))
    want = K.component_cutoffs(ratios[:, None], 20.0, None)[0]
    one = spark.createDataFrame([("a", "b", 0, float(v)) for v in ratios], "mission_id string, telescop string, component int, ratio double")
    many = one.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(60)))).drop("_n")
    few, much = (learned.cutoffs(df, 20.0).first()["cutoff"] for df in (one, many))
    assert few == pytest.approx(much, rel=1e-9) and few == pytest.approx(want, rel=0.02)


def test_components_against_all_rows_at_once(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 30)) + rng.normal(0, 0.01, (300, 30)) + 5
    rows = frame_of(spark, [(i, v.tolist()) for i, v in enumerate(y)]).repartition(7)
    mean, comps = learned.cube_components(rows, 3)
    _, _, v = np.linalg.svd(y - y.mean(0), full_matrices=False)
    assert np.allclose(mean, y.mean(0)) and np.allclose(np.abs((comps * v[:3]).sum(1)), 1)
    wide_mean, wide = learned.cube_components(rows, 3, most_channels=20)
    assert np.allclose(wide_mean, mean) and np.abs(np.abs((wide * v[:3]).sum(1)) - 1).max() < 1e-9
    parts = v[:3]
    models = spark.createDataFrame([("m", "t", parts.tolist(), [0.5, 0.3, 0.1], 0, 29)], "mission_id string, telescop string, components array<array<double>>, ratio array<double>, ch_first int, ch_last int")
    holed = y.copy()
    holed[::5, 3:6] = np.nan
    named = frame_of(spark, [(i, r.tolist()) for i, r in enumerate(holed)]).withColumns({"mission_id": F.lit("m"), "telescop": F.lit("t")})
    got = {(r["row_id"], r["component"]): r["coefficient"] for r in learned.row_coefficients(named, models).collect()}
    for i, row in enumerate(holed):
        use = np.isfinite(row)
        want = parts @ row if use.all() else np.linalg.lstsq(parts[:, use].T, row[use], rcond=None)[0]
        assert np.allclose([got[i, j] for j in range(3)], want)


def test_maps_that_do_not_fit_each_other(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0)], "y int, x int, value double")
    with pytest.raises(SchemaError):
        cube.subtract(a, a, units=("K", "Jy"))
    assert {r["value"] for r in cube.subtract(a, a, units=("K", "K")).collect()} == {0.0}
    with pytest.raises(ValueError):
        cube.collapse(spark.createDataFrame([(0, 0, [1.0])], "y int, x int, spectrum array<double>"), "other", (0, 0))
    fine, coarse = grid.Frame(10.0, 0.0, 0.001, 20, 20, 10.5, 10.5), grid.Frame(10.0, 0.0, 0.002, 10, 10, 5.5, 5.5)
    flat = lambda f, v: spark.createDataFrame([(y, x, v) for y in range(f.ny) for x in range(f.nx)], "y int, x int, value double")
    assert all(math.isclose(r["value"], 2.0) for r in cube.subtract(flat(fine, 5.0), flat(coarse, 3.0), frames=(fine, coarse)).collect())


def test_preparation_and_post_processing(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "M51" if i % 4 else "TSYS", "F1", "T", 1, i % 3, float(i), (rng.normal(size=40) + i / 10).tolist(), 400_000.0, 3_000.0, 1.0, float(i % 5)) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, object string, mission_id string, telescop string, scan int, subscan int, t double, spectrum array<double>, velocity double, deltav double, crpix1 double, rmsratiob double")
    telluric = spark.createDataFrame([("F1", 430.0, 12.0)], "mission_id string, telluric_line_center double, telluric_line_width double")
    got = pipeline.prepare(df, "m51", cuts=(("rmsratio", "<=", 2.0),), telluric=telluric, baseline=1).collect()
    assert {r["row_id"] for r in got} == {i for i in range(40) if i % 4 == 0 or i % 5 <= 2}
    assert all(abs(np.mean(r["spectrum"])) < 0.2 for r in got if r["object"] == "M51") and all(r["tsys_id"] is not None for r in got if r["object"] == "M51")
    noisy = df.where("object = 'M51'").withColumns({"tsys": F.lit(1_000.0), "spectime": F.lit(1.0), "reftime": F.lit(1.0), "tau_atm": F.lit(0.1), "elevatio": F.lit(40.0), "restfreq": F.lit(1.9e12)})
    out = pipeline.post_process(noisy, (15, 20), telluric=telluric).collect()
    assert len(out) == 30 and all(r["rms_theoretical"] > 0 and math.isfinite(r["rmsratiob"]) for r in out)
    again = {r["row_id"]: r["spectrum"] for r in pipeline.post_process(noisy, (15, 20), telluric=telluric).collect()}
    assert all(again[r["row_id"]] == r["spectrum"] for r in out)  # seeded noise


def test_recommended_components(spark):
    rng = np.random.default_rng(5)
    shared = np.cos(np.arange(40) / 3)
    rows = [(i, "F1", f"P{i % 3}", (rng.normal() * 3 * shared + rng.normal(0, 0.3, 40)).tolist()) for i in range(150)]
    df = spark.createDataFrame(rows, "row_id long, mission_id string, telescop string, spectrum array<double>")
    assert learned.recommended_components(df, 0.0, 1_000.0, most=4).first()["n_components"] == 1


def test_uniform_tables(spark):
    one = frame_of(spark, [(i, [0.0]) for i in range(3)]).withColumns({"velocity": F.lit(1.0), "deltav": F.lit(2.0)})
    assert axes.uniformity(one).first()["uniform"]
    S.check_uniform_grid(one)
    with pytest.raises(SchemaError):
        S.check_uniform_grid(one.withColumn("velocity", F.col("row_id").cast("double")))
