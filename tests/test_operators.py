"""Filters, links, averages, grids and sources on small made tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from specfold.errors import ConfigError, FitsError, NoDataError, PairingError, SchemaError
from specfold.functions import arrays as A
from specfold.functions import kernels as K
from specfold.operators import cube, droprules, filters, grid, learned, links, provenance, quality
from specfold.operators import spectra as S
from specfold.sources import config, fits

NAN = float("nan")


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        (0, "2016_F1", "a1", "M51 CENTER", "ON", 1, 1, 10.0, 1.0, [1.0, 2.0, NAN, 4.0]),
        (1, "2016_F1", "a1", "TSYS", "ON", 1, 1, 9.0, NAN, [2.0] * 4),
        (2, "2016_F1", "a2", "TAU_SIG", "ON", 1, 2, 12.0, NAN, [0.1, 0.2, NAN, 2.0]),
        (3, "2016_F2", "a2", "m51 edge", "ON", 2, 3, 30.0, 9.0, [0.0, 0.0, NAN, 0.0]),
        (4, "2016_F2", "a2", "TAU_SIG", "ON", 2, 2, 1.0, NAN, [0.5] * 4),
        (5, "2016_F2", "a2", "M51 CENTER", "OFF", 2, 9, 2.0, NAN, [500.0, 1.0, 1.0, 1.0]),
    ]
    return spark.createDataFrame(data, "row_id long, mission_id string, aor_id string, object string, obsmode string, scan int, subscan int, t double, rms double, spectrum array<double>")


def reasons(df):
    return {r["row_id"]: r["reject_reason"] for r in df.collect()}


def test_filter_order_and_exemptions(rows):
    links_ = links.link_calibration(rows.where("object not in ('TSYS','TAU_SIG')"), rows.where("object = 'TAU_SIG'"), name="tau_id").select("row_id", "tau_id")
    spec = filters.FilterSpec(drop_obsmodes=("OFF",), cuts=(("rms", "<=", 5.0),), peak=100.0, tau_id="tau_id", drop_zero=True, science="m51")
    got = reasons(filters.with_reject_reason(rows.join(links_, "row_id", "left"), spec))
    assert got == {0: "tau", 1: None, 2: "tau_cal", 3: "param", 4: None, 5: "obsmode"}
    clean, rejected = filters.split(rows.join(links_, "row_id", "left"), spec)
    assert clean.count() + rejected.count() == 6


def test_kept_missions_are_in_neither_output(rows):
    clean, rejected = filters.split(rows, filters.FilterSpec(keep_missions=("F1",), nan_below=0.2, science="M51"))
    assert clean.count() == 1 and rejected.count() == 2


def test_nan_passes_cuts_but_not_strict_ones(rows):
    assert rows.where(filters.cut("rms", "<=", 5.0)).count() == 5
    assert rows.where(filters.strict_cut("rms", ">", 0.5)).count() == 2
    assert rows.where(filters.all_zero("spectrum")).count() == 1


def test_links_prefer_the_subscan_before_then_time(rows):
    science = rows.where("object not in ('TSYS','TAU_SIG')")
    got = {r["row_id"]: r["c"] for r in links.link_calibration(science, rows.where("object = 'TAU_SIG'"), name="c").collect()}
    assert got == {0: 2, 3: 4, 5: 4}
    assert {r["row_id"]: r["c"] for r in links.link_calibration(science, rows.where("object = 'TSYS'"), name="c").collect()} == {0: 1, 3: None, 5: None}
    left = filters.remap_links(links.link_calibration(science, rows.where("object = 'TAU_SIG'"), name="c"), rows.where("row_id <> 4"), ["c"])
    assert {r["row_id"]: r["c"] for r in left.collect()} == {0: 2, 3: None, 5: None}


def test_pairs_need_unique_keys(rows):
    with pytest.raises(PairingError):
        links.check_unique(rows, ["mission_id"])
    assert links.pair_positional(rows.where("row_id < 3"), rows.where("row_id > 2")).count() == 3
    big = rows.sparkSession.range(0, 300_000, 3).withColumnRenamed("id", "row_id")
    got = links.ranked(big).orderBy("row_id").select("place").toPandas().place
    assert (got == np.arange(1, 100_001)).all()


def test_drop_rules(spark):
    tree = config.parse_yaml("F1:  # a flight\n  drop:\n    telescopes: [PX03]\n    scans:\n      - 4\nall_missions:\n  drop:\n    scan_telescopes:\n      7: [PX01]\nF9:\n  drop:\n    flight: true\n")
    rules = droprules.rules_frame(spark, droprules.parse_rules(tree))
    rows = spark.createDataFrame([("F1", "PX03_S", 1), ("F1", "PX033", 1), ("F1", "PX00", 4), ("F2", "PX01", 7), ("F2", "PX01", 8)], "mission_id string, telescop string, scan int")
    assert {tuple(r) for r in droprules.apply_rules(rows, rules).collect()} == {("F1", "PX033", 1), ("F2", "PX01", 8)}
    assert [r["hits"] for r in droprules.rule_counts(rows, rules).orderBy("rule_id").collect()] == [1, 1, 1, 0]
    assert "7: [PX01, PX02]" in droprules.recommended_yaml([("F1", "PX02", 7), ("F1", "PX01", 7)])


def test_combine_keeps_links(spark):
    a = spark.createDataFrame([(0, 1), (1, None)], "row_id long, tau_id long")
    got = sorted(tuple(r) for r in provenance.combine([a, a], ["tau_id"]).select("hdu", "row_id", "tau_id").collect())
    assert got == [(0, 0, 2), (0, 2, None), (1, 1, 3), (1, 3, None)]
    with pytest.raises(SchemaError):
        provenance.combine([a, a.drop("tau_id")], [])


def test_names_dates_and_positions(spark):
    df = spark.createDataFrame([("LFAV_PX03_S", "2017-02-1"), ("other", "none")], "n string, d string")
    got = df.select(*provenance.parse_telescop("n"), provenance.repaired_date("d").cast("string").alias("day")).collect()
    assert tuple(got[0]) == ("LFA", "V", 3, "2017-02-01") and tuple(got[1]) == (None, None, None, None)
    s = spark.range(1).select(provenance.sexagesimal(F.lit(202.4696), True).alias("a"), provenance.sexagesimal(F.lit(-47.1952), False).alias("b")).first()
    assert tuple(s) == ("13:29:52.70", "-47:11:42.7")


def test_arrays_ignore_missing(spark):
    df = spark.createDataFrame([([1.0, NAN, 3.0, None, float("inf")],), ([],), (None,)], "s array<double>")
    got = df.select(A.mean("s").alias("m"), A.std("s").alias("d"), A.total("s").alias("t"), A.rms("s").alias("r"), A.argmax("s").alias("a")).collect()
    assert got[0]["m"] == 2 and got[0]["d"] == 1 and got[0]["t"] == 4 and got[0]["a"] == 2 and math.isclose(got[0]["r"], math.sqrt(5))
    assert math.isnan(got[1]["m"]) and got[2]["m"] is None


def test_reduction_moves_the_axis(spark):
    y = [float(i) for i in range(40)]
    rows = spark.createDataFrame([(1, "x", y, 1000.0, 10.0, 5.0)], "row_id long, object string, spectrum array<double>, velocity double, deltav double, crpix1 double")
    cut = S.extract(rows, 1100.0, 1200.0).first()
    assert cut["spectrum"][0] == 14.0 and cut["crpix1"] == 5.0 - 14 and len(cut["spectrum"]) == 11
    out = S.reduce_spectra(rows, S.Reduction(baseline=1, smooth=3, decimate=True)).first()
    assert len(out["spectrum"]) == 14 and out["deltav"] == 30.0 and abs(np.array(out["spectrum"])[1:-1]).max() < 1e-9
    with pytest.raises(NoDataError):
        S.reduce_spectra(rows.withColumn("spectrum", F.array(F.lit(NAN))), S.Reduction(unblank=0.2))
    with pytest.raises(SchemaError):
        S.check_uniform_grid(rows.union(rows.withColumn("velocity", F.lit(1500.0))))
    same = S.resampled(rows, 20.0).first()
    assert same["deltav"] == 20.0 and same["crpix1"] == 1.0 and same["velocity"] % 20 == 0


def test_average_agrees_with_numpy(spark):
    y = np.random.default_rng(1).normal(0, 1, (20, 8))
    y[3, 2] = np.nan
    rows = spark.createDataFrame([(i, i % 2, r.tolist()) for i, r in enumerate(y)], "row_id long, g int, spectrum array<double>")
    got = {r["g"]: r for r in S.average_spectra(rows, ["g"]).collect()}
    for g in (0, 1):
        assert np.allclose(got[g]["spectrum"], np.nanmean(y[g::2], 0)) and np.allclose(got[g]["std"], np.nanstd(y[g::2], 0)) and got[g]["n"] == 10


def test_gridding_a_constant_is_constant(spark):
    rng = np.random.default_rng(2)
    pts = [(float(a), float(d), 7.0, [7.0, NAN, 7.0]) for a, d in zip(10 + rng.uniform(0, 0.05, 300), 40 + rng.uniform(0, 0.05, 300), strict=True)]
    rows = spark.createDataFrame(pts, "ra double, dec double, value double, spectrum array<double>")
    frame = grid.frame_of(rows, 0.004)
    m = grid.grid_map(rows, frame, 0.008).toPandas()
    assert np.allclose(m.value, 7.0) and len(m) > 100
    c = grid.grid_cube(rows, frame, 0.008).toPandas().merge(m, on=["y", "x"], suffixes=("_c", ""))
    assert len(c) == len(m) and np.allclose([s[0] for s in c.spectrum], 7.0) and all(math.isnan(s[1]) for s in c.spectrum) and np.allclose(c.coverage_c, c.coverage)
    assert grid.regrid(grid.grid_map(rows, frame, 0.008), frame, frame, 0.008).count() > 50
    assert cube.eroded(grid.grid_map(rows, frame, 0.008), 1).count() < len(m)
    k, reached, pixel = grid.resolution(14.1)
    assert math.isclose(k, 4.7) and math.isclose(reached, 14.1 * math.sqrt(10) / 3) and math.isclose(pixel, reached / 2)


def test_map_masks(spark):
    m = spark.createDataFrame([(y, x, float(x)) for y in range(5) for x in range(5)], "y int, x int, value double")
    assert m.where(cube.in_polygon([(-0.5, -0.5), (2.5, -0.5), (2.5, 2.5), (-0.5, 2.5)])).count() == 9
    assert m.where(cube.in_circle(2, 2, 1)).count() == 5
    assert cube.eroded(m, 1).count() == 9
    assert cube.clipped(m, 1, 3).agg(F.min("value"), F.max("value")).first()[:] == (0.0, 3.0)
    assert cube.crop_box(m.where("x > 1")).first()[:] == (0, 4, 2, 4)
    assert cube.smoothed(m, 0.5).where("y = 2 and x = 2").first()["value"] == pytest.approx(2.0)


def test_models_are_fitted_matched_and_subtracted(spark, tmp_path):
    rng = np.random.default_rng(3)
    part = np.sin(np.arange(48) / 3)
    data = [(i, "F1", "PX01", 1, (rng.normal() * part + 0.01 * rng.normal(size=48)).tolist()) for i in range(60)]
    rows = spark.createDataFrame(data, "row_id long, mission_id string, telescop string, scan int, spectrum array<double>")
    rows = S.baselined(rows, 1)
    models = learned.fit_models(rows, 1)
    for how in (20_000, 0):  # broadcast, and streamed
        out = learned.correct(rows, models, most_bytes=how)
        assert np.abs(np.array([r["spectrum"] for r in out.collect()])).max() < 0.2 and out.where("n_used = 1").count() == 60
    assert learned.correct(rows.withColumn("telescop", F.lit("PX09")), models).where("n_used is null").count() == 60
    again = learned.correct_with_lines(rows, models, (10, 30), str(tmp_path), rounds=1, overall=50.0)
    assert again.count() == 60
    mean, comps = learned.cube_components(rows, 1)
    flat = K.baseline(part[None, :], 1)[0]  # what is left of the part in baselined rows
    assert abs(abs(comps[0] @ flat) / np.linalg.norm(flat) - 1) < 0.01
    assert learned.cube_filtered(rows, mean, comps).count() == 60


def test_quality(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(1000.0,), (NAN,)], "v double")
    flagged = quality.mad_flags(df, "v", 3.0)
    assert flagged.where("flag").count() == 1
    assert quality.histogram(df, "v", 10).agg(F.sum("n")).first()[0] == 101
    assert quality.metric_stats(df, "v").first()["n"] == 101


def test_fits_round_trip(spark, tmp_path):
    fits.register(spark)
    rows = spark.createDataFrame([(i, f"obj{i}", [float(i), NAN, 2.0], i * 0.5) for i in range(10)], "scan int, object string, spectrum array<float>, velocity double").repartition(2)
    rows.write.format("fits").mode("overwrite").save(str(tmp_path / "t"))
    back = spark.read.format("fits").option("path", str(tmp_path / "t")).load()
    got = back.select("scan", "object", "velocity", F.col("spectrum")[0].alias("s"), "row_id").toPandas().sort_values("scan")
    assert got.scan.tolist() == list(range(10)) and got.object.tolist() == [f"obj{i}" for i in range(10)] and got.s.tolist() == [float(i) for i in range(10)] and got.row_id.nunique() == 10
    assert fits.header_index(spark, str(tmp_path / "t")).where("key = 'NAXIS2'").agg(F.sum(F.col("value").cast("int"))).first()[0] == 10
    frame = grid.Frame(10.0, 40.0, 0.01, 3, 2, 2.0, 2.0)
    fits.write_map(spark.createDataFrame([(0, 1, 5.0)], "y int, x int, value double"), frame, str(tmp_path / "m.fits"))
    with open(tmp_path / "m.fits", "rb") as f:
        head = fits.read_header(f)
        image = np.frombuffer(f.read(24), ">f4").reshape(2, 3)
    assert head["CTYPE1"] == "RA---SIN" and image[0, 1] == 5.0 and np.isnan(image[1, 1])
    with pytest.raises(FitsError):
        fits.tables_of(str(tmp_path / "none.fits"))


def test_config(tmp_path, spark):
    (tmp_path / "config.toml").write_text(config.TEMPLATE)
    (tmp_path / "a" / "b").mkdir(parents=True)
    c = config.Config.load(config.find_config(start=tmp_path / "a" / "b"))
    assert c.get("parameters.beam") == 14.1 and c.get("no.such", 3) == 3
    with pytest.raises(ConfigError):
        c.stage_path("nothing")
    merged = config.merge_yaml("F1:  # note\n  telluric_line_center: 3\n  pca:\n    n_components: 2\nF2:\n  x: 1\n", "F1", {"n_components": 7})
    assert config.parse_yaml(merged)["F1"] == {"telluric_line_center": 3, "pca": {"n_components": 7}} and "# note" in merged
    (tmp_path / "list").write_text("a.fits # first\n\n# none\nb.fits\n")
    assert fits.read_manifest(spark, str(tmp_path / "list")) == ["a.fits", "b.fits"]


def test_stream_equals_batch(spark, tmp_path):
    from specfold.streaming import stages

    y = np.random.default_rng(4).normal(0, 1, (12, 32))
    rows = spark.createDataFrame([(i, "m51" if i % 3 else "TSYS", r.tolist()) for i, r in enumerate(y)], "row_id long, object string, spectrum array<double>")
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    spec = filters.FilterSpec(peak=2.5, science="m51")
    stream = stages.reduced_stream(stages.read_stream(spark, str(tmp_path / "in"), rows.schema), spec, 1, None, 3)
    stages.start(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    a = {r["row_id"]: r["spectrum"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    b = {r["row_id"]: r["spectrum"] for r in stages.reduced_stream(rows, spec, 1, None, 3).collect()}
    assert a.keys() == b.keys() and len(a) >= 4 and all(np.allclose(a[k], b[k]) for k in a)


def test_pipeline(spark, tmp_path):
    from specfold.plans import pipeline

    rng = np.random.default_rng(5)
    part = np.sin(np.arange(48) / 4)
    data = []
    for i in range(120):
        kind = "M51" if i % 3 == 0 else "SKYCHOPDIFF" if i % 3 == 1 else "TSYS" if i % 2 else "TAU_SIG"
        y = rng.normal() * part + 0.02 * rng.normal(size=48)
        data.append((i, "F1", "PX01", kind, "ON", 1, i % 7, float(i), (np.full(48, 0.3) if kind == "TAU_SIG" else y).tolist(), 0.0, 1.0, 1.0, 10 + (i % 10) * 0.002, 40 + (i // 10) * 0.002))
    rows = spark.createDataFrame(data, "row_id long, mission_id string, telescop string, object string, obsmode string, scan int, subscan int, t double, spectrum array<double>, velocity double, deltav double, crpix1 double, ra double, dec double")
    out = pipeline.run(rows, pipeline.Plan(filters=filters.FilterSpec(science="M51", peak=50.0), reduction=S.Reduction(baseline=1), window=(20, 26), n_components=1, detect=False), "M51", str(tmp_path))
    assert out["corrected"].count() == 40 and out["cube"].count() > 20
    assert out["prepared"].where("object = 'M51' and tau_id is not null and tsys_id is not null").count() == 40
    left = np.array([r["spectrum"] for r in out["corrected"].collect()])
    assert np.abs(left[:, [*range(18), *range(28, 48)]]).max() < 0.5  # the protected core is not corrected
    done = pipeline.post_process(out["corrected"].withColumn("rms_theoretical", F.lit(0.02)), (20, 26))
    assert done.where("rmsratiob is not null and whiteflag in (-1, 0, 1)").count() == 40


def test_coherence_runs(spark):
    v = np.sin(np.arange(20))
    data = [("F1", f"P{p}", c, float(i), float(v[i] * (1 if c == 0 else (-1) ** (p * i)))) for p in range(3) for c in range(2) for i in range(20)]
    rows = spark.createDataFrame(data, "mission_id string, telescop string, component int, velocity double, value double")
    scores = S.coherence(rows)
    assert scores.where("component = 0").first()["score"] == pytest.approx(1.0)
    assert S.chosen_components(scores, 0.9).first()["n_components"] in (1, 2)


@pytest.mark.parametrize("reject", [None, 1.5])
def test_models_of_large_groups_see_all_rows(spark, reject):
    """More rows than any sample, in a large and a small group, some of them with holes: the fit of all of a group's rows at once."""
    rng = np.random.default_rng(8)
    y = rng.normal(size=(24_300, 3)) * [3, 2, 1] @ rng.normal(size=(3, 16)) + 0.1 * rng.normal(size=(24_300, 16)) + 5
    y[::50, 4] = NAN
    y[7, 2] = math.inf
    y[3, :9] = NAN
    of = ["PX01" if i < 24_000 else "PX02" for i in range(len(y))]
    rows = spark.createDataFrame([(i, "F1", of[i], v.tolist()) for i, v in enumerate(y)], "row_id long, mission_id string, telescop string, spectrum array<double>")
    got = {m["telescop"]: m for m in learned.fit_models(rows, 2, core=(6, 10), reject_sigma=reject).collect()}
    for name, part in (("PX01", y[:24_000]), ("PX02", y[24_000:])):
        want = K.decompose(part, 2, None, (6, 10), 1, reject)
        assert got[name]["n_rows"] == len(part)
        for column in ("mean", "components", "variance", "ratio"):
            assert np.allclose(got[name][column], getattr(want, column), rtol=1e-8, atol=1e-9)


def test_lines_of_large_groups_are_those_of_one_image(spark):
    """A group of more rows than a block, with scales that differ along it, beside a small group and one without values."""
    rng = np.random.default_rng(9)
    y = rng.normal(0, 1, (500, 40)) * np.linspace(0.2, 2, 500)[:, None]
    y[120:400, 18:22] += 6
    y[5:9] = NAN
    of = np.where(np.arange(500) % 9 == 0, "PX02", "PX01")
    data = [(i, "F1", str(of[i]), 1, v.tolist()) for i, v in enumerate(y)] + [(1000 + i, "F2", "PX01", 1, [NAN] * 40) for i in range(150)]
    rows = spark.createDataFrame(data, "row_id long, mission_id string, telescop string, scan int, spectrum array<double>")
    got = {r["row_id"]: r for r in learned.detect_lines(rows, (8, 34), 9, 1.5, block=64).collect()}
    assert len(got) == len(data) and not any(got[1000 + i]["n_line"] for i in range(150))
    for name in ("PX01", "PX02"):
        at = np.flatnonzero(of == name)
        want = K.find_lines(y[at], (8, 34), 9, 1.5)
        assert want.sum() > 50 and np.array_equal(np.array([got[i]["line_mask"] for i in at.tolist()]), want)
        assert [got[i]["n_line"] for i in at.tolist()] == want.sum(1).tolist()
