"""Smaller operators on made tables."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from specfold.functions import arrays as A
from specfold.functions import kernels as K
from specfold.operators import cube, filters, grid, learned, provenance
from specfold.operators import spectra as S
from specfold.sources import config, fits
from specfold.streaming import stages

NAN = float("nan")


def test_science_rows(spark):
    rows = spark.createDataFrame([("M51", "ON"), ("M51", "OFF"), ("TSYS", "ON"), ("m51 x", "ON"), ("TAU_SIG2", "ON")], "object string, sobsmode string")
    assert [r["object"] for r in rows.where(filters.science_rows("object", "sobsmode", "m51")).orderBy("object").collect()] == ["M51", "m51 x"]


def test_weights_and_axes(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 3.0), (1.5, NAN, 3.2), (NAN, 0.0, 3.9)], "rmsratio double, rms double, crpix1 double")
    w = rows.select(grid.noise_weight(ratio="rmsratio").alias("a"), grid.noise_weight(rms="rms").alias("b")).toPandas()
    assert w.a[0] == 1.0 and w.a[1] == pytest.approx(np.exp(-0.5)) and np.isnan(w.a[2]) and w.b[0] == 0.25 and w.b[1:].isna().all()
    assert S.table_crpix(rows).first()[:] == (3.2, True)
    axis = spark.createDataFrame([(-38.0, 1e6, 1.9e12)], "deltav double, cdelt1 double, restfreq double")
    assert axis.select(S.velocity_resolution(axis)).first()[0] == pytest.approx(0.038)
    assert axis.select(S.velocity_resolution(axis, "FREQ")).first()[0] == pytest.approx(299792.458 * 1e6 / 1.9e12)


def test_samples_repeat(spark):
    rows = spark.range(1000).withColumnRenamed("id", "row_id")
    a = [r[0] for r in S.sample_rows(rows, 20, 1).collect()]
    assert a == [r[0] for r in S.sample_rows(rows.repartition(7), 20, 1).collect()] == sorted(a) and len(a) == 20
    assert a != [r[0] for r in S.sample_rows(rows, 20, 2).collect()]


def test_models_long_form_and_skipped_missions(spark):
    models = spark.createDataFrame([("F1", "P", [[1.0, 2.0], [3.0, 4.0]], 5)], "mission_id string, telescop string, components array<array<double>>, ch_first int")
    got = {(r["component"], r["velocity"]): r["value"] for r in learned.component_long(models, 400000.0, 1000.0).collect()}
    assert got == {(0, 405.0): 1.0, (0, 406.0): 2.0, (1, 405.0): 3.0, (1, 406.0): 4.0}
    rows = spark.createDataFrame([("F1",), ("F2",)], "mission_id string")
    todo, left = learned.pass_through(rows, spark.createDataFrame([("F2", True), ("F1", False)], "mission_id string, skip_correction boolean"))
    assert [r[0] for r in todo.collect()] == ["F1"] and [r[0] for r in left.collect()] == ["F2"]
    assert learned.gates_of(noise=None, variance=0.1, other=3) == K.Gates(variance=0.1)


def test_provenance(spark, tmp_path):
    rows = spark.createDataFrame([("2016-05-1_GR_F296", "P", 1), ("x", "P", 2)], "mission_id string, telescop string, scan int")
    assert rows.select(provenance.flight_date("mission_id")).first()[0] == datetime.date(2016, 5, 1)
    text = rows.select(provenance.provenance({"nc": F.lit(5), "gnr": F.lit(None)}, F.col("scan") == 2).alias("p"))
    assert [r[0] for r in text.collect()] == ["nc=5 gnr=none", "nc=5 gnr=none skip=1"]
    assert text.select(provenance.provenance_value("p", "nc"), provenance.provenance_value("p", "gnr")).first()[:] == ("5", None)
    assert provenance.closest_names(rows, "y", "mission_id").first()[:] == ("x", 1)
    provenance.write_split(rows, str(tmp_path / "s"), ["telescop", "scan"])
    assert (tmp_path / "s" / "telescop=P" / "scan=2").is_dir()


def test_stage_tables(spark, tmp_path):
    c = config.Config({"output": {"clean": str(tmp_path / "clean")}, "parameters": {"beam": 14.1}, "missions": {"F1": {"beam": 6.0}}})
    assert config.save_stage(spark.range(3), c, "clean").count() == config.load_stage(spark, c, "clean").count() == 3
    assert c.mission("F1", "beam") == 6.0 and c.mission("F2", "beam") == 14.1
    got = config.mission_frame(spark, config.parse_yaml("F1:\n  telluric_line_center: 3.5\nF2:\n")).collect()
    assert [tuple(r) for r in got] == [("F1", 3.5, None), ("F2", None, None)]


def test_cube_files(spark, tmp_path):
    c = spark.createDataFrame([(0, 0, [1.0, 2.0, 3.0]), (1, 1, [4.0, NAN, 6.0])], "y int, x int, spectrum array<double>")
    frame = grid.Frame(10.0, 40.0, 0.01, 2, 2, 2.0, 2.0)
    fits.write_cube(c, frame, str(tmp_path / "c.fits"), 3, 400.0, 3.0)
    with open(tmp_path / "c.fits", "rb") as f:
        head = fits.read_header(f)
        data = np.frombuffer(f.read(48), ">f4").reshape(3, 2, 2)
    assert head["NAXIS3"] == 3 and data[2, 0, 0] == 3 and data[0, 1, 1] == 4 and np.isnan(data[1, 1, 1])
    assert fits.tables_of(str(tmp_path / "c.fits"))[0].n_rows == 3
    assert cube.spectrally_smoothed(c, 1.0).count() == 2


def test_masks(spark):
    row = spark.range(1).withColumn("s", F.array(*[F.lit(float(i)) for i in range(6)]))
    mask = A.any_mask(A.channel_mask(F.lit(6), 1, 2), A.channel_mask(F.lit(6), 5, 0))
    assert row.select(mask).first()[0] == [True, True, True, False, False, True]
    assert row.select(A.fill(A.apply_mask("s", mask), -1.0)).first()[0] == [-1, -1, -1, 3, 4, -1]


def test_spikes_and_line_tests(spark):
    from specfold.operators import lines

    y = np.random.default_rng(1).normal(0, 1, (2, 50))
    y[0, 10] = 99
    frame = lambda rows: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "row_id long, spectrum array<double>")
    assert np.flatnonzero(np.isnan(lines.despiked(frame(y), 5.0).orderBy("row_id").first()["spectrum"])).tolist() == [10]
    y = np.random.default_rng(2).normal(0, 1, (2, 50))
    y[0, 20:30] += 9
    assert [r["has_line"] for r in lines.with_line_test(frame(y), (20, 30), 3.0).orderBy("row_id").collect()] == [True, False]
    back = lines.with_range(lines.without_range(frame(y), 20, 30), 20, 30, -1.0).orderBy("row_id").first()["spectrum"]
    assert back == [*y[0, :20].tolist(), *[-1.0] * 10, *y[0, 30:].tolist()]



def test_windows_on_streams(spark, tmp_path):
    t = datetime.datetime(2020, 1, 1)
    rows = [(t + datetime.timedelta(minutes=10 * i), "m51" if i % 2 else "TSYS") for i in range(12)]
    df = spark.createDataFrame(rows, "ts timestamp, object string")
    df.write.parquet(str(tmp_path / "in"))
    got = []
    stream = stages.counts_by_window(stages.read_stream(spark, str(tmp_path / "in"), df.schema), "ts")
    query = stream.writeStream.outputMode("complete").foreachBatch(lambda b, _: got.append(b.agg(F.sum("n")).first()[0])).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert got[-1] == 12
