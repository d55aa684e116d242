"""Reads of FITS tables by filters, with and without an index of their ranges."""

import math
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, LessThanOrEqual

from specfold.sources import fits

NAN = float("nan")


def write(path, table):
    path.write_bytes(fits.header_bytes(fits.PRIMARY) + fits.table_bytes(table))


@pytest.fixture
def folder(tmp_path, monkeypatch):
    """Three files, one of which lacks a column; ranges of few rows."""
    monkeypatch.setattr(fits, "RANGE_BYTES", 1_000)
    for n, mission in enumerate(("F1", "F2", "F3")):
        rows = 200 if n < 2 else 50
        columns = {
            "mission_id": pa.array([mission] * rows),
            "scan": pa.array(np.arange(rows) + 1_000 * n, pa.int32()),
            "spectrum": pa.array([[float(i), NAN, 2.0] for i in range(rows)], pa.list_(pa.float32())),
        }
        if n < 2:
            columns["tsys"] = pa.array([NAN if i % 50 == 7 else i * 0.5 for i in range(rows)], pa.float64())
        write(tmp_path / f"{mission}.fits", pa.table(columns))
    return tmp_path


def reader(folder, index=None, tests=()):
    options = {"path": str(folder), "with": "spectrum"} | ({"index": index} if index else {})
    source = fits.FitsSource(options)
    out = source.reader(source.schema())
    assert list(out.pushFilters(list(tests))) == list(tests)  # Spark tries them again
    return out


def files_of(parts):
    return {os.path.basename(p.table.path) for p in parts if p.last > p.first}


def test_only_matching_files_and_ranges_are_opened(spark, folder, monkeypatch):
    index = str(folder / "index")
    every = reader(folder).partitions()
    fits.write_index(spark, str(folder), index)
    # the executors' workers do not see the patched size; ranges are those of the index
    ranged = reader(folder, index).partitions()
    assert sum(p.last - p.first for p in ranged) == sum(p.last - p.first for p in every) == 450

    def forbidden(path):
        raise AssertionError(f"{path} was opened in order to plan")

    monkeypatch.setattr(fits, "tables_of", forbidden)
    assert files_of(reader(folder, index, [EqualTo(("mission_id",), "F2")]).partitions()) == {"F2.fits"}
    assert files_of(reader(folder, index, [In(("mission_id",), ("F1", "F3"))]).partitions()) == {"F1.fits", "F3.fits"}
    assert files_of(reader(folder, index, [GreaterThan(("scan",), 1_100)]).partitions()) == {"F2.fits", "F3.fits"}
    assert files_of(reader(folder, index, [EqualTo(("mission_id",), "none")]).partitions()) == set()
    assert files_of(reader(folder, index, [IsNotNull(("tsys",))]).partitions()) == {"F1.fits", "F2.fits"}  # one has no such column
    assert files_of(reader(folder, index, [GreaterThan(("tsys",), 1e9)]).partitions()) == {"F1.fits", "F2.fits"}  # NaN is above all numbers
    assert files_of(reader(folder, index, [LessThanOrEqual(("tsys",), -1.0)]).partitions()) == set()


def test_ranges_within_a_file(folder):
    """Extremes of each range, against the rows; of the ranges only those that may hold a match are read."""
    (t,) = fits.tables_of(str(folder / "F1.fits"))
    ranges = fits.ranges_of(t)
    assert len(ranges) > 3 and ranges[0][0] == 0 and ranges[-1][1] == 200
    known = {(t.path, t.hdu): [(a, b, fits.extremes_of(t, a, b)) for a, b in ranges]}
    for a, b, extremes in known[t.path, t.hdu]:
        numbers = [i * 0.5 for i in range(a, b) if i % 50 != 7]
        high = math.inf if any(i % 50 == 7 for i in range(a, b)) else max(numbers)
        assert extremes == {"mission_id": ["F1", "F1"], "scan": [a, b - 1], "tsys": [min(numbers), high]}
    read = fits.FitsReader([t], fits.FitsSource({"path": t.path}).schema(), known)
    read.pushFilters([In(("scan",), (5, 199)), GreaterThan(("tsys",), 0.0)])
    parts = read.partitions()
    assert [p.first for p in parts] == [ranges[0][0], ranges[-1][0]]
    rows = [r for p in parts for b in read.read(p) for r in b.select(["scan", "row_id"]).to_pylist()]
    assert rows == [{"scan": 5, "row_id": 5}, {"scan": 199, "row_id": 199}]


def test_filters_give_the_rows_that_spark_gives(spark, folder):
    index = str(folder / "index")
    fits.write_index(spark, str(folder), index)
    fits.register(spark)
    plain = spark.createDataFrame(spark.read.format("fits").option("path", str(folder)).load().drop("file").toPandas())
    plain = plain.withColumn("tsys", F.when(F.col("mission_id") != "F3", F.col("tsys")))
    for condition in (
        "mission_id = 'F2'", "mission_id in ('F1', 'F3') and scan < 20", "tsys > 90", "tsys = double('NaN')", "not (tsys > 3)", "tsys <= 1.0 and scan >= 1001",
        "scan = 7 or scan = 1007", "tsys is null", "mission_id > 'F1' and scan <=> 2003", "scan = 12345", "mission_id like 'F%'", "spectrum[0] = 4.0", "scan > 1e300", "scan = 3000000000",
    ):
        want = sorted(r["row_id"] for r in plain.where(condition).select("row_id").collect())
        for given in (None, index):
            source = spark.read.format("fits").option("path", str(folder))
            got = (source.option("index", given) if given else source).load().where(condition).select("row_id")
            assert sorted(r["row_id"] for r in got.collect()) == want, (condition, given)
    loaded = fits.load(spark, str(folder), index, mission_id=["F1", "F2"], scan=(190, 1_004)).select("scan", F.col("spectrum")[0].alias("x"))
    assert sorted(tuple(r) for r in loaded.collect()) == [(i, float(i)) for i in range(190, 200)] + [(1_000 + i, float(i)) for i in range(5)]
    assert fits.load(spark, str(folder), index, scan=(None, 4)).count() == 5


def test_files_that_changed_or_came_later_are_read_whole(spark, folder):
    index = str(folder / "index")
    fits.write_index(spark, str(folder), index, ["MISSION_ID"])
    write(folder / "F1.fits", pa.table({"mission_id": pa.array(["F2"]), "spectrum": pa.array([[9.0]], pa.list_(pa.float32()))}))
    write(folder / "F4.fits", pa.table({"mission_id": pa.array(["F2"]), "spectrum": pa.array([[8.0]], pa.list_(pa.float32()))}))
    os.remove(folder / "F3.fits")
    assert fits.load(spark, str(folder), index, mission_id="F2").count() == 202
    assert fits.load(spark, str(folder), index, mission_id="F3").count() == 0
    with open(folder / "F2.fits", "r+b") as f:
        f.truncate(6_000)
    with pytest.raises(Exception, match="cut short"):
        fits.load(spark, str(folder), index, mission_id="F2").count()


def test_files_of_a_list(spark, folder):
    (folder / "list").write_text("F3.fits # first\n\n# none\n" + str(folder / "F1.fits") + "\n")
    rows = fits.load_list(spark, str(folder / "list"))
    assert rows.count() == 250 and fits.load_list(spark, str(folder / "list"), scan=(None, 9)).count() == 10
    assert {r["mission_id"]: r["n"] for r in rows.groupBy("mission_id").agg(F.min(F.shiftright("row_id", 40)).alias("n")).collect()} == {"F3": 0, "F1": 1}
    (folder / "none").write_text("# nothing\n")
    with pytest.raises(fits.FitsError):
        fits.load_list(spark, str(folder / "none"))
