"""Calibration links of one hot scan over many blocks against a plain search."""

import random

import pytest

from specfold.operators import links

SCHEMA = "row_id long, mission_id string, scan int, subscan int, t double"


def plain(science, calibration):
    out = {}
    for row, mission, scan, subscan, t in science:
        own = [c for c in calibration if c[1:3] == (mission, scan) and None not in c[1:3]]
        timed = [c for c in calibration if c[1:3] == (mission, scan) and c[4] is not None]
        before = [c[0] for c in own if c[3] == (subscan or 0) - 1 and subscan is not None]
        if before:
            out[row] = min(before)
        elif t is not None and timed:
            out[row] = min(timed, key=lambda c: (abs(c[4] - t), c[0]))[0]
        else:
            out[row] = min((c[0] for c in own), default=None)
    return out


@pytest.mark.parametrize("blocks", [1, 9, 40])
def test_one_scan_spreads_over_blocks(spark, blocks):
    rng = random.Random(6)
    time = lambda: rng.choice([None, float(rng.randint(0, 400)) / 2])
    science = [(i, "hot", 1, rng.randint(0, 60), time()) for i in range(900)]
    science += [(2_000 + i, rng.choice("ab"), rng.randint(1, 4), rng.choice([None, 3, 5]), time()) for i in range(200)] + [(5_000, None, 1, 2, 7.0), (5_001, "alone", 9, 2, 7.0)]
    calibration = [(10_000 + i, "hot", 1, rng.randint(0, 25), time()) for i in range(25)] + [(11_000 + i, rng.choice("ab"), rng.randint(1, 4), rng.randint(1, 9), time()) for i in range(30)]
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r["row_id"]: r["cal_id"] for r in links.link_calibration(frame(science), frame(calibration), blocks=blocks).collect()}
    assert got == plain(science, calibration)


def test_rows_of_one_scan_are_dealt_to_blocks(spark, tmp_path):
    rows = spark.range(4_000).selectExpr("id as row_id", "'m' as mission_id", "1 as scan", "5 as subscan", "cast(id as double) as t")
    links.link_calibration(rows, rows.where("row_id % 100 = 0").withColumn("subscan", rows["scan"]), blocks=8, folder=str(tmp_path)).count()
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/line").groupBy("_block").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1_000
