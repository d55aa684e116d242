"""Exact quantiles against NumPy, in groups of all kinds, and with bins small enough for many rounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from specfold.operators import ranks

SHARES = (0.0, 0.05, 0.5, 0.731, 1.0)


def table():
    rng = np.random.default_rng(12)
    yield "normal", rng.normal(size=3_000)
    yield "ties", rng.integers(0, 4, 2_000).astype(float)
    yield "one", np.array([4.25])
    yield "equal", np.full(900, -0.0)
    yield "wide", np.concatenate([10.0 ** rng.uniform(-300, 300, 500), -(10.0 ** rng.uniform(-300, 300, 400))])
    yield "ends", np.array([-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324] * 30)
    yield None, rng.exponential(size=1_001)
    yield "hot", np.concatenate([np.full(4_000, 7.0), rng.normal(7, 1e-9, 1_500)])


@pytest.mark.parametrize("most, bins", [(10_000, 512), (40, 64)])
def test_quantiles(spark, most, bins):
    groups = dict(table())
    rows = [(k, float(v)) for k, values in groups.items() for v in values] + [("normal", float("nan")), ("normal", None), ("none", float("inf")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {r["g"]: r for r in ranks.quantiles(df, "v", SHARES, ["g"], most=most, bins=bins).collect()}
    assert got.keys() == groups.keys()
    for k, values in groups.items():
        s = np.sort(values)
        for p, found in zip(SHARES, got[k]["values"], strict=True):
            at = (len(s) - 1) * p
            low, high = s[int(np.floor(at))], s[int(np.ceil(at))]
            assert found == (low if low == high else (np.ceil(at) - at) * low + (at - np.floor(at)) * high) and got[k]["n"] == len(s)


def test_one_group_and_none(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    assert ranks.quantiles(df, df["v"] * 2, (0.25, 0.5), most=5, bins=16).first()[:] == (101, [50.0, 100.0])
    assert ranks.quantiles(df.where("v < 0"), "v", (0.5,)).count() == 0


def test_agrees_with_percentile(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").selectExpr("l_returnflag", "l_extendedprice * 1.0 as v")
    want = {r[0]: list(r[1]) for r in df.groupBy("l_returnflag").agg(F.percentile("v", [0.1, 0.5, 0.9])).collect()}
    assert {r[0]: r["values"] for r in ranks.quantiles(df, "v", (0.1, 0.5, 0.9), ["l_returnflag"], most=100, bins=64).collect()} == want
