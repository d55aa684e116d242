"""Queries on spectra: embeddings stand for them, 64 channels, 3 km/s a channel from 400 km/s."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specfold.functions import arrays as A
from specfold.functions import kernels as K
from specfold.operators import filters, quality
from specfold.operators import spectra as S
from specfold.operators.kernel_ops import map_arrays
from specfold.plans.registry import query, table
from specfold.shipping import ship

LINE = (28, 36)
CHANNELS = 64
#: Channels in long form, and with holes in every seventh spectrum.
LONG = "c AS (SELECT vec_id AS row_id, label AS telescop, label % 3 AS mission, i, CAST(embedding[i + 1] AS DOUBLE) AS x FROM embeddings, range(64) t(i))"
HOLED = "c AS (SELECT vec_id AS row_id, label AS telescop, i, CASE WHEN vec_id % 7 = 0 AND i % 5 = 0 THEN 'NaN'::DOUBLE ELSE CAST(embedding[i + 1] AS DOUBLE) END AS x FROM embeddings, range(64) t(i))"
R6 = "round({0}, 6) + 0.0"


def spectra(spark: SparkSession, sf_dir: str, holes: bool = False) -> DataFrame:
    x = F.transform("embedding", (lambda v, i: F.when((F.col("vec_id") % 7 == 0) & (i % 5 == 0), F.lit(float("nan"))).otherwise(v.cast("double"))) if holes else (lambda v: v.cast("double")))
    return table(ship(spark), sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), F.col("label").alias("telescop"), (F.col("label") % 3).alias("mission"), x.alias("spectrum"), F.lit(400000.0).alias("velocity"), F.lit(3000.0).alias("deltav"), F.lit(1.0).alias("crpix1"))


def r6(c):
    return F.round(c, 6) + 0.0


def long_form(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select("row_id", *keep, F.posexplode("spectrum").alias("i", "x"))


@query(f"WITH {HOLED} SELECT row_id, bool_or(abs(x) > 0.3 AND NOT isnan(x)) AS over FROM c GROUP BY row_id")
def filter_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectra(spark, sf_dir, True).select("row_id", filters.over_peak("spectrum", 0.3).alias("over"))


@query(f"WITH {HOLED} SELECT row_id FROM c GROUP BY row_id HAVING count(*) FILTER (WHERE isnan(x)) / count(*) < 0.2")
def filter_nan_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectra(spark, sf_dir, True).where(filters.nan_fraction("spectrum") < 0.2).select("row_id")


@query(f"WITH {HOLED} SELECT row_id FROM c GROUP BY row_id HAVING NOT bool_and(isnan(x) OR x * (row_id % 11) = 0)")
def filter_all_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spectra(spark, sf_dir, True).withColumn("spectrum", F.transform("spectrum", lambda x: x * (F.col("row_id") % 11)))
    return rows.where(~filters.all_zero("spectrum")).select("row_id")


@query(f"""
WITH {HOLED}, f AS (SELECT row_id, count(*) FILTER (WHERE isnan(x) OR x = 0) / count(*) AS f FROM c GROUP BY row_id)
SELECT {R6.format("avg(f)")} AS mean, {R6.format("median(f)")} AS median, {R6.format("stddev_pop(f)")} AS std, min(f) AS least, max(f) AS most,
  count(*) FILTER (WHERE f = 0) AS n_none, count(*) FILTER (WHERE f > 0) AS n_some FROM f""")
def blank_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.blank_statistics(spectra(spark, sf_dir, True), filters.blank_fraction("spectrum"))
    return out.withColumns({c: r6(c) for c in ("mean", "median", "std")})


@query(f"WITH {HOLED} SELECT telescop, CAST(i AS INTEGER) AS pos, {R6.format('avg(x)')} AS mean, {R6.format('stddev_pop(x)')} AS std, count(*) AS n FROM c WHERE NOT isnan(x) GROUP BY telescop, i")
def avg_spectrum_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.average(spectra(spark, sf_dir, True), ["telescop"]).withColumns({"mean": r6("mean"), "std": r6("std")})


_NOISE = f"s AS (SELECT row_id, stddev_pop(x) AS s FROM c WHERE NOT isnan(x) AND (i < {LINE[0]} OR i >= {LINE[1]}) GROUP BY row_id)"


@query(f"WITH {HOLED}, {_NOISE} SELECT telescop, CAST(i AS INTEGER) AS pos, {R6.format('sum(x / (s * s)) / sum(1 / (s * s))')} AS mean FROM c JOIN s USING (row_id) WHERE NOT isnan(x) GROUP BY telescop, i")
def weighted_avg_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spectra(spark, sf_dir, True).withColumn("s", A.std(S.outside("spectrum", LINE)))
    return S.average(rows, ["telescop"], weight=1 / (F.col("s") * F.col("s"))).select("telescop", "pos", r6("mean").alias("mean"))


_BASE1 = f"""
l AS (SELECT row_id, regr_slope(x, i) AS b, regr_intercept(x, i) AS a FROM c WHERE NOT isnan(x) AND (i < {LINE[0]} OR i >= {LINE[1]}) GROUP BY row_id),
y AS (SELECT row_id, telescop, i, x - (a + b * i) AS x FROM c JOIN l USING (row_id))"""


@query(f"""
WITH {LONG}, {_BASE1},
s AS (SELECT row_id, any_value(telescop) AS telescop, stddev_pop(x) AS s FROM y WHERE i < {LINE[0]} OR i >= {LINE[1]} GROUP BY row_id),
e AS (SELECT telescop, count(*) AS n, sqrt(sum(1 / (s * s))) / sum(1 / (s * s)) AS expected FROM s GROUP BY telescop),
m AS (SELECT y.telescop, i, sum(x / (s * s)) / sum(1 / (s * s)) AS mean FROM y JOIN s USING (row_id) GROUP BY y.telescop, i),
g AS (SELECT telescop, stddev_pop(mean) AS noise FROM m WHERE i < {LINE[0]} OR i >= {LINE[1]} GROUP BY telescop),
x AS (SELECT telescop, n, expected, noise, noise / expected AS excess FROM e JOIN g USING (telescop)),
q AS (SELECT median(excess) AS med FROM x), d AS (SELECT median(abs(excess - med)) AS mad FROM x, q)
SELECT telescop, n, {R6.format("expected")} AS expected, {R6.format("noise")} AS noise, {R6.format("excess")} AS excess,
  {R6.format("med + 5 * 1.4826 * mad")} AS threshold, excess > med + 5 * 1.4826 * mad AS flag FROM x, q, d""")
def group_excess_flag_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line of the line-free channels subtracted; averages weighted by 1 / rms^2; their noise over the expected one."""
    rows = S.unclipped_baseline(spectra(spark, sf_dir), 1, LINE)
    out = S.group_excess(rows, "telescop", LINE)
    return out.withColumns({c: r6(c) for c in ("expected", "noise", "excess", "threshold")})


@query(f"WITH {HOLED} SELECT row_id, {R6.format('stddev_pop(x)')} AS rms FROM c WHERE NOT isnan(x) AND (i < {LINE[0]} OR i >= {LINE[1]}) GROUP BY row_id")
def row_rms_linefree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectra(spark, sf_dir, True).select("row_id", r6(A.std(S.outside("spectrum", LINE))).alias("rms"))


@query(f"""
WITH {LONG}, s AS (SELECT row_id, stddev_pop(x) AS s FROM c WHERE i < {LINE[0]} OR i >= {LINE[1]} GROUP BY row_id)
SELECT row_id, {R6.format("s / (abs(row_id % 13 + 1) / sqrt(3000 / 299792458.0 * 1.9005e12) * 1000)")} AS ratio FROM s""")
def rms_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured over theoretical noise."""
    theory = quality.theoretical_rms((F.col("row_id") % 13 + 1) * 1000.0, F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(40.0), F.col("deltav"), F.lit(1.9005e12))
    rows = spectra(spark, sf_dir).withColumn("rms", A.std(S.outside("spectrum", LINE)))
    return rows.select("row_id", r6(F.col("rms") / theory).alias("ratio"))


@query(f"WITH {HOLED} SELECT row_id, {R6.format('avg(x)')} AS mean FROM c WHERE NOT isnan(x) AND i BETWEEN 27 AND 40 GROUP BY row_id")
def window_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda v: A.channel_of(F.lit(v), "velocity", "deltav", "crpix1")
    rows = spectra(spark, sf_dir, True).withColumns({"a": at(480000.0), "b": at(520000.0)})
    return rows.select("row_id", r6(S.window_mean("spectrum", F.col("a"), F.col("b"))).alias("mean"))


_FREE = np.array([i < LINE[0] or i >= LINE[1] for i in range(CHANNELS)])


@query(f"""
WITH {HOLED}, f AS (SELECT row_id, i, x, CASE WHEN i < {LINE[0]} THEN 0 ELSE 1 END AS run FROM c WHERE i < {LINE[0]} OR i >= {LINE[1]}),
m AS (SELECT row_id, run, avg(x) AS m FROM f WHERE NOT isnan(x) GROUP BY ALL),
t AS (SELECT row_id, sqrt(sum((x - m) * (x - m)) / count(*)) AS total FROM f JOIN m USING (row_id, run) WHERE NOT isnan(x) GROUP BY row_id),
d AS (SELECT row_id, x - lag(x) OVER (PARTITION BY row_id, run ORDER BY i) AS d FROM f),
w AS (SELECT row_id, stddev_pop(d) / sqrt(2) AS white FROM d WHERE NOT isnan(d) AND d IS NOT NULL GROUP BY row_id)
SELECT row_id, {R6.format("total / white")} AS ripple FROM t JOIN w USING (row_id)""")
def ripple_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = map_arrays(spectra(spark, sf_dir, True), "spectrum", lambda y: K.ripple_ratio(y, _FREE), {"ripple": "double"})
    return out.select("row_id", r6("ripple").alias("ripple"))


@query(f"""
WITH {LONG}, f AS (SELECT row_id, x, row_number() OVER (PARTITION BY row_id ORDER BY i) - 1 AS j FROM c WHERE i < {LINE[0]} OR i >= {LINE[1]}),
b AS (SELECT row_id, j // 4 AS k, avg(x) AS m FROM f GROUP BY ALL),
w AS (SELECT row_id, 2 * stddev_pop(m) / (SELECT stddev_pop(x) FROM f WHERE f.row_id = b.row_id) AS whiteness FROM b GROUP BY row_id),
q AS (SELECT median(whiteness) AS med FROM w), d AS (SELECT median(abs(whiteness - med)) AS mad FROM w, q)
SELECT row_id, {R6.format("whiteness")} AS whiteness, CAST(whiteness > med + 2 * 1.4826 * mad AS INTEGER) AS whiteflag FROM w, q, d""")
def whiteness_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.whiteness_flags(spectra(spark, sf_dir), 4, 2.0, _FREE)
    return out.select("row_id", r6("whiteness").alias("whiteness"), "whiteflag")


@query("SELECT vec_id AS row_id, CAST(i AS INTEGER) AS i, CAST(400000.0 + i * 3000.0 AS DOUBLE) AS v FROM embeddings, range(64) t(i)")
def velocity_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.with_axis(spectra(spark, sf_dir))
    return rows.select("row_id", F.posexplode("axis").alias("i", "v"))


@query("SELECT vec_id AS row_id, CAST(round_even((400000 + vec_id * 375.0 - 400000) / 3000, 0) AS INTEGER) AS channel FROM embeddings")
def velocity_to_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectra(spark, sf_dir).select("row_id", A.channel_of(F.lit(400000.0) + F.col("row_id") * 375.0, "velocity", "deltav", "crpix1").alias("channel"))


@query(f"WITH {LONG} SELECT row_id, CAST(i - 17 AS INTEGER) AS i, x, (-16.0)::DOUBLE AS crpix1 FROM c WHERE 400000 + i * 3000 BETWEEN 450000 AND 520000")
def extract_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_form(S.extract(spectra(spark, sf_dir), 450000.0, 520000.0), "crpix1")


@query(f"WITH {LONG} SELECT row_id, CAST(i // 4 AS INTEGER) AS i, x, 12000.0::DOUBLE AS deltav FROM c WHERE i % 4 = 0")
def decimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_form(S.decimated(spectra(spark, sf_dir), 4), "deltav")


@query(f"WITH {LONG} SELECT a.row_id, CAST(a.i AS INTEGER) AS i, {R6.format('sum(b.x) / 5')} AS x FROM c a JOIN c b ON a.row_id = b.row_id AND b.i BETWEEN a.i - 2 AND a.i + 2 GROUP BY a.row_id, a.i")
def boxcar_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spectra(spark, sf_dir).withColumn("spectrum", A.boxcar("spectrum", 5))
    return long_form(rows).withColumn("x", r6("x"))


@query(f"WITH {HOLED} SELECT row_id, CAST(round_even((400000 + i * 3000 - 400000) / 10000.0, 0) AS INTEGER) AS i, {R6.format('avg(x)')} AS x FROM c WHERE NOT isnan(x) GROUP BY ALL")
def resample_bin_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = long_form(S.resampled(spectra(spark, sf_dir, True), 10000.0))
    return out.where(~F.isnan("x")).withColumn("x", r6("x"))


@query(f"WITH {HOLED}, m AS (SELECT row_id, avg(x) AS m FROM c WHERE NOT isnan(x) AND (i < {LINE[0]} OR i >= {LINE[1]}) GROUP BY row_id) SELECT row_id, CAST(i AS INTEGER) AS i, {R6.format('x - m')} AS x FROM c JOIN m USING (row_id) WHERE NOT isnan(x)")
def baseline_order0(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = long_form(S.unclipped_baseline(spectra(spark, sf_dir, True), 0, LINE))
    return out.where(~F.isnan("x")).withColumn("x", r6("x"))


@query(f"WITH {HOLED}, {_BASE1} SELECT row_id, CAST(i AS INTEGER) AS i, {R6.format('x')} AS x FROM y WHERE NOT isnan(x)")
def baseline_order1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = long_form(S.unclipped_baseline(spectra(spark, sf_dir, True), 1, LINE))
    return out.where(~F.isnan("x")).withColumn("x", r6("x"))


@query()
def baseline_sigma_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order 3, three rounds of clipping at three deviations."""
    return S.baselined(spectra(spark, sf_dir, True), 3, LINE).select("row_id", "spectrum")


@query()
def baseline_auto_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spectra(spark, sf_dir).withColumn("rms_theoretical", F.lit(0.1))
    return S.auto_baselined(rows, "rms_theoretical", LINE).select("row_id", "spectrum", "blorder")
