"""Queries of gridding, cubes, maps, components and lines: spectra on a raster of 20 columns and 28 rows, which further ones scan again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specfold.functions import arrays as A
from specfold.functions import kernels as K
from specfold.operators import cube as C
from specfold.operators import grid as G
from specfold.operators import learned as L
from specfold.operators import spectra as S
from specfold.plans.registry import query
from specfold.plans.spectral import LINE, LONG, R6, long_form, r6, spectra

FRAME = G.Frame(202.519, 47.224, 0.002, 24, 28, 13.0, 15.0)
KERNEL = 0.004
WINDOW = (28, 36)

#: Samples, pixel centres and their kernel.
CELLS = f"""
s AS (SELECT vec_id AS row_id, 202.5 + (vec_id % 20) * 0.002 AS ra, 47.2 + (vec_id // 20 % 28) * 0.002 AS dec, CAST(embedding[1] AS DOUBLE) AS v, 1.0 / (1 + vec_id % 3) AS w FROM embeddings),
p AS (SELECT CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, radians(-(x + 1 - 13.0) * 0.002) AS e, radians((y + 1 - 15.0) * 0.002) AS n FROM range(28) a(y), range(24) b(x)),
h AS (SELECT y, x, radians(202.519) + atan2(e, cos(radians(47.224)) * sqrt(1 - e * e - n * n) - sin(radians(47.224)) * n) AS r,
             asin(n * cos(radians(47.224)) + sin(radians(47.224)) * sqrt(1 - e * e - n * n)) AS d FROM p),
j AS (SELECT s.*, y, x, degrees(2 * asin(sqrt(pow(sin((d - radians(dec)) / 2), 2) + cos(d) * cos(radians(dec)) * pow(sin((r - radians(ra)) / 2), 2)))) AS far
      FROM s JOIN h ON abs(dec - degrees(d)) <= 0.013),
k AS (SELECT *, exp(-far * far / (2 * pow({KERNEL} / 2.355, 2))) AS k FROM j WHERE far <= 3 * {KERNEL})"""
CUBE = f"""{LONG}, {CELLS},
q AS (SELECT y, x, i, sum(k * c.x_) / sum(k) AS v, sum(k) AS cov FROM k JOIN (SELECT row_id, i, x AS x_ FROM c) c USING (row_id) GROUP BY y, x, i)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = {"ra": F.lit(202.5) + (F.col("row_id") % 20) * 0.002, "dec": F.lit(47.2) + F.floor(F.col("row_id") / 20) % 28 * 0.002}
    return spectra(spark, sf_dir).withColumns({**at, "value": F.col("spectrum")[0], "w": 1.0 / (1 + F.col("row_id") % 3)})


def cube_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.grid_cube(samples(spark, sf_dir), FRAME, KERNEL)


@query(f"WITH {CELLS} SELECT y, x, {R6.format('sum(k * v) / sum(k)')} AS value FROM k GROUP BY y, x")
def grid_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.grid_map(samples(spark, sf_dir), FRAME, KERNEL).select("y", "x", r6("value").alias("value"))


@query(f"WITH {CELLS} SELECT y, x, {R6.format('sum(k * w * v) / sum(k * w)')} AS value, {R6.format('sum(k * w)')} AS weight FROM k GROUP BY y, x")
def grid_map_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.grid_map(samples(spark, sf_dir), FRAME, KERNEL, weight=F.col("w")).select("y", "x", r6("value").alias("value"), r6("weight").alias("weight"))


@query(f"WITH {CELLS}, m AS (SELECT y, x, sum(k) AS coverage FROM k GROUP BY y, x) SELECT y, x, {R6.format('coverage')} AS coverage FROM m WHERE coverage >= 0.5 * (SELECT max(coverage) FROM m)")
def coverage_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.coverage_masked(G.grid_map(samples(spark, sf_dir), FRAME, KERNEL), 0.5).select("y", "x", r6("coverage").alias("coverage"))


@query(f"""
WITH {LONG}, t AS (SELECT row_id, i, pow(exp(-0.2 * (1 + row_id % 5)) / (2000 + row_id % 7 * 100 + i), 2) AS w FROM c WHERE row_id % 4 <> 0),
m AS (SELECT i, quantile_cont(w, 0.5) AS m FROM t GROUP BY i)
SELECT row_id, CAST(i AS INTEGER) AS pos, {R6.format("w / m")} AS w FROM t JOIN m USING (i)""")
def channel_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spectra(spark, sf_dir)
    linked = rows.select("row_id", F.when(F.col("row_id") % 4 != 0, F.col("row_id") * 2).alias("tsys_id"), F.when(F.col("row_id") % 4 != 0, F.col("row_id") * 2 + 1).alias("tau_id"))
    tsys = rows.withColumn("spectrum", F.transform("spectrum", lambda _, i: 2000.0 + F.col("row_id") % 7 * 100 + i)).select((F.col("row_id") * 2).alias("row_id"), "spectrum")
    tau = rows.withColumn("spectrum", F.transform("spectrum", lambda _: 0.2 * (1 + F.col("row_id") % 5))).select((F.col("row_id") * 2 + 1).alias("row_id"), "spectrum")
    return G.channel_weights(linked, tsys.union(tau)).withColumn("w", r6("w"))


@query(f"WITH {CUBE} SELECT y, x, {R6.format('sum(v) * 3')} AS value FROM q WHERE i BETWEEN 28 AND 36 GROUP BY y, x")
def cube_moment0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.moment0(cube_of(spark, sf_dir), WINDOW, 3.0).withColumn("value", r6("value"))


@query(f"WITH {CUBE} SELECT y, x, {R6.format('max(v)')} AS value, CAST(arg_max(i, v) AS INTEGER) AS channel FROM q GROUP BY y, x")
def cube_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.peak(cube_of(spark, sf_dir)).withColumn("value", r6("value"))


@query(f"""WITH {CUBE}, t AS (SELECT y, x, arg_max(i, v) AS top FROM q WHERE i BETWEEN 28 AND 36 GROUP BY y, x)
SELECT q.y, q.x, {R6.format('sum(v) * 3')} AS value FROM q JOIN t ON q.y = t.y AND q.x = t.x AND i BETWEEN 28 AND 36 AND abs(i - top) <= 2 GROUP BY q.y, q.x""")
def cube_peak_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.peak_range(cube_of(spark, sf_dir), WINDOW, 2, 3.0).withColumn("value", r6("value"))


@query(f"WITH {CUBE} SELECT y, x, round(sum(v * v * (400 + i * 3)) / sum(v * v), 6) + 0.0 AS value FROM q WHERE i BETWEEN 28 AND 36 GROUP BY y, x")
def cube_moment1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the squared intensities, which have no zero sum."""
    squared = cube_of(spark, sf_dir).withColumn("spectrum", F.transform("spectrum", lambda v: v * v))
    return C.moment1(squared, WINDOW, 400.0, 3.0).withColumn("value", r6("value"))


@query(f"WITH {CUBE} SELECT y, x, {R6.format('stddev_pop(v)')} AS value FROM q WHERE i NOT BETWEEN 28 AND 36 GROUP BY y, x")
def noise_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.noise_map(cube_of(spark, sf_dir), WINDOW).withColumn("value", r6("value"))


@query(f"""WITH {CUBE}, m AS (SELECT y, x, max(v) AS v, stddev_pop(v) FILTER (WHERE i NOT BETWEEN 28 AND 36) AS n FROM q GROUP BY y, x)
SELECT y, x, {R6.format('CASE WHEN v / n >= 2.5 THEN v ELSE 0 END')} AS value FROM m""")
def snr_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = cube_of(spark, sf_dir)
    return C.snr_masked(C.peak(cube), C.noise_map(cube, WINDOW), 2.5).select("y", "x", r6("value").alias("value"))


@query(f"""WITH {CELLS}, a AS (SELECT y, x, sum(k * v) / sum(k) AS v FROM k GROUP BY y, x), b AS (SELECT y, x, sum(k * w * v) / sum(k * w) AS v FROM k WHERE row_id % 2 = 0 GROUP BY y, x)
SELECT y, x, {R6.format('a.v - b.v')} AS value FROM a JOIN b USING (y, x)""")
def map_subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir)
    b = G.grid_map(rows.where("row_id % 2 = 0"), FRAME, KERNEL, weight=F.col("w"))
    return C.subtract(G.grid_map(rows, FRAME, KERNEL), b).withColumn("value", r6("value"))


@query(f"""WITH {CELLS}, m AS (SELECT abs(sum(k * v) / sum(k)) AS v FROM k GROUP BY y, x), t AS (SELECT quantile_cont(v, 0.99) AS p FROM m)
SELECT CAST(place AS INTEGER) AS place, {R6.format('p * f')} AS level FROM t, (VALUES (0, 0.25), (1, 0.5), (2, 0.75)) l(place, f)""")
def contour_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = G.grid_map(samples(spark, sf_dir), FRAME, KERNEL).withColumn("value", F.abs("value"))
    return C.contour_levels(m, (0.25, 0.5, 0.75)).withColumn("level", r6("level"))


@query(f"""WITH {CUBE} SELECT CAST(i AS INTEGER) AS pos, {R6.format('avg(v)')} AS mean, count(*) AS n FROM q WHERE pow(y - 14, 2) + pow(x - 12, 2) <= 25 GROUP BY i""")
def aperture_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.mean_spectrum(cube_of(spark, sf_dir), C.in_circle(14, 12, 5)).withColumn("mean", r6("mean"))


@query(f"""WITH {CELLS}, i AS (SELECT vec_id AS row_id, list_sum(list_transform(embedding[29:37], lambda e: CAST(e AS DOUBLE))) AS t FROM embeddings)
SELECT y, x, {R6.format('sum(k * t) / sum(k)')} AS value, {R6.format('sum(k * t) / sum(k) * 3')} AS integral FROM k JOIN i USING (row_id) GROUP BY y, x""")
def integrated_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.integrated_map(samples(spark, sf_dir), FRAME, KERNEL, 28, 36, 3.0).select("y", "x", r6("value").alias("value"), r6("integral").alias("integral"))


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectra(spark, sf_dir).withColumns({"mission_id": F.col("mission").cast("string"), "telescop": F.col("telescop").cast("string"), "scan": (F.col("row_id") % 2).cast("int")})


@query()
def pca_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.fit_models(_keyed(spark, sf_dir), 4, core=LINE, smooth=3).select("mission_id", "telescop", "n_rows", "variance", "ratio", "components")


@query()
def pca_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _keyed(spark, sf_dir)
    return L.correct(rows, L.fit_models(rows, 4, core=LINE), K.Gates(variance=0.005)).select("row_id", "spectrum", "n_used")


@query()
def line_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.detect_lines(_keyed(spark, sf_dir), (24, 40), 5, 1.5).select("row_id", "n_line", "line_mask")


@query()
def kde_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _keyed(spark, sf_dir)
    return L.cutoffs(L.noise_ratios(rows, L.fit_models(rows, 4)), 20.0)


@query()
def shuffle_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    squared = cube_of(spark, sf_dir).withColumn("spectrum", F.transform("spectrum", lambda v: v * v))
    return C.shuffled(squared, WINDOW, 400.0, 3.0, 0.5).select("y", "x", "spectrum", "shift")


@query(f"""
WITH {LONG}, g AS (SELECT row_id % 4 AS telescop, mission, i, avg(x) AS value FROM c GROUP BY ALL),
r AS (SELECT a.mission, a.telescop AS p, b.telescop AS q, corr(a.value, b.value) AS r FROM g a JOIN g b ON a.mission = b.mission AND a.i = b.i AND a.telescop < b.telescop GROUP BY ALL)
SELECT CAST(mission AS VARCHAR) AS mission_id, 0 AS component, {R6.format('median(abs(r))')} AS score FROM r GROUP BY mission""")
def component_coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of four pixels in place of a component of each."""
    long = long_form(spectra(spark, sf_dir), "mission", "velocity", "deltav")
    mean = long.groupBy(F.col("mission").cast("string").alias("mission_id"), (F.col("row_id") % 4).alias("telescop"), ((F.col("velocity") + F.col("i") * F.col("deltav")) / 1000).alias("velocity")).agg(F.avg("x").alias("value"))
    return S.coherence(mean.withColumn("component", F.lit(0))).withColumn("score", r6("score"))


@query(f"SELECT CAST(vec_id AS BIGINT) AS row_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS channel, {R6.format('CAST(list_max(embedding) AS DOUBLE)')} AS value FROM embeddings")
def row_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectra(spark, sf_dir).select("row_id", A.argmax("spectrum").alias("channel"), r6(F.array_max("spectrum")).alias("value"))
