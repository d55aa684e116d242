"""Queries of rotations, sparse and independent components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specfold.operators import rotation as R
from specfold.operators import separations as P
from specfold.plans.registry import query
from specfold.plans.maps import _keyed
from specfold.plans.shapes import _MODEL, CHANNELS, _models, rounded
from specfold.plans.spectral import LONG, R6, long_form, r6, spectra

#: Every fourth row is a reference, the others are science; two cosines and a mean are the model.
_BASIS = f"p AS (SELECT k - 1 AS component, i, sqrt(2.0 / {CHANNELS}) * cos(pi() * k * (i + 0.5) / {CHANNELS}) AS p FROM range(1, 3) t(k), range({CHANNELS}) u(i))"
_SETS = f"""{LONG}, {_BASIS},
k AS (SELECT row_id, any_value(mission) AS mission, row_id % 4 = 0 AS ref, component, sum((x - 0.001 * i) * p) AS k FROM c JOIN p USING (i) GROUP BY row_id, component),
m AS (SELECT mission, ref, component, count(*) AS n, avg(k) AS m FROM k GROUP BY ALL),
x AS (SELECT a.mission, a.ref, a.component AS i, b.component AS j, sum((a.k - ma.m) * (b.k - mb.m)) AS xs
      FROM k a JOIN k b USING (row_id) JOIN m ma ON ma.mission = a.mission AND ma.ref = a.ref AND ma.component = a.component
      JOIN m mb ON mb.mission = b.mission AND mb.ref = b.ref AND mb.component = b.component GROUP BY ALL)"""
#: Principal directions of two by two matrices, largest entries positive; then the matrix, entry by entry.
_MATRIX = f"""{_SETS},
w AS (SELECT mission, ref, max(xs) FILTER (WHERE i = 0 AND j = 0) AS a, max(xs) FILTER (WHERE i = 0 AND j = 1) AS b, max(xs) FILTER (WHERE i = 1 AND j = 1) AS c FROM x GROUP BY mission, ref),
t AS (SELECT mission, ref, 0.5 * atan2(2 * b, a - c) AS t FROM w),
u AS (SELECT mission, ref, unnest([0, 0, 1, 1]) AS i, unnest([0, 1, 0, 1]) AS j, unnest([
        cos(t) * sign(CASE WHEN abs(cos(t)) >= abs(sin(t)) THEN cos(t) ELSE sin(t) END), -sin(t) * sign(CASE WHEN abs(sin(t)) >= abs(cos(t)) THEN -sin(t) ELSE cos(t) END),
        sin(t) * sign(CASE WHEN abs(cos(t)) >= abs(sin(t)) THEN cos(t) ELSE sin(t) END), cos(t) * sign(CASE WHEN abs(sin(t)) >= abs(cos(t)) THEN -sin(t) ELSE cos(t) END)]) AS u FROM t),
d AS (SELECT r.mission, r.component AS i, CASE WHEN abs(s.m) > 1e-10 THEN r.m / s.m ELSE 1 END AS d, r.m AS mr, s.m AS ms FROM m r JOIN m s ON s.mission = r.mission AND s.component = r.component WHERE r.ref AND NOT s.ref),
q AS (SELECT a.mission, a.i, b.i AS j, any_value(d.d) * sum(a.u * b.u) AS q FROM u a JOIN u b ON b.mission = a.mission AND b.j = a.j JOIN d ON d.mission = a.mission AND d.i = a.i WHERE a.ref AND NOT b.ref GROUP BY a.mission, a.i, b.i),
z AS (SELECT row_id, q.i AS component, sum(q.q * k.k) AS z FROM k JOIN q ON q.mission = k.mission AND q.j = k.component WHERE NOT k.ref GROUP BY row_id, q.i)"""


def _sets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reference rows, science rows, and models."""
    wave = lambda k: F.transform(F.sequence(F.lit(0), F.lit(CHANNELS - 1)), lambda i: (2.0 / CHANNELS) ** 0.5 * F.cos(F.pi() * k * (i + 0.5) / CHANNELS))
    rows = spectra(spark, sf_dir).select("row_id", F.col("mission").cast("string").alias("mission_id"), F.lit("PX").alias("telescop"), "spectrum")
    mean = F.transform(F.sequence(F.lit(0), F.lit(CHANNELS - 1)), lambda i: 0.001 * i)
    models = rows.select("mission_id", "telescop").distinct().select("*", F.array(wave(1), wave(2)).alias("components"), mean.alias("mean"), F.lit(0).alias("ch_first"), F.lit(CHANNELS - 1).alias("ch_last"))
    return rows.where("row_id % 4 = 0"), rows.where("row_id % 4 <> 0"), models


@query(f"WITH {_SETS} SELECT row_id, CAST(component AS INTEGER) AS component, {R6.format('k')} AS coefficient FROM k WHERE NOT ref")
def rotation_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Science rows on their model's components."""
    _, science, models = _sets(spark, sf_dir)
    return R.projected(science, models).select("row_id", F.posexplode("coefficients").alias("component", "c")).select("row_id", "component", r6("c").alias("coefficient"))


@query(f"WITH {_SETS} SELECT CAST(x.mission AS VARCHAR) AS mission_id, x.ref, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, n, {R6.format('m')} AS mean, {R6.format('xs')} AS cross_sum FROM x JOIN m ON m.mission = x.mission AND m.ref = x.ref AND m.component = x.i")
def rotation_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means and sums of products of both sets' coefficients."""
    reference, science, models = _sets(spark, sf_dir)
    sums = [R.coefficient_sums(R.projected(r, models)).withColumn("ref", F.lit(is_ref)) for r, is_ref in ((reference, True), (science, False))]
    out = sums[0].unionByName(sums[1]).select("mission_id", "ref", "n", "mean", F.posexplode("cross").alias("i", "_row"))
    out = out.select("mission_id", "ref", "n", F.col("mean")[F.col("i")].alias("mean"), "i", F.posexplode("_row").alias("j", "cross_sum"))
    return rounded(out, "mean", "cross_sum")


def _found(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    reference, science, models = _sets(spark, sf_dir)
    sums = [R.coefficient_sums(R.projected(r, models)) for r in (reference, science)]
    return science, models, R.matrices(*sums)


@query(f"""WITH {_MATRIX}, e AS (SELECT q.mission, q.i, sqrt(sum(q.q * q.q)) AS strength, any_value(d.mr) - sum(q.q * e.ms) AS left_ FROM q JOIN d ON d.mission = q.mission AND d.i = q.i JOIN d e ON e.mission = q.mission AND e.i = q.j GROUP BY q.mission, q.i),
r AS (SELECT mission, sqrt(sum(left_ * left_)) AS residual FROM e GROUP BY mission)
SELECT CAST(q.mission AS VARCHAR) AS mission_id, CAST(q.i AS INTEGER) AS i, CAST(q.j AS INTEGER) AS j, {R6.format('q.q')} AS value, {R6.format('strength')} AS strength, {R6.format('residual')} AS residual_rms FROM q JOIN e USING (mission, i) JOIN r USING (mission)""")
def rotation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix of each mission by its entries, their rows' lengths, and the distance that it leaves between the means."""
    found = _found(spark, sf_dir)[2].select("mission_id", "strength", "residual_rms", F.posexplode("matrix").alias("i", "_row"))
    out = found.select("mission_id", "residual_rms", "i", F.col("strength")[F.col("i")].alias("strength"), F.posexplode("_row").alias("j", "value"))
    return rounded(out, "value", "strength", "residual_rms")


@query(f"WITH {_MATRIX} SELECT row_id, CAST(p.i AS INTEGER) AS i, {R6.format('0.001 * p.i + sum(z * p)')} AS x FROM z JOIN p USING (component) GROUP BY row_id, p.i")
def rotation_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Science spectra rebuilt from their corrected coefficients."""
    reference, science, models = _sets(spark, sf_dir)
    return long_form(R.rotate(reference, science, models)).withColumn("x", r6("x"))


@query(f"""WITH {_MATRIX} SELECT CAST(k.mission AS VARCHAR) AS mission_id, CAST(component AS INTEGER) AS component, {R6.format('avg(abs(k))')} AS before, {R6.format('avg(abs(z))')} AS after,
{R6.format('avg(abs(k)) - avg(abs(z))')} AS change FROM k JOIN z USING (row_id, component) GROUP BY k.mission, component""")
def rotation_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much the correction changes the coefficients' sizes."""
    science, models, found = _found(spark, sf_dir)
    return rounded(R.correction_strength(R.corrected(R.projected(science, models), found)).drop("telescop"), "before", "after", "change")


@query(f"""
WITH {_MODEL}, w AS (SELECT component, stddev_pop(p) OVER (PARTITION BY component ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS w, i, p FROM p),
a AS (SELECT component, stddev_pop(p) / avg(w) FILTER (WHERE i <= {CHANNELS} - 8) AS score FROM w GROUP BY component), m AS (SELECT DISTINCT CAST(label % 3 AS VARCHAR) AS mission_id FROM embeddings)
SELECT mission_id, CAST(component AS INTEGER) AS component, {R6.format('score')} AS score FROM a, m""")
def component_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviation of each component over that in windows of eight channels."""
    return rounded(P.structure_scores(_models(spark, sf_dir), 8).drop("telescop"), "score")


@query()
def sparse_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sparse components of each mission and pixel."""
    return P.sparse_components(_keyed(spark, sf_dir), 3, 0.5)


@query()
def independent_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two independent components of each mission's rows, after at most 25 rounds."""
    return P.independent_components(_keyed(spark, sf_dir).withColumn("telescop", F.lit("PX")), 2, tol=1e-4, rounds=25)


@query()
def wide_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three principal components of each mission's rows by subspace iteration."""
    return P.wide_components(_keyed(spark, sf_dir).withColumn("telescop", F.lit("PX")), 3, extra=40, tol=1e-6)
