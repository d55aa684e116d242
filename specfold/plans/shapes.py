"""Queries of axes, selections, statistics by receiver, masks, clipped baselines, lines, frames and collapses, all with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specfold.functions import arrays as A
from specfold.functions import kernels as K
from specfold.operators import axes, filters, provenance, quality
from specfold.operators import cube as C
from specfold.operators import grid as G
from specfold.operators import learned as L
from specfold.operators import lines as N
from specfold.operators import spectra as S
from specfold.operators.kernel_ops import map_arrays
from specfold.plans import pipeline
from specfold.plans.maps import CELLS, CUBE, FRAME, KERNEL, WINDOW, cube_of, samples
from specfold.plans.registry import query, table
from specfold.plans.relational import _LINK, OBS, _tau_links, observations
from specfold.plans.spectral import _FREE, CHANNELS, HOLED, LINE, LONG, R6, long_form, r6, spectra

OFF = f"(i < {LINE[0]} OR i >= {LINE[1]})"


def rid():
    return F.col("row_id")


def pick(values: tuple, place):
    return F.element_at(F.array(*map(F.lit, values)), (place + 1).cast("int"))


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in names})


# ---- axes


@query("SELECT vec_id AS row_id, CAST(CASE WHEN vec_id % 3 = 2 THEN 10 + vec_id % 5 WHEN label % 2 = 0 THEN label + 0.5 ELSE 1 END AS DOUBLE) AS crpix1 FROM embeddings")
def row_reference_pixel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a finite pixel take their file's; files without one take 1."""
    rows = spectra(spark, sf_dir).withColumn("file", F.col("telescop"))
    own = F.when(rid() % 3 == 1, F.lit(float("nan"))).when(rid() % 3 == 2, (10 + rid() % 5).cast("double"))
    headers = rows.where("file % 2 = 0").select("file", (F.col("file") + 0.5).cast("double").alias("crpix1")).distinct()
    return axes.with_reference_pixel(rows.withColumn("crpix1", own), headers).select("row_id", "crpix1")


@query("SELECT (SELECT arg_min(400000.0::DOUBLE + vec_id, vec_id) FROM embeddings WHERE vec_id >= 5) AS velocity, (-38.0)::DOUBLE AS deltav, 1.0::DOUBLE AS crpix1, 1.9005e12::DOUBLE AS restfreq")
def spectral_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row with a value decides; where none has one, the header."""
    rows = spectra(spark, sf_dir).select("row_id", F.when(rid() >= 5, 400000.0 + rid()).alias("velocity"), F.lit(float("nan")).alias("deltav"))
    return axes.spectral_parameters(rows, headers={"deltav": -38.0, "restfreq": 1.9005e12})


_TURNED = "t AS (SELECT vec_id AS row_id, i, CASE WHEN vec_id % 2 = 0 THEN 400000 + i * 3000 ELSE 589000 - i * 3000 END AS v FROM embeddings, range(64) t(i))"


def _turned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second axis descends."""
    even = rid() % 2 == 0
    return spectra(spark, sf_dir).withColumns({"velocity": F.when(even, 400000.0).otherwise(589000.0), "deltav": F.when(even, 3000.0).otherwise(-3000.0)})


@query(f"WITH {_TURNED}, a AS (SELECT row_id, arg_min(i, abs(v - 450000)) AS a, arg_min(i, abs(v - 520000)) AS b FROM t GROUP BY row_id) SELECT row_id, CAST(least(a, b) AS INTEGER) AS ch_first, CAST(greatest(a, b) AS INTEGER) AS ch_last FROM a")
def window_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window in km/s on axes in m/s."""
    return axes.window_channels(_turned(spark, sf_dir), 450.0, 520.0).select("row_id", "ch_first", "ch_last")


@query(f"WITH {_TURNED} SELECT row_id, CAST(i AS INTEGER) AS i, v BETWEEN 450000 AND 520000 AS line, i BETWEEN 3 AND 7 AS artefact FROM t")
def line_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A science line by velocity, an artefact by channels."""
    rows = _turned(spark, sf_dir).select("row_id", axes.window_mask("spectrum", 520.0, 450.0).alias("a"), axes.window_mask("spectrum", channels=(3, 7)).alias("b"))
    both = F.arrays_zip(F.col("a"), F.col("b"))
    return rows.select("row_id", F.posexplode(both).alias("i", "m")).select("row_id", "i", F.col("m.a").alias("line"), F.col("m.b").alias("artefact"))


@query("""
WITH t AS (SELECT label % 3 AS mission, 400000 + CASE label % 3 WHEN 0 THEN 0 WHEN 1 THEN vec_id % 2 * 1000 ELSE vec_id % 2 * 200 END AS v, 3000 + CASE WHEN label % 3 = 2 THEN vec_id % 3 * 2 ELSE 0 END AS d FROM embeddings),
g AS (SELECT mission, (max(v) - min(v)) / abs(max(d)) AS shift, (max(d) - min(d)) / abs(max(d)) AS stretch FROM t GROUP BY mission)
SELECT mission, round(shift, 6) + 0.0 AS shift, round(stretch, 6) + 0.0 AS stretch, shift <= 0.1 AND abs(stretch) <= 0.001 AS uniform FROM g""")
def grid_uniformity(spark: SparkSession, sf_dir: str) -> DataFrame:
    move = F.when(F.col("mission") == 0, 0).when(F.col("mission") == 1, rid() % 2 * 1000).otherwise(rid() % 2 * 200)
    rows = spectra(spark, sf_dir).withColumns({"velocity": 400000.0 + move, "deltav": 3000.0 + F.when(F.col("mission") == 2, rid() % 3 * 2).otherwise(0)})
    return rounded(axes.uniformity(rows, ["mission"]), "shift", "stretch")


@query("SELECT l_orderkey, l_linenumber, round(l_quantity / 10, 6) + 0.0 AS velo, round(l_quantity * 1e6 / 1.9005e12 * 299792458 / 1000, 6) + 0.0 AS freq FROM lineitem")
def velocity_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel widths in km/s of velocity axes and of frequency axes."""
    rows = table(spark, sf_dir, "lineitem").withColumns({"deltav": F.col("l_quantity") * -100.0, "cdelt1": F.col("l_quantity") * -1e6, "restfreq": F.lit(1.9005e12)})
    return rows.select("l_orderkey", "l_linenumber", r6(S.velocity_resolution(rows)).alias("velo"), r6(S.velocity_resolution(rows, "FREQ-LSR")).alias("freq"))


# ---- selections


@query(f"WITH {OBS} SELECT row_id, object FROM o WHERE contains('04_0116_' || scan, '6_1') OR contains('04_0116_' || scan, '20')")
def filter_aor_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations(spark, sf_dir).withColumn("aor_id", F.concat(F.lit("04_0116_"), F.col("scan")))
    return filters.split(rows, filters.FilterSpec(keep_aors=("6_1", "20")))[0].select("row_id", "object")


@query(f"""
WITH {LONG}, f AS (SELECT row_id, i, x, CASE WHEN i < {LINE[0]} THEN 0 ELSE 1 END AS run FROM c WHERE {OFF}),
m AS (SELECT row_id, run, avg(x) AS m FROM f GROUP BY ALL), t AS (SELECT row_id, sqrt(sum((x - m) * (x - m)) / count(*)) AS total FROM f JOIN m USING (row_id, run) GROUP BY row_id),
d AS (SELECT row_id, x - lag(x) OVER (PARTITION BY row_id, run ORDER BY i) AS d FROM f), w AS (SELECT row_id, stddev_pop(d) / sqrt(2) AS white FROM d WHERE d IS NOT NULL GROUP BY row_id)
SELECT row_id FROM t JOIN w USING (row_id) WHERE total / white <= 1.05""")
def filter_ripple(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = map_arrays(spectra(spark, sf_dir), "spectrum", lambda y: K.ripple_ratio(y, _FREE), {"ripple": "double"}).withColumn("object", F.lit("M51"))
    return filters.split(rows, filters.FilterSpec(cuts=(("ripple", "<=", 1.05),), science="m51"))[0].select("row_id")


@query(f"WITH {OBS} SELECT row_id, object FROM o WHERE object IN ('TSYS', 'TAU_SIG') OR value <= 150")
def prepare_value_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has the ratio under its other name."""
    rows = observations(spark, sf_dir).withColumnRenamed("value", "rmsratiob")
    return filters.prepare_cuts(rows, (("rmsratio", "<=", 150.0), ("tsys", "<=", 1.0))).select("row_id", "object")


@query(f"WITH {HOLED} SELECT row_id FROM c GROUP BY row_id HAVING count(*) FILTER (WHERE isnan(x)) / count(*) < 0.15")
def unblank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.reduce_spectra(spectra(spark, sf_dir, True), S.Reduction(unblank=0.15), object_column=None).select("row_id")


@query(f"WITH {OBS} SELECT row_id FROM o WHERE NOT (starts_with(object, 'TSYS') OR starts_with(object, 'TAU_SIG')) AND scan % 2 = 0 AND contains(upper(object), 'VIE')")
def science_selector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On-source rows of a named object."""
    rows = observations(spark, sf_dir).withColumn("sobsmode", F.when(F.col("scan") % 2 == 0, "ON").otherwise("OFF"))
    return rows.where(filters.science_rows(mode_column="sobsmode", contains="vie")).select("row_id")


@query(f"WITH {OBS} SELECT row_id, object FROM o WHERE (object IN ('click', 'TSYS', 'TAU_SIG') OR contains(upper(object), 'PURCH')) AND contains(mission_id, '1') AND scan IN (2, 3, 5, 8, 13) AND contains('A' || subscan, '1')")
def prepare_selector(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations(spark, sf_dir).withColumn("aor_id", F.concat(F.lit("A"), F.col("subscan")))
    return rows.where(filters.prepare_selector("click", "purch", flights=("1",), scans=(2, 3, 5, 8, 13), aors=("1",))).select("row_id", "object")


@query(f"""
WITH {LONG}, a AS (SELECT row_id, any_value(telescop) AS telescop, max(abs(CASE WHEN row_id % 11 = 0 THEN x * 1e-12 ELSE x END)) AS a FROM c WHERE mission IN (0, 2) AND telescop % 5 IN (0, 1, 3) AND row_id % 4 IN (1, 2) GROUP BY row_id)
SELECT row_id FROM a WHERE a > 1e-10 * (SELECT max(a) FROM a)""")
def correction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two missions, three telescopes and two subscans that are not all but zero."""
    faint = F.transform("spectrum", lambda x: F.when(rid() % 11 == 0, x * 1e-12).otherwise(x))
    rows = spectra(spark, sf_dir).withColumns({"spectrum": faint, "mission_id": F.concat(F.lit("F"), F.col("mission")), "telescop": F.concat(F.lit("PX"), F.col("telescop") % 5), "subscan": (rid() % 4).cast("int"), "scan": F.lit(1), "object": F.lit("M51CENTER")})
    spec = filters.CorrectionRows(part="m51", missions=("F0", "F2"), telescopes=("PX0", "PX1", "PX3"), subscans=(1, 2))
    return filters.correction_rows(rows, spec).select("row_id")


@query(f"WITH {OBS} SELECT row_id, scan, subscan FROM o WHERE scan IN (3, 4, 9) AND ((scan = 3 AND subscan = 7) OR (scan = 4 AND subscan = 11) OR (scan = 5 AND subscan = 1))")
def cycle_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    cycles = [filters.parse_cycle(t) for t in ("3:7", "4:11", "5:1")]
    return observations(spark, sf_dir).where(filters.in_cycles(scans=(3, 4, 9), cycles=cycles)).select("row_id", "scan", "subscan")


@query(f"WITH {HOLED} SELECT row_id, count(*) FILTER (WHERE NOT isnan(x)) >= 52 AS valid FROM c GROUP BY row_id")
def valid_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectra(spark, sf_dir, True).select("row_id", filters.valid("spectrum", 52).alias("valid"))


@query(f"""
WITH {OBS}, b AS ({_LINK.format(name="tau_id", kind="TAU_SIG")})
SELECT o.row_id, t.row_id AS tau_id FROM o LEFT JOIN b USING (row_id) LEFT JOIN o t ON t.row_id = b.tau_id AND t.mission_id = o.mission_id AND t.subscan = o.subscan""")
def split_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that stay inside their chunk when a table is split by mission and subscan."""
    rows = _tau_links(spark, sf_dir).select("row_id", "mission_id", "subscan", "tau_id")
    return provenance.chunked_links(rows, ["mission_id", "subscan"], ["tau_id"]).select("row_id", "tau_id")


# ---- statistics

_NAMES = "n AS (SELECT *, CASE WHEN row_id % 9 = 0 THEN 'OTHER' ELSE ['LFA', 'HFA'][1 + row_id % 2] || ['H', 'V'][1 + row_id // 2 % 2] || '_PX0' || telescop % 3 || '_S' END AS name FROM c)"


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(pick(("LFA", "HFA"), rid() % 2), pick(("H", "V"), F.floor(rid() / 2) % 2), F.lit("_PX0"), F.col("telescop") % 3, F.lit("_S"))
    return spectra(spark, sf_dir, True).withColumn("telescop", F.when(rid() % 9 == 0, "OTHER").otherwise(name))


@query(f"""
WITH {HOLED}, {_NAMES} SELECT regexp_extract(name, '^([A-Z]{{3}})([HV])_PX', 1) AS receiver, regexp_extract(name, '^([A-Z]{{3}})([HV])_PX', 2) AS polarization, CAST(i AS INTEGER) AS pos,
  {R6.format('avg(x)')} AS mean, {R6.format('stddev_pop(x)')} AS std, count(*) AS n FROM n WHERE name <> 'OTHER' AND NOT isnan(x) GROUP BY ALL""")
def receiver_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.receiver_averages(_named(spark, sf_dir), ["receiver", "polarization"]), "mean", "std")


@query(f"WITH {HOLED}, {_NAMES} SELECT CAST(regexp_extract(name, '_PX(\\d+)', 1) AS INTEGER) AS pixel, CAST(i AS INTEGER) AS pos, {R6.format('sum(x * (1 + row_id % 3)) / sum(1 + row_id % 3)')} AS mean FROM n WHERE name <> 'OTHER' AND NOT isnan(x) GROUP BY ALL")
def pixel_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted, by pixel alone."""
    return rounded(S.receiver_averages(_named(spark, sf_dir), ["pixel"], weight=(1 + rid() % 3).cast("double")).select("pixel", "pos", "mean"), "mean")


@query(f"WITH {OBS} SELECT mission_id, scan, telescop, row_id, row_number() OVER (PARTITION BY mission_id, scan, telescop ORDER BY row_id) AS place FROM o")
def waterfall_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.waterfall(observations(spark, sf_dir)).select("mission_id", "scan", "telescop", "row_id", "place")


@query(f"WITH {LONG}, a AS (SELECT telescop, i, avg(x) AS m, stddev_pop(x) AS s FROM c GROUP BY ALL), k AS (SELECT label AS telescop, count(*) AS n FROM embeddings GROUP BY label) SELECT telescop, n, {R6.format('avg(s)')} AS rms, {R6.format('max(m)')} AS top FROM a JOIN k USING (telescop) GROUP BY ALL")
def average_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a group: rows, noise, and the top of its average spectrum."""
    return S.average_spectra(spectra(spark, sf_dir), ["telescop"]).select("telescop", "n", r6("rms").alias("rms"), r6(F.array_max("spectrum")).alias("top"))


_METRICS = "count(*) AS n, {0} AS mean, {1} AS median, {2} AS std, {3} AS least, {4} AS most, {5} AS p5, {6} AS p95".format(*[R6.format(x) for x in ("avg(v)", "median(v)", "stddev_pop(v)", "min(v)", "max(v)", "quantile_cont(v, 0.05)", "quantile_cont(v, 0.95)")])


@query(f"WITH {HOLED}, m AS (SELECT 'first' AS metric, x AS v FROM c WHERE i = 1 UNION ALL SELECT 'roll', avg(x) FROM c WHERE NOT isnan(x) GROUP BY row_id) SELECT metric, {_METRICS} FROM m WHERE NOT isnan(v) GROUP BY metric")
def metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scalar metric and an array metric, of which each row's mean counts; one that is not there is left out."""
    rows = spectra(spark, sf_dir, True).select(F.element_at("spectrum", 2).alias("first"), F.col("spectrum").alias("roll"))
    return rounded(quality.metric_table(rows, ["first", "rms"], ["roll"]), "mean", "median", "std", "least", "most", "p5", "p95")


@query(f"""
WITH {HOLED}, z AS (SELECT CASE WHEN row_id % 10 = 0 AND i % 9 = 0 THEN 0 WHEN row_id % 10 = 1 THEN x * 1e-10 ELSE x END AS x FROM c)
SELECT count(*) AS n, count(*) FILTER (WHERE isnan(x)) AS n_missing, count(*) FILTER (WHERE x = 0) AS n_zero, count(*) FILTER (WHERE x < 0) AS n_negative, count(*) FILTER (WHERE x <> 0 AND abs(x) < 1e-10) AS n_tiny,
  {R6.format('avg(x) FILTER (WHERE NOT isnan(x))')} AS mean, {R6.format('stddev_pop(x) FILTER (WHERE NOT isnan(x))')} AS std, {R6.format('min(x) FILTER (WHERE NOT isnan(x))')} AS least, {R6.format('max(x) FILTER (WHERE NOT isnan(x))')} AS most FROM z""")
def value_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.transform("spectrum", lambda v, i: F.when((rid() % 10 == 0) & (i % 9 == 0), 0.0).when(rid() % 10 == 1, v * 1e-10).otherwise(v))
    return rounded(quality.value_census(spectra(spark, sf_dir, True).withColumn("spectrum", odd)), "mean", "std", "least", "most")


@query(f"""
WITH {LONG}, f AS (SELECT row_id, x, row_number() OVER (PARTITION BY row_id ORDER BY i) - 1 AS j FROM c WHERE {OFF}), s AS (SELECT row_id, stddev_pop(x) AS s FROM f GROUP BY row_id),
b AS (SELECT k, row_id, j // k AS b, avg(x) AS m FROM f, (VALUES (2), (4), (7)) t(k) GROUP BY ALL),
w AS (SELECT k, row_id, sqrt(k) * stddev_pop(m) / any_value(s) AS w FROM b JOIN s USING (row_id) GROUP BY k, row_id),
q AS (SELECT k, median(w) AS med, count(*) AS n FROM w GROUP BY k), d AS (SELECT k, median(abs(w - med)) AS mad FROM w JOIN q USING (k) GROUP BY k)
SELECT CAST(k AS INTEGER) AS k, z, q.n, {R6.format('med + z * 1.4826 * mad')} AS threshold, count(*) FILTER (WHERE w > med + z * 1.4826 * mad) AS n_flagged FROM w JOIN q USING (k) JOIN d USING (k), (VALUES (1.0::DOUBLE), (2.0), (3.0)) t(z) GROUP BY k, z, q.n, med, mad""")
def whiteness_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.whiteness_sweep(spectra(spark, sf_dir), (2, 4, 7), (1.0, 2.0, 3.0), _FREE), "threshold")


@query(f"WITH {HOLED} SELECT row_id, " + ", ".join(f"{R6.format(e)} AS {n}" for e, n in (("avg(x)", "mean"), ("stddev_pop(x)", "std"), ("min(x)", "least"), ("max(x)", "most"), ("sqrt(avg(x * x))", "rms"))) + " FROM c WHERE NOT isnan(x) GROUP BY row_id")
def spectrum_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(spectra(spark, sf_dir, True).select("row_id", *S.spectrum_statistics("spectrum")), "mean", "std", "least", "most", "rms")


# ---- components: three cosines for each mission

_RATIO = (0.5, 0.3, 0.1)
_MODEL = f"p AS (SELECT k - 1 AS component, i, sqrt(2.0 / {CHANNELS}) * cos(pi() * k * (i + 0.5) / {CHANNELS}) AS p FROM range(1, 4) t(k), range({CHANNELS}) u(i))"


def _models(spark: SparkSession, sf_dir: str) -> DataFrame:
    wave = lambda k: F.transform(F.sequence(F.lit(0), F.lit(CHANNELS - 1)), lambda i: (2.0 / CHANNELS) ** 0.5 * F.cos(F.pi() * k * (i + 0.5) / CHANNELS))
    missions = spectra(spark, sf_dir).select(F.col("mission").cast("string").alias("mission_id")).distinct()
    return missions.select("mission_id", F.lit("PX").alias("telescop"), F.array(*[wave(k) for k in (1, 2, 3)]).alias("components"), F.array(*map(F.lit, _RATIO)).alias("ratio"), F.lit(0).alias("ch_first"), F.lit(CHANNELS - 1).alias("ch_last"))


@query(f"WITH {_MODEL}, a AS (SELECT component, max(abs(p)) AS a, sqrt(avg(p * p)) AS r FROM p GROUP BY component), m AS (SELECT DISTINCT CAST(label % 3 AS VARCHAR) AS mission_id FROM embeddings) SELECT mission_id, CAST(component AS INTEGER) AS component, {R6.format('a')} AS amplitude, {R6.format('r')} AS rms, {R6.format('[0.5, 0.8, 0.9][component + 1]')} AS cumulative FROM a, m")
def component_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(N.component_statistics(_models(spark, sf_dir)).drop("telescop"), "amplitude", "rms", "cumulative")


def _coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spectra(spark, sf_dir).withColumns({"mission_id": F.col("mission").cast("string"), "telescop": F.lit("PX")})
    return L.row_coefficients(rows, _models(spark, sf_dir), K.Gates(smooth=5))


@query(f"WITH {LONG}, {_MODEL} SELECT row_id, CAST(component AS INTEGER) AS component, {R6.format('sum(x * p)')} AS coefficient FROM c JOIN p USING (i) GROUP BY row_id, component")
def component_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain projections, as all channels are there."""
    return _coefficients(spark, sf_dir).select("row_id", "component", r6("coefficient").alias("coefficient"))


@query(f"""
WITH {LONG}, {_MODEL}, s AS (SELECT a.row_id, a.i, sum(b.x) / 5 AS x FROM c a JOIN c b ON a.row_id = b.row_id AND b.i BETWEEN a.i - 2 AND a.i + 2 GROUP BY a.row_id, a.i),
n AS (SELECT row_id, stddev_pop(x) AS n FROM s GROUP BY row_id), q AS (SELECT component, stddev_pop(p) AS q FROM p GROUP BY component),
k AS (SELECT row_id, component, sum(x * p) AS k FROM c JOIN p USING (i) GROUP BY row_id, component)
SELECT row_id, CAST(component AS INTEGER) AS component, round(abs(k) * q / n, 6) + 0.0 AS share FROM k JOIN n USING (row_id) JOIN q USING (component)""")
def noise_ratio_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inverse of each noise ratio, which stays small where a coefficient is near 0."""
    return _coefficients(spark, sf_dir).select("row_id", "component", r6(1 / F.col("ratio")).alias("share"))


@query(f"WITH {HOLED} SELECT CAST(telescop % 3 AS VARCHAR) AS mission_id, CAST(telescop AS VARCHAR) AS telescop, count(DISTINCT row_id) AS n_rows, CAST(min(i) FILTER (WHERE NOT isnan(x)) AS INTEGER) AS ch_first, CAST(max(i) FILTER (WHERE NOT isnan(x)) AS INTEGER) AS ch_last, {R6.format('avg(x) FILTER (WHERE row_id % 7 <> 0 AND i = 3)')} AS mean3 FROM c GROUP BY ALL HAVING count(DISTINCT row_id) FILTER (WHERE row_id % 7 <> 0) > 1")
def reference_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of reference rows, their band, and the mean that fills one channel's gaps; rows with a fifth of channels missing do not count in it."""
    rows = spectra(spark, sf_dir, True).withColumn("mission_id", F.col("mission").cast("string"))
    rows = rows.withColumn("telescop", F.col("telescop").cast("string"))
    return L.reference_groups(rows).select("mission_id", "telescop", "n_rows", "ch_first", "ch_last", r6(F.element_at("means", 4)).alias("mean3"))


# ---- masks and values


@query(f"WITH {LONG} SELECT row_id, CAST(i AS INTEGER) AS i, {R6.format('x')} AS x FROM c WHERE NOT (abs(i - 20 - row_id % 3) <= 3 OR i BETWEEN 40 AND 45)")
def mask_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two masks joined, and the channels that neither blanks."""
    n = F.size("spectrum")
    mask = A.any_mask(A.channel_mask(n, 20 + rid() % 3, 6), axes.window_mask("spectrum", channels=(40, 45)))
    out = long_form(spectra(spark, sf_dir).withColumn("spectrum", A.apply_mask("spectrum", mask)))
    return out.where(~F.isnan("x")).withColumn("x", r6("x"))


@query(f"WITH {HOLED}, m AS (SELECT row_id, avg(x) AS m, stddev_pop(x) AS s FROM c WHERE NOT isnan(x) GROUP BY row_id) SELECT row_id, CAST(i AS INTEGER) AS i, {R6.format('(x - m) / s')} AS x, {R6.format('x')} AS back FROM c JOIN m USING (row_id) WHERE NOT isnan(x)")
def normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spectra(spark, sf_dir, True).withColumn("p", axes.normalized("spectrum"))
    both = rows.select("row_id", F.posexplode(F.arrays_zip(F.col("p.values").alias("x"), axes.denormalized(F.col("p")).alias("back"))).alias("i", "v"))
    return both.where(~F.isnan("v.x")).select("row_id", "i", r6("v.x").alias("x"), r6("v.back").alias("back"))


@query(f"WITH {LONG} SELECT row_id, CAST(i AS INTEGER) AS i, {R6.format('max(x) OVER (PARTITION BY row_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)')} AS top FROM c QUALIFY i <= 59")
def rolling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest channel of each window of five."""
    return spectra(spark, sf_dir).select("row_id", F.posexplode(axes.rolling("spectrum", 5)).alias("i", "w")).select("row_id", "i", r6(F.array_max("w")).alias("top"))


# ---- clipped baselines


def clipped_fits(order: int, source: str = "c", rounds: int = 3, name: str = "b", off: str = OFF) -> str:
    """SQL of the fit of order 0 or 1 after so many rounds of clipping at three deviations: tables name0 ... and name (row_id, a, b)."""
    slope, start = ("regr_slope(x, i)", "regr_intercept(x, i)") if order else ("0.0", "avg(x)")
    out = [f"{name}u0 AS (SELECT row_id, i, x FROM {source} WHERE NOT isnan(x) AND {off})"]
    for r in range(rounds):
        out.append(f"{name}l{r} AS (SELECT row_id, {slope} AS b, {start} AS a FROM {name}u{r} GROUP BY row_id)")
        out.append(f"{name}r{r} AS (SELECT row_id, i, x, x - (a + b * i) AS r FROM {name}u{r} JOIN {name}l{r} USING (row_id))")
        out.append(f"{name}u{r + 1} AS (SELECT row_id, i, x FROM {name}r{r} JOIN (SELECT row_id, stddev_pop(r) AS s FROM {name}r{r} GROUP BY row_id) USING (row_id) WHERE abs(r) <= 3 * s)")
    out.append(f"{name} AS (SELECT row_id, {slope} AS b, {start} AS a FROM {name}u{rounds} GROUP BY row_id)")
    return ", ".join(out)


#: Every fifth spectrum has two channels that clipping takes out.
_SPIKED = "c AS (SELECT vec_id AS row_id, label AS telescop, label % 3 AS mission, i, CASE WHEN vec_id % 7 = 0 AND i % 5 = 0 THEN 'NaN'::DOUBLE ELSE CAST(embedding[i + 1] AS DOUBLE) END + CASE WHEN vec_id % 5 = 0 AND i IN (11, 50) THEN 3 ELSE 0 END AS x FROM embeddings, range(64) t(i))"


def _spiked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectra(spark, sf_dir, True).withColumn("spectrum", F.transform("spectrum", lambda x, i: x + F.when((rid() % 5 == 0) & i.isin(11, 50), 3.0).otherwise(0.0)))


@query(f"WITH {_SPIKED}, {clipped_fits(1)} SELECT row_id, CAST(i AS INTEGER) AS i, {R6.format('x - (a + b * i)')} AS x FROM c JOIN b USING (row_id) WHERE NOT isnan(x)")
def baseline_clipped_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = long_form(S.baselined(_spiked(spark, sf_dir), 1, LINE))
    return out.where(~F.isnan("x")).withColumn("x", r6("x"))


@query(f"WITH {_SPIKED}, {clipped_fits(0, rounds=10)} SELECT row_id, CAST(i AS INTEGER) AS i, {R6.format('CASE WHEN row_id % 4 = 0 THEN x ELSE x - a END')} AS x FROM c JOIN b USING (row_id) WHERE NOT isnan(x)")
def baseline_skips_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order 0, ten rounds; calibration rows stay as they are."""
    rows = _spiked(spark, sf_dir).withColumn("object", F.when(rid() % 4 == 0, "TSYS").otherwise("M51"))
    out = long_form(S.baselined(rows, 0, LINE, rounds=10, object_column="object"))
    return out.where(~F.isnan("x")).withColumn("x", r6("x"))


def chosen_order(theory: float) -> str:
    """SQL of the baseline of order 0 or 1 that brings the noise near the theoretical one: table o (row_id, blorder) and y (row_id, i, x)."""
    return f"""{clipped_fits(0, name='p')}, {clipped_fits(1, name='q')},
e AS (SELECT row_id, telescop, mission, i, x, x - p.a AS x0, x - (q.a + q.b * i) AS x1 FROM c JOIN p USING (row_id) JOIN q USING (row_id)),
s AS (SELECT row_id, stddev_pop(x0) AS s0, stddev_pop(x1) AS s1 FROM e WHERE NOT isnan(x) AND {OFF} GROUP BY row_id),
o AS (SELECT row_id, CASE WHEN s0 <= 1.15 * {theory} THEN 0 WHEN s1 <= 1.15 * {theory} THEN 1 WHEN s1 < 0.98 * s0 THEN 1 ELSE 0 END AS blorder FROM s),
y AS (SELECT row_id, telescop, mission, i, CASE WHEN blorder = 0 THEN x0 ELSE x1 END AS x FROM e JOIN o USING (row_id))"""


@query(f"WITH {_SPIKED}, {chosen_order(0.1)} SELECT mission, CAST(blorder AS BIGINT) AS blorder, count(DISTINCT row_id) AS n, {R6.format('stddev_pop(x)')} AS rms FROM y JOIN o USING (row_id) WHERE NOT isnan(x) GROUP BY mission, blorder")
def baseline_order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of each mission got which order, and the deviation of their channels."""
    rows = _spiked(spark, sf_dir).withColumn("rms_theoretical", F.lit(0.1))
    out = S.auto_baselined(rows, "rms_theoretical", LINE, most=1)
    rows_of = out.groupBy("mission", "blorder").agg(F.count(F.lit(1)).alias("n"))
    values = S.average(out.select("mission", "blorder", F.transform(A.finite("spectrum"), lambda x: F.array(x)).alias("s")).select("mission", "blorder", F.explode("s").alias("spectrum")), ["mission", "blorder"])
    return rows_of.join(values, ["mission", "blorder"]).select("mission", "blorder", rows_of["n"], r6("std").alias("rms"))


@query(f"""
WITH {HOLED}, g AS (SELECT row_id FROM c GROUP BY row_id HAVING count(*) FILTER (WHERE isnan(x)) / count(*) < 0.25),
t AS (SELECT row_id, i - 4 AS i, x FROM c JOIN g USING (row_id) WHERE 400000 + i * 3000 BETWEEN 412000 AND 580000),
{clipped_fits(1, 't', off='(i < 24 OR i >= 32)')},
y AS (SELECT row_id, i, x - (a + b * i) AS x FROM t JOIN b USING (row_id)), s AS (SELECT row_id, stddev_pop(x) AS r FROM y WHERE NOT isnan(x) AND (i < 24 OR i > 32) GROUP BY row_id),
m AS (SELECT p.row_id, p.i, sum(q.x) / 3 AS x FROM y p JOIN y q ON p.row_id = q.row_id AND q.i BETWEEN p.i - 1 AND p.i + 1 GROUP BY ALL)
SELECT row_id, CAST(i // 3 AS INTEGER) AS i, {R6.format('x')} AS x, {R6.format('r')} AS rms_baseline, 9000.0::DOUBLE AS deltav FROM m JOIN s USING (row_id) WHERE i % 3 = 0 AND NOT isnan(x)""")
def reduce_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unblank, extract, clipped baseline, line-free noise, smooth and decimate in one go."""
    steps = S.Reduction(unblank=0.25, extract=(412000.0, 580000.0), baseline=1, line_window=(484000.0, 508000.0), smooth=3, decimate=True)
    out = long_form(S.reduce_spectra(spectra(spark, sf_dir, True), steps, object_column=None), "rms_baseline", "deltav")
    return rounded(out.where(~F.isnan("x")), "x", "rms_baseline")


@query(f"""
WITH {LONG}, {chosen_order(0.1)}, f AS (SELECT row_id, i, x, CASE WHEN i < {LINE[0]} THEN 0 ELSE 1 END AS run, row_number() OVER (PARTITION BY row_id ORDER BY i) - 1 AS j FROM y WHERE {OFF}),
m AS (SELECT row_id, run, avg(x) AS m FROM f GROUP BY ALL), t AS (SELECT row_id, sqrt(sum((x - m) * (x - m)) / count(*)) AS total FROM f JOIN m USING (row_id, run) GROUP BY row_id),
d AS (SELECT row_id, x - lag(x) OVER (PARTITION BY row_id, run ORDER BY i) AS d FROM f), w AS (SELECT row_id, stddev_pop(d) / sqrt(2) AS white FROM d WHERE d IS NOT NULL GROUP BY row_id),
r AS (SELECT row_id, stddev_pop(x) AS r FROM f GROUP BY row_id), b4 AS (SELECT row_id, j // 4 AS k, avg(x) AS m FROM f GROUP BY ALL),
h AS (SELECT row_id, 2 * stddev_pop(m) / any_value(r) AS whiteness FROM b4 JOIN r USING (row_id) GROUP BY row_id),
z AS (SELECT median(whiteness) AS med FROM h), v AS (SELECT median(abs(whiteness - med)) AS mad FROM h, z)
SELECT row_id, CAST(blorder AS BIGINT) AS blorder, {R6.format('total / white')} AS ripple, {R6.format('r / 0.1')} AS rmsratiob, {R6.format('whiteness')} AS whiteness, CAST(whiteness > med + 3 * 1.4826 * mad AS INTEGER) AS whiteflag
FROM o JOIN t USING (row_id) JOIN w USING (row_id) JOIN r USING (row_id) JOIN h USING (row_id), z, v""")
def post_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage after the correction, with baselines up to lines."""
    rows = spectra(spark, sf_dir).withColumn("rms_theoretical", F.lit(0.1))
    out = pipeline.post_process(rows, LINE, most_order=1).select("row_id", "blorder", "ripple", "rmsratiob", "whiteness", "whiteflag")
    return rounded(out, "ripple", "rmsratiob", "whiteness")


# ---- lines

_LINED = "c AS (SELECT vec_id AS row_id, label AS telescop, i, CAST(embedding[i + 1] AS DOUBLE) + 0.4 * exp(-pow(i - 30 - label % 4, 2) / 8.0) AS x FROM embeddings, range(64) t(i))"


def _lined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spectra with a line whose place depends on the telescope."""
    line = lambda i: 0.4 * F.exp(-F.pow(i - 30 - F.col("telescop") % 4, F.lit(2.0)) / 8.0)
    return spectra(spark, sf_dir).withColumn("spectrum", F.transform("spectrum", lambda x, i: x + line(i)))


_WIDTH = """l AS (SELECT telescop, channel, confidence, median(m) + (any_value(m) FILTER (WHERE i = channel) - median(m)) / 2 AS level FROM a JOIN t USING (telescop) GROUP BY ALL),
u AS (SELECT telescop, channel, confidence, coalesce(max(i) FILTER (WHERE i < channel AND m <= level) + 1, 0) AS lo, coalesce(min(i) FILTER (WHERE i > channel AND m <= level) - 1, 63) AS hi FROM a JOIN l USING (telescop) GROUP BY ALL)
SELECT telescop, CAST(channel AS BIGINT) AS channel, round(confidence, 6) + 0.0 AS confidence, CAST(hi - lo + 1 AS BIGINT) AS width FROM u"""


@query(f"""
WITH {_LINED}, a AS (SELECT telescop, i, avg(x) AS m FROM c GROUP BY ALL),
k AS (SELECT p.telescop, p.i, sum(q.m) / 5 AS s FROM a p, range(-2, 3) d(d), a q WHERE q.telescop = p.telescop AND q.i = greatest(0, least(63, p.i + d)) GROUP BY ALL),
t AS (SELECT telescop, arg_max(i, s) AS channel, greatest(0, least(1, (max(s) - median(s)) / stddev_pop(s) / 5)) AS confidence FROM k GROUP BY telescop),
{_WIDTH}""")
def line_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(N.line_channels(_lined(spark, sf_dir), ["telescop"]), "confidence")


@query(f"""
WITH {_LINED}, a AS (SELECT telescop, i, avg(x) AS m FROM c GROUP BY ALL),
r AS (SELECT row_id, any_value(telescop) AS telescop, arg_max(i, x) AS top FROM c GROUP BY row_id), n AS (SELECT telescop, top, count(*) AS n FROM r GROUP BY ALL),
t AS (SELECT telescop, first(top ORDER BY n DESC, top) AS channel, max(n) / sum(n) AS confidence FROM n GROUP BY telescop),
{_WIDTH}""")
def line_most_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(N.line_channels(_lined(spark, sf_dir), ["telescop"], "max"), "confidence")


@query(f"""
WITH {_LINED}, a AS (SELECT telescop, i, avg(x) AS m FROM c GROUP BY ALL), d AS (SELECT telescop, median(m) AS d FROM a GROUP BY telescop),
t AS (SELECT telescop, CAST(round_even(sum(greatest(0, m - d) * i) / sum(greatest(0, m - d)), 0) AS BIGINT) AS channel, 1.0 AS confidence FROM a JOIN d USING (telescop) GROUP BY telescop),
{_WIDTH.replace("SELECT telescop, CAST(channel", "SELECT telescop, channel BETWEEN 28 AND 36 AS valid, CAST(channel")}""")
def line_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the test of its place."""
    return rounded(N.accepted(N.line_channels(_lined(spark, sf_dir), ["telescop"], "centroid"), channels=(28, 36)), "confidence")


@query(f"WITH {_SPIKED}, m AS (SELECT row_id, avg(x) AS m, stddev_pop(x) AS s FROM c WHERE NOT isnan(x) GROUP BY row_id) SELECT row_id, CAST(i AS INTEGER) AS i FROM c JOIN m USING (row_id) WHERE NOT isnan(x) AND abs(x - m) <= 2.5 * s")
def spike_blanking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The channels that stay."""
    return long_form(N.despiked(_spiked(spark, sf_dir), 2.5)).where(~F.isnan("x")).select("row_id", "i")


@query(f"WITH {LONG} SELECT row_id, CAST(i AS INTEGER) AS i, {R6.format('CASE WHEN i BETWEEN 10 AND 19 THEN 0.5 ELSE x END')} AS x, CAST(54 AS INTEGER) AS n_cut FROM c")
def exclude_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range cut out and put back with a constant."""
    cut = N.without_range(spectra(spark, sf_dir), 10, 20).withColumn("n_cut", F.size("spectrum"))
    return long_form(N.with_range(cut, 10, 20, 0.5), "n_cut").withColumn("x", r6("x"))


@query(f"WITH {_LINED} SELECT row_id, avg(x) FILTER (WHERE i >= {LINE[0]} AND i < {LINE[1]}) > 2 * stddev_pop(x) FILTER (WHERE {OFF}) / sqrt({LINE[1] - LINE[0]}) AS has_line FROM c GROUP BY row_id")
def line_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.with_line_test(_lined(spark, sf_dir), LINE, 2.0).select("row_id", "has_line")


@query(f"""
WITH {_LINED}, t AS (SELECT row_id, any_value(telescop) AS telescop, greatest(1, least(62, arg_max(i, x))) AS t FROM c GROUP BY row_id),
n AS (SELECT t.row_id, t.telescop, t.t, a.x AS a, b.x AS b, d.x AS c FROM t JOIN c a ON a.row_id = t.row_id AND a.i = t.t - 1 JOIN c b ON b.row_id = t.row_id AND b.i = t.t JOIN c d ON d.row_id = t.row_id AND d.i = t.t + 1),
k AS (SELECT row_id, telescop, t + CASE WHEN a - 2 * b + c < 0 THEN 0.5 * (a - c) / (a - 2 * b + c) ELSE 0 END AS peak FROM n),
s AS (SELECT row_id, k.telescop, peak - m AS s FROM k JOIN (SELECT telescop, median(peak) AS m FROM k GROUP BY telescop) USING (telescop)),
v AS (SELECT s.row_id, s.telescop, i, i + s.s AS at, floor(i + s.s) AS f FROM s, range(64) u(i) WHERE i + s.s BETWEEN 0 AND 63)
SELECT v.telescop, CAST(v.i AS INTEGER) AS pos, {R6.format('avg(a.x + (v.at - v.f) * (coalesce(b.x, a.x) - a.x))')} AS mean, count(*) AS n FROM v JOIN c a ON a.row_id = v.row_id AND a.i = v.f LEFT JOIN c b ON b.row_id = v.row_id AND b.i = v.f + 1 GROUP BY v.telescop, v.i""")
def aligned_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean spectra of each telescope after the peaks are moved together."""
    return rounded(N.aligned_mean(_lined(spark, sf_dir), ["telescop"]), "mean")


@query()
def envelope_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.enveloped(spectra(spark, sf_dir)).select("row_id", "spectrum")


# ---- maps


@query("SELECT l_orderkey, l_linenumber, round(exp(-pow(greatest(l_quantity / 20 - 1, 0), 2) / 0.5), 6) + 0.0 AS by_ratio, round(100 / (l_quantity * l_quantity), 6) + 0.0 AS by_rms FROM lineitem")
def noise_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumns({"ratio": F.col("l_quantity") / 20.0, "rms": F.col("l_quantity") / 10.0})
    return rows.select("l_orderkey", "l_linenumber", r6(G.noise_weight(ratio="ratio")).alias("by_ratio"), r6(G.noise_weight(rms="rms")).alias("by_rms"))


@query("""
WITH s AS (SELECT 202.5 + (vec_id % 20) * 0.002 AS ra, 47.2 + (vec_id // 20 % 28) * 0.002 AS dec FROM embeddings), m AS (SELECT min(ra) AS a, max(ra) AS b, min(dec) AS c, max(dec) AS d FROM s), w AS (SELECT *, (b - a) * cos(radians((c + d) / 2)) AS wide, d - c AS high FROM m)
SELECT 'cube' AS kind, round((a + b) / 2, 6) + 0.0 AS ra, round((c + d) / 2, 6) + 0.0 AS dec, CAST(greatest(1, ceil(wide * 1.2 / 0.0017)) AS BIGINT) AS nx, CAST(greatest(1, ceil(high * 1.2 / 0.0017)) AS BIGINT) AS ny FROM w UNION ALL
SELECT 'map', round((a + b) / 2, 6) + 0.0, round((c + d) / 2, 6) + 0.0, CAST(floor(wide / 0.0017) AS BIGINT) + 1, CAST(floor(high / 0.0017) AS BIGINT) + 1 FROM w""")
def map_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of cubes, with a margin, and of maps, without."""
    rows = samples(spark, sf_dir)
    found = [(kind, round(f.ra, 6), round(f.dec, 6), f.nx, f.ny) for kind, f in (("cube", G.frame_of(rows, 0.0017)), ("map", G.map_frame_of(rows, 0.0017)))]
    return spark.createDataFrame(found, "kind string, ra double, dec double, nx long, ny long")


@query(f"""
WITH {CELLS}, i AS (SELECT vec_id AS row_id, list_sum(list_transform(embedding[29:37], lambda e: CAST(e AS DOUBLE))) AS t FROM embeddings)
SELECT stage, y, x, {R6.format('sum(k * t * f) / sum(k) * 3')} AS integral FROM k JOIN i USING (row_id), (VALUES ('raw', 1), ('doubled', 2)) s(stage, f) GROUP BY stage, y, x""")
def compare_integrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir)
    stages = {"raw": rows, "doubled": rows.withColumn("spectrum", F.transform("spectrum", lambda v: v * 2))}
    return G.compare_integrated(stages, FRAME, KERNEL, 28, 36, 3.0).select("stage", "y", "x", r6("integral").alias("integral"))


@query(f"""WITH {CUBE}, m AS (SELECT y, x, max(v) AS v, stddev_pop(v) FILTER (WHERE i NOT BETWEEN 28 AND 36) AS n FROM q GROUP BY y, x)
SELECT y, x, {R6.format('CASE WHEN n > 0.06 OR v < 0.1 THEN 0 ELSE least(v, 0.2) END')} AS value FROM m""")
def map_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noisy pixels and low values are 0, high ones are cut."""
    cube = cube_of(spark, sf_dir)
    kept = C.noise_dropped(C.peak(cube), C.noise_map(cube, WINDOW), 0.06)
    return C.clipped(kept, 0.1, 0.2).select("y", "x", r6("value").alias("value"))


@query(f"""WITH {CELLS}, a AS (SELECT y, x, sum(k * v) / sum(k) AS v FROM k GROUP BY y, x), o AS (SELECT 'all' AS name, * FROM a WHERE x > 4 UNION ALL SELECT 'south', * FROM a WHERE x > 6 AND y < 12),
b AS (SELECT min(y) AS y0, min(x) AS x0 FROM o) SELECT name, y - y0 AS y, x - x0 AS x, {R6.format('v')} AS value FROM o, b""")
def compare_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two maps in the box that holds both."""
    m = G.grid_map(samples(spark, sf_dir), FRAME, KERNEL)
    return rounded(C.compare_maps({"all": m.where("x > 4"), "south": m.where("x > 6 and y < 12")}), "value")


@query(f"""WITH {CUBE}, m AS (SELECT y, x, avg(v) FILTER (WHERE i BETWEEN 28 AND 36) AS mean, max(v) AS peak, stddev_pop(v) FILTER (WHERE i NOT BETWEEN 28 AND 36) AS noise FROM q GROUP BY y, x)
SELECT 'mean' AS how, y, x, {R6.format('mean')} AS value FROM m UNION ALL SELECT 'noise', y, x, {R6.format('noise')} FROM m UNION ALL SELECT 'peak', y, x, {R6.format('CASE WHEN peak / noise >= 2.5 THEN peak ELSE 0 END')} FROM m""")
def collapse_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = cube_of(spark, sf_dir)
    made = [C.collapse(cube, how, WINDOW, least_snr=2.5 if how == "peak" else None).select(F.lit(how).alias("how"), "y", "x", r6("value").alias("value")) for how in ("mean", "noise", "peak")]
    return made[0].unionByName(made[1]).unionByName(made[2])


@query(f"""
WITH {HOLED} SELECT a.row_id, CAST(a.i AS INTEGER) AS i, {R6.format('sum(b.x * exp(-pow(a.i - b.i, 2) / (2 * 1.5 * 1.5))) / sum(exp(-pow(a.i - b.i, 2) / (2 * 1.5 * 1.5)))')} AS x
FROM c a JOIN c b ON a.row_id = b.row_id AND abs(a.i - b.i) <= 6 AND NOT isnan(b.x) GROUP BY a.row_id, a.i""")
def cube_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaussian means along the channels, without the missing ones."""
    return long_form(C.spectrally_smoothed(spectra(spark, sf_dir, True), 1.5)).withColumn("x", r6("x"))


@query(f"""
WITH {CELLS}, a AS (SELECT y, x, sum(k * v) / sum(k) AS v FROM k GROUP BY y, x), m AS (SELECT a.y, a.x, v, degrees(r) AS ra, degrees(d) AS dec FROM a JOIN h ON a.y = h.y AND a.x = h.x),
p2 AS (SELECT CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, radians(-(x + 1 - 7.0) * 0.004) AS e, radians((y + 1 - 8.0) * 0.004) AS n FROM range(14) a(y), range(12) b(x)),
h2 AS (SELECT y, x, radians(202.519) + atan2(e, cos(radians(47.224)) * sqrt(1 - e * e - n * n) - sin(radians(47.224)) * n) AS r, asin(n * cos(radians(47.224)) + sin(radians(47.224)) * sqrt(1 - e * e - n * n)) AS d, e, n FROM p2),
j2 AS (SELECT h2.y, h2.x, v, degrees(2 * asin(sqrt(pow(sin((d - radians(dec)) / 2), 2) + cos(d) * cos(radians(dec)) * pow(sin((r - radians(ra)) / 2), 2)))) AS far FROM m, h2),
g AS (SELECT y, x, sum(exp(-far * far / (2 * pow(0.006 / 2.355, 2))) * v) / sum(exp(-far * far / (2 * pow(0.006 / 2.355, 2)))) AS v FROM j2 WHERE far <= 0.018 GROUP BY y, x)
SELECT g.y, g.x, {R6.format('g.v')} AS value FROM g JOIN h2 ON g.y = h2.y AND g.x = h2.x
JOIN a ON a.x = CAST(round_even(13.0 - degrees(e) / 0.002, 0) AS INTEGER) - 1 AND a.y = CAST(round_even(15.0 + degrees(n) / 0.002, 0) AS INTEGER) - 1""")
def regrid_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map on a frame with pixels twice as large."""
    coarse = G.Frame(202.519, 47.224, 0.004, 12, 14, 7.0, 8.0)
    return rounded(G.regrid(G.grid_map(samples(spark, sf_dir), FRAME, KERNEL), FRAME, coarse, 0.006).select("y", "x", "value"), "value")
