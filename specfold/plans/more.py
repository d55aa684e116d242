"""Further queries: overrides, positions, telluric masks, preparation, masks on maps, quality by group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specfold.operators import axes, droprules, filters, footprint, provenance, quality
from specfold.operators import cube as C
from specfold.operators import grid as G
from specfold.operators import spectra as S
from specfold.plans import pipeline
from specfold.plans.maps import CELLS, FRAME, KERNEL, samples
from specfold.plans.registry import query, table
from specfold.plans.relational import _LINK, _RULES, OBS, RULES, observations
from specfold.plans.spectral import HOLED, LONG, R6, long_form, r6, spectra

MISSIONS = (("0", 460.0, 20.0), ("1", 520.0, None))


@query(f"""
WITH {LONG}, m(mission, c, w) AS (VALUES (0, 460.0, 20.0), (1, 520.0, 30.0))
SELECT row_id, CAST(i AS INTEGER) AS i FROM c JOIN m USING (mission) WHERE abs(400 + i * 3 - m.c) <= m.w / 2""")
def telluric_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels within half the width (30 km/s where none is given) of each mission's telluric line."""
    missions = spark.createDataFrame(MISSIONS, "mission_id string, telluric_line_center double, telluric_line_width double")
    rows = axes.with_telluric_mask(spectra(spark, sf_dir).withColumn("mission_id", F.col("mission").cast("string")), missions, "mask")
    return rows.select("row_id", F.posexplode("mask").alias("i", "m")).where("m").select("row_id", "i")


@query(f"""
WITH {OBS}, {_RULES},
k AS (SELECT * FROM o WHERE (contains(upper(object), 'CLICK') OR object IN ('TSYS', 'TAU_SIG')) AND NOT EXISTS (SELECT 1 FROM r WHERE
  (r.mission_id = 'all_missions' OR r.mission_id = o.mission_id) AND (r.telescop IS NULL OR o.telescop = r.telescop OR starts_with(o.telescop, r.telescop || '_')) AND (r.scan IS NULL OR r.scan = o.scan))),
a AS ({_LINK.format(name="tsys_id", kind="TSYS").replace("FROM o s JOIN o c", "FROM k s JOIN k c")}),
b AS ({_LINK.format(name="tau_id", kind="TAU_SIG").replace("FROM o s JOIN o c", "FROM k s JOIN k c")})
SELECT k.row_id, object, tsys_id, tau_id FROM k LEFT JOIN a USING (row_id) LEFT JOIN b USING (row_id)""")
def prepare_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Science and calibration that no rule drops, with links."""
    out = pipeline.prepare(observations(spark, sf_dir), "click", droprules.rules_frame(spark, RULES))
    return out.select("row_id", "object", "tsys_id", "tau_id")


@query(f"""
WITH {OBS}, {_RULES},
k AS (SELECT * FROM o WHERE (object IN ('view', 'TSYS', 'TAU_SIG') OR contains(upper(object), 'CLI')) AND scan IN (1, 2, 4, 6, 9, 12, 20) AND (object IN ('TSYS', 'TAU_SIG') OR value <= 180) AND NOT EXISTS (SELECT 1 FROM r WHERE
  (r.mission_id = 'all_missions' OR r.mission_id = o.mission_id) AND (r.telescop IS NULL OR o.telescop = r.telescop OR starts_with(o.telescop, r.telescop || '_')) AND (r.scan IS NULL OR r.scan = o.scan))),
a AS ({_LINK.format(name="tsys_id", kind="TSYS").replace("FROM o s JOIN o c", "FROM k s JOIN k c")}),
b AS ({_LINK.format(name="tau_id", kind="TAU_SIG").replace("FROM o s JOIN o c", "FROM k s JOIN k c")})
SELECT k.row_id, object, tsys_id, tau_id FROM k LEFT JOIN a USING (row_id) LEFT JOIN b USING (row_id)""")
def prepare_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole stage: source or named object, scans, rules, value cuts, links."""
    chosen = filters.prepare_selector("view", "cli", scans=(1, 2, 4, 6, 9, 12, 20))
    out = pipeline.prepare(observations(spark, sf_dir), "view", droprules.rules_frame(spark, RULES), selector=chosen, cuts=(("value", "<=", 180.0),))
    return out.select("row_id", "object", "tsys_id", "tau_id")


@query(f"WITH {OBS}, v(mission_id, nc, vc) AS (VALUES ('3', 7, NULL), ('5', NULL, 0.25)) SELECT row_id, coalesce(v.nc, 5) AS nc, CAST(coalesce(v.vc, 0.005) AS DOUBLE) AS vc FROM o LEFT JOIN v USING (mission_id)")
def mission_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = S.overrides_frame(spark, {"3": {"nc": 7}, "5": {"vc": 0.25}}, "nc int, vc double")
    return provenance.with_overrides(observations(spark, sf_dir), own, {"nc": 5, "vc": 0.005}).select("row_id", "nc", "vc")


@query(f"SELECT vec_id AS row_id, {R6.format('202.4696 + (vec_id % 20) * 0.001 / cos(radians(47.1952 + (vec_id // 20) * 0.001))')} AS ra, {R6.format('47.1952 + (vec_id // 20) * 0.001')} AS dec FROM embeddings")
def sky_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), ((F.col("vec_id") % 20) * 0.001).alias("cdelt2"), (F.floor(F.col("vec_id") / 20) * 0.001).alias("cdelt3"))
    return G.sky(rows, 202.4696, 47.1952).select("row_id", r6("ra").alias("ra"), r6("dec").alias("dec"))


@query("""
WITH t AS (SELECT vec_id AS row_id, CAST(round_even((vec_id % 360) * 240 * 100.0, 0) AS BIGINT) AS k, CAST(round_even(abs(vec_id % 180 - 90) * 36000.0, 0) AS BIGINT) AS d, vec_id % 180 - 90 AS dec FROM embeddings)
SELECT row_id, printf('%02d:%02d:%05.2f', k // 360000, k // 6000 % 60, k % 6000 / 100.0) AS ra,
  printf('%s%02d:%02d:%04.1f', CASE WHEN dec < 0 THEN '-' ELSE '+' END, d // 36000, d // 600 % 60, d % 600 / 10.0) AS dec FROM t""")
def position_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), (F.col("vec_id") % 360).cast("double").alias("a"), (F.col("vec_id") % 180 - 90).cast("double").alias("d"))
    return rows.select("row_id", provenance.sexagesimal(F.col("a"), True).alias("ra"), provenance.sexagesimal(F.col("d"), False).alias("dec"))


@query(f"WITH {HOLED} SELECT row_id, count(*) FILTER (WHERE isnan(x)) / count(*) < 0.1 AS good FROM c GROUP BY row_id")
def split_by_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectra(spark, sf_dir, True).select("row_id", (filters.blank_fraction("spectrum") < 0.1).alias("good"))


@query("SELECT l_orderkey, l_linenumber, CAST(3000.0 * (l_linenumber + 1) AS DOUBLE) AS deltav, CAST(2.5 * (l_linenumber + 1) AS DOUBLE) AS cdelt1 FROM lineitem")
def frequency_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.lit(3000.0).alias("deltav"), F.lit(2.5).alias("cdelt1"))
    return S.rescaled_frequency(rows, F.col("l_linenumber") + 1)


#: Background that is joined to the frame's border, holes filled, and the n rings of a map m taken off.
_FLOOD = """g AS (SELECT y, x FROM range(28) a(y), range(24) b(x) WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.y = a.y AND m.x = b.x)),
o AS (SELECT y, x FROM g WHERE y IN (0, 27) OR x IN (0, 23) UNION SELECT g.y, g.x FROM o JOIN g ON abs(o.y - g.y) + abs(o.x - g.x) = 1),
f AS (SELECT y, x FROM range(28) a(y), range(24) b(x) WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.y = a.y AND o.x = b.x)),
e AS (SELECT a.y, a.x FROM f a JOIN f b ON abs(a.y - b.y) <= {n} AND abs(a.x - b.x) <= {n} GROUP BY a.y, a.x HAVING count(*) = (2 * {n} + 1) * (2 * {n} + 1))"""
_HOLED = "NOT (x BETWEEN 10 AND 11 AND y = 12) AND NOT (x BETWEEN 5 AND 8 AND y BETWEEN 6 AND 9 AND NOT (x = 7 AND y = 8)) AND NOT (x >= 14 AND y = 9)"


@query(f"""
WITH RECURSIVE {CELLS}, m AS (SELECT DISTINCT y, x FROM k WHERE NOT (x BETWEEN 10 AND 11 AND y = 12)), {_FLOOD.format(n=1)}
SELECT m.y, m.x FROM m JOIN e USING (y, x) WHERE pow(m.y - 14, 2) + pow(m.x - 12, 2) <= 64""")
def map_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hole, one ring eroded off the outer edge, and a circle."""
    m = G.grid_map(samples(spark, sf_dir), FRAME, KERNEL).where("not (x between 10 and 11 and y = 12)")
    return C.eroded(m, 1, (FRAME.ny, FRAME.nx)).where(C.in_circle(14, 12, 8)).select("y", "x")


def _holed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map with two inner holes, one of them round an island, and a cut that is open to the border."""
    return G.grid_map(samples(spark, sf_dir), FRAME, KERNEL).where(_HOLED)


@query(f"WITH RECURSIVE {CELLS}, m AS (SELECT DISTINCT y, x FROM k WHERE {_HOLED}), {_FLOOD.format(n=0)} SELECT CAST(f.y AS INTEGER) AS y, CAST(f.x AS INTEGER) AS x FROM f WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.y = f.y AND m.x = f.x)")
def map_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Background that no path joins to the border; the strips are small, so that it is found over several rounds."""
    return footprint.holes(_holed(spark, sf_dir).select("y", "x"), FRAME.ny, FRAME.nx, strip_pixels=240)


@query(f"WITH RECURSIVE {CELLS}, v AS (SELECT y, x, sum(k * v) / sum(k) AS v FROM k GROUP BY y, x), m AS (SELECT y, x, v FROM v WHERE {_HOLED}), {_FLOOD.format(n=2)} SELECT m.y, m.x, {R6.format('v')} AS value FROM m JOIN e USING (y, x)")
def map_trim_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map less a border of eight per cent of its shorter side: two rings."""
    rings = footprint.border_rings("8%", FRAME.pixel * 3600, FRAME.ny, FRAME.nx)
    return C.eroded(_holed(spark, sf_dir), rings, (FRAME.ny, FRAME.nx)).select("y", "x", r6("value").alias("value"))


@query(f"WITH {CELLS} SELECT DISTINCT y, x FROM k WHERE x > 3 AND x < 15 AND y > 2 AND y < 20 AND y < x + 8")
def map_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inside the polygon of the lines x = 3, y = 2, x = 15, y = 20 and y = x + 8, none of which hits a pixel centre."""
    inside = C.in_polygon([(3.5, 2.5), (14.5, 2.5), (14.5, 19.5), (11.75, 19.5), (3.5, 11.25)])
    return G.grid_map(samples(spark, sf_dir), FRAME, KERNEL).where(inside).select("y", "x")


@query(f"""
WITH {CELLS}, m AS (SELECT DISTINCT y, x FROM k) SELECT min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1 FROM m WHERE x > 5""")
def crop_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.crop_box(G.grid_map(samples(spark, sf_dir), FRAME, KERNEL).where("x > 5"))


@query(f"""
WITH {LONG}, g AS (SELECT row_id % 5 AS mission, i % 4 AS component, abs(avg(x)) * 10 AS score FROM c GROUP BY ALL),
f AS (SELECT mission, min(component) AS f FROM g WHERE NOT score >= 0.05 GROUP BY mission)
SELECT CAST(g.mission AS VARCHAR) AS mission_id, CAST(greatest(1, coalesce(any_value(f), 4)) AS BIGINT) AS n_components FROM g LEFT JOIN f USING (mission) GROUP BY g.mission""")
def chosen_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = long_form(spectra(spark, sf_dir))
    scores = long.groupBy((F.col("row_id") % 5).cast("string").alias("mission_id"), (F.col("i") % 4).alias("component")).agg((F.abs(F.avg("x")) * 10).alias("score"))
    return S.chosen_components(scores, 0.05)


@query(f"WITH {LONG}, o AS (SELECT *, ['S-H_OBS', 'S-H_FIT', 'M51', 'SKYCHOPDIFF'][1 + row_id % 4] AS object FROM c) SELECT CAST(mission AS VARCHAR) AS mission_id, object, CAST(i AS INTEGER) AS pos, {R6.format('avg(x)')} AS mean, {R6.format('stddev_pop(x)')} AS std, count(*) AS n FROM o WHERE object IN ('S-H_OBS', 'S-H_FIT') GROUP BY ALL")
def telluric_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed and fitted sky of each mission, among four classes of rows."""
    rows = spectra(spark, sf_dir).withColumns({"mission_id": F.col("mission").cast("string"), "object": F.element_at(F.array(*map(F.lit, ("S-H_OBS", "S-H_FIT", "M51", "SKYCHOPDIFF"))), (F.col("row_id") % 4 + 1).cast("int"))})
    return S.telluric_average(rows).withColumns({"mean": r6("mean"), "std": r6("std")})


@query(f"WITH {HOLED} SELECT a.row_id, {R6.format('stddev_pop(a.x - b.x)')} AS rms FROM c a JOIN c b ON b.row_id = a.row_id + 1 AND a.i = b.i WHERE a.row_id % 2 = 0 AND NOT isnan(a.x) AND NOT isnan(b.x) AND a.i BETWEEN 10 AND 50 GROUP BY a.row_id")
def residual_rms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noise of the difference of paired spectra in a window."""
    rows = spectra(spark, sf_dir, True)
    keyed = rows.select("row_id", F.floor(F.col("row_id") / 2).alias("pair"), (F.col("row_id") % 2 == 0).alias("observed"), "spectrum")
    return S.residual_rms(keyed.where("observed"), keyed.where("not observed"), ["pair"], (10, 50)).select("row_id", r6("rms").alias("rms"))


@query("""
WITH q AS (SELECT median(l_extendedprice) AS med FROM lineitem), d AS (SELECT median(abs(l_extendedprice - med)) AS mad FROM lineitem, q)
SELECT l_orderkey, l_linenumber, l_extendedprice > med + 1.5 * 1.4826 * mad AS flag FROM lineitem, q, d""")
def mad_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.mad_flags(table(spark, sf_dir, "lineitem"), "l_extendedprice", 1.5).select("l_orderkey", "l_linenumber", "flag")


@query()
def noise_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telluric channels replaced by seeded noise."""
    missions = spark.createDataFrame(MISSIONS, "mission_id string, telluric_line_center double, telluric_line_width double")
    rows = spectra(spark, sf_dir).withColumn("mission_id", F.col("mission").cast("string"))
    return S.noise_filled(rows, missions, 42, True).select("row_id", "spectrum")


@query(f"""
WITH {CELLS}, r AS (SELECT vec_id AS row_id, CASE WHEN vec_id % 9 = 0 THEN 0 ELSE 1 / abs(CAST(embedding[2] AS DOUBLE)) END AS r FROM embeddings), u AS (SELECT row_id, r / (SELECT max(r) FROM r) AS u FROM r)
SELECT y, x, {R6.format('sum(k * u * v) / sum(k * u)')} AS value, {R6.format('sum(k * u)')} AS weight FROM k JOIN u USING (row_id) GROUP BY y, x HAVING sum(k * u) > 0""")
def map_inverse_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map weighted by the inverse size of a column, over its largest; every ninth row has none."""
    rows = samples(spark, sf_dir).withColumn("noise", F.when(F.col("row_id") % 9 != 0, F.col("spectrum")[1]))
    out = G.grid_map(G.with_inverse_weight(rows, "noise", "u"), FRAME, KERNEL, weight=F.col("u")).where("weight > 0")
    return out.select("y", "x", r6("value").alias("value"), r6("weight").alias("weight"))


@query(f"""
WITH {CELLS}, c AS (SELECT vec_id AS row_id, i, 2000 + 100 * (vec_id % 7) + i AS s, CASE WHEN i = 3 THEN NULL ELSE 0.1 * (1 + vec_id % 5) END AS t FROM embeddings, range(64) r(i)),
q AS (SELECT row_id, sum(pow(exp(-t) / s, 2)) AS q FROM c WHERE row_id % 4 <> 0 AND i BETWEEN 2 AND 40 GROUP BY row_id),
w AS (SELECT s.row_id, coalesce(q / (SELECT quantile_cont(q, 0.5) FROM q), 1) AS u FROM (SELECT vec_id AS row_id FROM embeddings) s LEFT JOIN q USING (row_id))
SELECT y, x, {R6.format('sum(k * u * v) / sum(k * u)')} AS value, {R6.format('sum(k * u)')} AS weight FROM k JOIN w USING (row_id) GROUP BY y, x""")
def map_channel_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map weighted by the sums of the calibration rows' channel weights, over their median; every fourth row has no calibration."""
    rows = samples(spark, sf_dir)
    cal = lambda k, f: rows.select("row_id", F.transform(F.sequence(F.lit(0), F.lit(63)), f).alias("spectrum")).withColumn("row_id", F.col("row_id") * 2 + k)
    tsys = cal(0, lambda i: (2000 + 100 * (F.col("row_id") % 7) + i).cast("double"))
    tau = cal(1, lambda i: F.when(i == 3, F.lit(float("nan"))).otherwise(0.1 * (1 + F.col("row_id") % 5)))
    linked = rows.withColumns({"tsys_id": F.when(F.col("row_id") % 4 != 0, F.col("row_id") * 2), "tau_id": F.when(F.col("row_id") % 4 != 0, F.col("row_id") * 2 + 1)})
    out = G.grid_map(G.with_channel_quality(linked, tsys.unionByName(tau), (2, 40)), FRAME, KERNEL, weight=F.col("quality"))
    return out.select("y", "x", r6("value").alias("value"), r6("weight").alias("weight"))


@query(f"""WITH RECURSIVE {CELLS}, z AS (SELECT vec_id AS row_id, i, CASE WHEN vec_id % 7 = 0 AND i % 5 = 0 THEN 0 ELSE 1 END AS has FROM embeddings, range(64) r(i)),
d AS (SELECT y, x, sum(k * w * has) AS s FROM k JOIN z USING (row_id) WHERE i BETWEEN 28 AND 36 GROUP BY y, x), m AS (SELECT y, x, s FROM d WHERE {_HOLED}), {_FLOOD.format(n=1)}
SELECT m.y, m.x, {R6.format('s')} AS value FROM m JOIN e USING (y, x)""")
def collapse_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of the channels' weights over a window, in a cube of spectra with holes; one outer ring trimmed, the map's own holes kept apart."""
    rows = samples(spark, sf_dir).drop("spectrum").join(spectra(spark, sf_dir, True).select("row_id", "spectrum"), "row_id")
    cube = G.grid_cube(rows, FRAME, KERNEL, weight=F.col("w")).where(_HOLED)
    out = C.collapse(cube, "weight", (28, 36), trim=(1, FRAME.ny, FRAME.nx))
    return out.select("y", "x", r6("value").alias("value"))
