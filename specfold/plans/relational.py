"""Queries of filters, drop rules, links, set operations and text columns on the row tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from specfold.functions.arrays import scalar
from specfold.operators import droprules, filters, links, provenance, quality
from specfold.plans.registry import query, table

OBS = """o AS (
  SELECT event_id AS row_id, CAST(user_id AS VARCHAR) AS mission_id, CAST(day(ts) AS INTEGER) AS scan,
         CAST(hour(ts) AS INTEGER) AS subscan, epoch_us(ts) AS t, value, event_type,
         CASE event_type WHEN 'error' THEN 'TSYS' WHEN 'signup' THEN 'TAU_SIG' ELSE event_type END AS object,
         'PX' || lpad(CAST(user_id % 7 AS VARCHAR), 2, '0') || CASE WHEN user_id % 2 = 0 THEN '_S' ELSE '' END AS telescop
  FROM events)"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations: user is the mission, day the scan, hour the subscan."""
    ts = F.col("ts").cast("timestamp")
    name = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"), F.col("user_id").cast("string").alias("mission_id"), F.dayofmonth(ts).alias("scan"), F.hour(ts).alias("subscan"), F.unix_micros(ts).alias("t"), "value", "event_type",
        F.when(name == "error", "TSYS").when(name == "signup", "TAU_SIG").otherwise(name).alias("object"),
        F.concat(F.lit("PX"), F.lpad((F.col("user_id") % 7).cast("string"), 2, "0"), F.when(F.col("user_id") % 2 == 0, "_S").otherwise("")).alias("telescop"),
    )


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_quantity <= 40 AND l_discount >= 0.02 AND l_extendedprice <= 60000""")
def filter_param_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return rows.where(filters.cut("l_quantity", "<=", 40) & filters.cut("l_discount", ">=", 0.02) & filters.cut("l_extendedprice", "<=", 60000)).select("l_orderkey", "l_linenumber")


@query(f"WITH {OBS} SELECT row_id, object FROM o WHERE contains(mission_id, '12') OR contains(mission_id, '7')")
def filter_contains_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).where(filters.contains_any("mission_id", ("12", "7"))).select("row_id", "object")


@query(f"WITH {OBS} SELECT row_id, object FROM o WHERE object IN ('click', 'TSYS', 'TAU_SIG')")
def filter_exact_protected(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = filters.FilterSpec(keep_objects=("click",), science="click")
    return filters.split(observations(spark, sf_dir), spec)[0].select("row_id", "object")


@query(f"WITH {OBS} SELECT row_id, scan FROM o WHERE NOT (scan IN (3, 5) OR object = 'view')")
def filter_remove_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = filters.FilterSpec(remove={"scan": (3, 5), "object": ("view ",)})
    return filters.split(observations(spark, sf_dir), spec)[0].select("row_id", "scan")


@query(f"""
WITH {OBS},
r AS (SELECT CASE
  WHEN NOT (contains(mission_id, '1') OR contains(mission_id, '2')) THEN 'mission_keep'
  WHEN scan = 3 THEN 'removed'
  WHEN contains(mission_id, '13') THEN 'flight'
  WHEN telescop IN ('PX01', 'PX02_S') AND object NOT IN ('TSYS', 'TAU_SIG') THEN 'obsmode'
  WHEN object = 'signup' THEN 'object_exact'
  WHEN object = 'purchase' AND NOT value <= 150 THEN 'param'
  ELSE 'kept' END AS reason FROM o)
SELECT reason, count(*) AS n FROM r GROUP BY reason""")
def filter_reject_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = filters.FilterSpec(keep_missions=("1", "2"), remove={"scan": (3,)}, drop_flights=("13",), drop_obsmodes=("PX01", "PX02_S"), drop_objects=("signup",), cuts=(("value", "<=", 150.0),), science="PURCHASE", obsmode="telescop")
    return filters.reason_counts(filters.with_reject_reason(observations(spark, sf_dir), spec))


@query("""
WITH t AS (SELECT least(quantile_cont(l_extendedprice, 0.8), 50000) AS cap FROM lineitem WHERE l_returnflag = 'N')
SELECT l_orderkey, l_linenumber FROM lineitem, t WHERE l_returnflag <> 'N' OR l_extendedprice <= cap""")
def filter_adaptive_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    limit = filters.percentile_limit(rows, "l_extendedprice", 80, 50000.0, F.col("l_returnflag") == "N")
    return rows.where((F.col("l_returnflag") != "N") | filters.cut("l_extendedprice", "<=", scalar(limit))).select("l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_tax > 0.02 AND l_quantity < 10")
def filter_sample_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return rows.where(filters.strict_cut("l_tax", ">", 0.02) & filters.strict_cut("l_quantity", "<", 10)).select("l_orderkey", "l_linenumber")


def _tau_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with one-channel spectra (value / 400) and the linked opacity row."""
    rows = observations(spark, sf_dir).withColumn("spectrum", F.array(F.col("value") / 400))
    science = rows.where(~F.col("object").isin("TSYS", "TAU_SIG"))
    linked = links.link_calibration(science, rows.where("object = 'TAU_SIG'"), name="tau_id").select("row_id", "tau_id")
    return rows.join(linked, "row_id", "left")


_LINK = """
  SELECT s.row_id, first(c.row_id ORDER BY c.subscan <> s.subscan - 1,
         CASE WHEN c.subscan = s.subscan - 1 THEN 0 ELSE abs(c.t - s.t) END, c.row_id) AS {name}
  FROM o s JOIN o c ON s.mission_id = c.mission_id AND s.scan = c.scan AND c.object = '{kind}'
  WHERE s.object NOT IN ('TSYS', 'TAU_SIG') GROUP BY s.row_id"""


@query(f"""
WITH {OBS}, l AS ({_LINK.format(name="tau_id", kind="TAU_SIG")}),
b AS (SELECT row_id FROM o WHERE object = 'TAU_SIG' AND NOT (value / 400 BETWEEN 0.001 AND 1))
SELECT o.row_id, l.tau_id FROM o LEFT JOIN l USING (row_id)
WHERE o.row_id NOT IN (SELECT row_id FROM b) AND (l.tau_id IS NULL OR l.tau_id NOT IN (SELECT row_id FROM b))""")
def filter_tau_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.split(_tau_links(spark, sf_dir), filters.FilterSpec(tau_id="tau_id"))[0].select("row_id", "tau_id")


@query(f"""
WITH {OBS}, a AS ({_LINK.format(name="tsys_id", kind="TSYS")}), b AS ({_LINK.format(name="tau_id", kind="TAU_SIG")})
SELECT o.row_id, tsys_id, tau_id FROM o LEFT JOIN a USING (row_id) LEFT JOIN b USING (row_id)
WHERE object NOT IN ('TSYS', 'TAU_SIG')""")
def link_pattern_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations(spark, sf_dir)
    science = rows.where(~F.col("object").isin("TSYS", "TAU_SIG"))
    out = links.link_calibration(science, rows.where("object = 'TSYS'"), name="tsys_id")
    return links.link_calibration(out, rows.where("object = 'TAU_SIG'"), name="tau_id").select("row_id", "tsys_id", "tau_id")


@query(f"""
WITH {OBS}, b AS ({_LINK.format(name="tau_id", kind="TAU_SIG")})
SELECT o.row_id, g.row_id AS tau_id FROM o LEFT JOIN b USING (row_id)
LEFT JOIN (SELECT row_id FROM o WHERE value <= 200) g ON b.tau_id = g.row_id WHERE value <= 200""")
def link_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = _tau_links(spark, sf_dir).where("value <= 200").select("row_id", "tau_id")
    return filters.remap_links(left, left, ["tau_id"])


@query(f"""
WITH {OBS}, b AS ({_LINK.format(name="tau_id", kind="TAU_SIG")}),
s AS (SELECT o.row_id, tau_id, object FROM o LEFT JOIN b USING (row_id) WHERE object = 'click')
SELECT row_id, object FROM s UNION ALL
SELECT row_id, object FROM o WHERE row_id IN (SELECT tau_id FROM s)""")
def referenced_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tau_links(spark, sf_dir).select("row_id", "tau_id", "object")
    return filters.with_referenced(rows.where("object = 'click'"), rows, ["tau_id"]).select("row_id", "object")


RULES = (("7", "flight", None, None), ("12", "telescope", "PX05", None), (droprules.EVERY, "telescope", "PX03", None), ("20", "scan", None, 4), (droprules.EVERY, "scan_telescope", "PX02", 6), ("nobody", "flight", None, None))
_RULES = "r(rule_id, mission_id, telescop, scan) AS (VALUES (0, '7', NULL, NULL), (1, '12', 'PX05', NULL), (2, 'all_missions', 'PX03', NULL), (3, '20', NULL, 4), (4, 'all_missions', 'PX02', 6), (5, 'nobody', NULL, NULL))"
_HIT = "(r.mission_id = 'all_missions' OR r.mission_id = o.mission_id) AND (r.telescop IS NULL OR o.telescop = r.telescop OR starts_with(o.telescop, r.telescop || '_')) AND (r.scan IS NULL OR r.scan = o.scan)"


@query(f"WITH {OBS}, {_RULES} SELECT row_id, telescop FROM o WHERE NOT EXISTS (SELECT 1 FROM r WHERE {_HIT})")
def drop_rules_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return droprules.apply_rules(observations(spark, sf_dir), droprules.rules_frame(spark, RULES)).select("row_id", "telescop")


@query(f"WITH {OBS}, {_RULES} SELECT CAST(rule_id AS INTEGER) AS rule_id, count(o.row_id) AS hits FROM r LEFT JOIN o ON {_HIT} GROUP BY rule_id")
def drop_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return droprules.rule_counts(observations(spark, sf_dir), droprules.rules_frame(spark, RULES))


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One row a key: the first click and the first view of each mission, scan and subscan."""
    rows = observations(spark, sf_dir)
    first = lambda kind: rows.where(F.col("object") == kind).groupBy("mission_id", "scan", "subscan").agg(F.min("row_id").alias("row_id"))
    return links.check_unique(first("click"), KEYS), first("view")


KEYS = ("mission_id", "scan", "subscan")
_SIDES = f"""{OBS},
a AS (SELECT mission_id, scan, subscan, min(row_id) AS row_id FROM o WHERE object = 'click' GROUP BY ALL),
b AS (SELECT mission_id, scan, subscan, min(row_id) AS row_id FROM o WHERE object = 'view' GROUP BY ALL)"""


@query(f"WITH {_SIDES} SELECT mission_id, scan, subscan, a.row_id AS left_id, b.row_id AS right_id FROM a JOIN b USING (mission_id, scan, subscan)")
def pair_obs_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.pair_rows(*_sides(spark, sf_dir), KEYS)


@query(f"WITH {_SIDES} SELECT mission_id, scan, subscan, a.row_id FROM a ANTI JOIN b USING (mission_id, scan, subscan)")
def pair_left_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _sides(spark, sf_dir)
    return links.unpaired(a, b, KEYS)


@query(f"WITH {_SIDES} SELECT mission_id, scan, subscan, b.row_id FROM b ANTI JOIN a USING (mission_id, scan, subscan)")
def pair_right_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _sides(spark, sf_dir)
    return links.unpaired(b, a, KEYS)


@query(f"""
WITH {OBS},
a AS (SELECT row_id AS left_id, row_number() OVER (ORDER BY row_id) AS place FROM o WHERE object = 'click'),
b AS (SELECT row_id AS right_id, row_number() OVER (ORDER BY row_id) AS place FROM o WHERE object = 'view')
SELECT place, left_id, right_id FROM a JOIN b USING (place)""")
def pair_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations(spark, sf_dir)
    return links.pair_positional(rows.where("object = 'click'"), rows.where("object = 'view'"))


@query(f"""
WITH {OBS},
m AS (SELECT mission_id, telescop, row_number() OVER (ORDER BY mission_id, telescop) AS model_id
      FROM (SELECT DISTINCT mission_id, left(telescop, 4) AS telescop FROM o WHERE CAST(mission_id AS INTEGER) % 3 = 0
            UNION SELECT DISTINCT mission_id, 'other' FROM o WHERE CAST(mission_id AS INTEGER) % 5 = 0))
SELECT row_id, coalesce(
  (SELECT min(model_id) FROM m WHERE m.mission_id = o.mission_id AND m.telescop = o.telescop),
  (SELECT min(model_id) FROM m WHERE m.mission_id = o.mission_id AND m.telescop = left(o.telescop, 4)),
  (SELECT min(model_id) FROM m WHERE m.mission_id = o.mission_id)) AS model_id FROM o""")
def decomposition_fallback_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations(spark, sf_dir)
    number = F.col("mission_id").cast("int")
    a = rows.where(number % 3 == 0).select("mission_id", F.substring("telescop", 1, 4).alias("telescop"))
    b = rows.where(number % 5 == 0).select("mission_id", F.lit("other").alias("telescop"))
    models = a.union(b).distinct()
    models = models.withColumn("model_id", F.row_number().over(Window.orderBy("mission_id", "telescop")).cast("long"))
    return links.match_models(rows, models).select("row_id", "model_id")


def _cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three event types as files; the value of a cycle is its least, rounded down."""
    rows = observations(spark, sf_dir).where(F.col("event_type").isin("click", "view", "purchase"))
    return rows.groupBy(F.col("event_type").alias("file"), "scan", "subscan").agg(F.floor(F.min("value")).cast("double").alias("value"))


_CYCLES = f"{OBS}, y AS (SELECT event_type AS file, scan, subscan, floor(min(value)) AS value FROM o WHERE event_type IN ('click', 'view', 'purchase') GROUP BY ALL)"


@query(f"""
WITH {_CYCLES}, m AS (SELECT scan, subscan, min(value) AS least FROM y GROUP BY ALL HAVING count(DISTINCT file) = 3)
SELECT y.scan, y.subscan, min(file) AS winner, least, count(*) AS n_tied FROM y JOIN m ON y.scan = m.scan AND y.subscan = m.subscan AND y.value = m.least
GROUP BY y.scan, y.subscan, least""")
def cycle_argmin_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.cycle_winners(_cycles(spark, sf_dir), 3)


@query(f"WITH {OBS} SELECT scan, subscan, round(avg(value), 6) + 0.0 AS mean_value, max(value) - min(value) > 1e-6 AS mixed FROM o GROUP BY scan, subscan")
def cycle_mean_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.cycle_values(observations(spark, sf_dir)).withColumn("mean_value", F.round("mean_value", 6) + 0.0)


@query(f"WITH {_CYCLES} SELECT scan, subscan FROM y GROUP BY ALL HAVING count(DISTINCT file) = 3")
def common_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.common_cycles(_cycles(spark, sf_dir), 3)


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 200000 EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'")
def key_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").where("o_totalprice > 200000").select("o_orderkey")
    return a.subtract(table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_orderkey"))


@query("""
SELECT 0 AS hdu, event_id * 2 AS row_id, value FROM events WHERE event_type = 'click' UNION ALL
SELECT 1 AS hdu, event_id * 2 + 1 AS row_id, value FROM events WHERE event_type = 'view'""")
def combine_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), "value", "event_type")
    parts = [rows.where(F.col("event_type") == k).drop("event_type") for k in ("click", "view")]
    return provenance.combine(parts, links=())


@query(f"WITH {OBS} SELECT mission_id, telescop, scan, count(*) AS n, bool_or(object NOT IN ('TSYS')) AS science FROM o GROUP BY ALL")
def split_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance.manifest(observations(spark, sf_dir), ["mission_id", "telescop", "scan"], "TSYS")


@query(f"WITH {OBS} SELECT object, count(*) AS n FROM o GROUP BY object")
def object_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.value_counts(observations(spark, sf_dir), "object")


@query(f"WITH {OBS} SELECT mission_id, count(*) AS n, count(DISTINCT scan) AS n_scans, string_agg(DISTINCT CAST(scan AS VARCHAR), ',' ORDER BY CAST(scan AS VARCHAR)) AS scans FROM o GROUP BY mission_id")
def unique_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.mission_scans(observations(spark, sf_dir))


_PARAM = "'nc=' || (l_linenumber % 4 + 2) || ' vc=0.005 nr=' || CASE WHEN l_returnflag = 'R' THEN 'none' ELSE '1.0' END || ' lstsq=' || CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END || CASE WHEN l_linenumber = 7 THEN ' skip=1' ELSE '' END"


def _provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    flags = {"nc": F.col("l_linenumber") % 4 + 2, "vc": F.lit(0.005), "nr": F.when(F.col("l_returnflag") != "R", 1.0), "lstsq": (F.col("l_linestatus") == "O").cast("int")}
    return rows.withColumn("pcaparam", provenance.provenance(flags, skip=F.col("l_linenumber") == 7))


@query(f"SELECT l_orderkey, l_linenumber, {_PARAM} AS pcaparam FROM lineitem")
def provenance_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _provenance(spark, sf_dir).select("l_orderkey", "l_linenumber", "pcaparam")


@query(f"SELECT {_PARAM} AS pcaparam, count(*) AS n FROM lineitem GROUP BY ALL")
def param_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.value_counts(_provenance(spark, sf_dir), "pcaparam")


@query("SELECT l_quantity AS value, count(*) AS n FROM lineitem GROUP BY ALL ORDER BY n DESC, value LIMIT 20")
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.top_values(table(spark, sf_dir, "lineitem"), "l_quantity", 20)


@query("""
SELECT l_returnflag, count(*) AS n, round(avg(l_extendedprice), 6) + 0.0 AS mean, round(median(l_extendedprice), 6) + 0.0 AS median,
  round(stddev_pop(l_extendedprice), 6) + 0.0 AS std, min(l_extendedprice) AS least, max(l_extendedprice) AS most,
  round(quantile_cont(l_extendedprice, 0.05), 6) + 0.0 AS p5, round(quantile_cont(l_extendedprice, 0.95), 6) + 0.0 AS p95
FROM lineitem GROUP BY l_returnflag""")
def metric_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    out = quality.metric_stats(rows, "l_extendedprice", ["l_returnflag"])
    return out.select("l_returnflag", "n", *[(F.round(c, 6) + 0.0).alias(c) for c in ("mean", "median", "std")], "least", "most", *[(F.round(c, 6) + 0.0).alias(c) for c in ("p5", "p95")])


@query("""
WITH m AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT least(24, CAST(floor((l_extendedprice - lo) / ((hi - lo) / 25)) AS INTEGER)) AS bin, count(*) AS n FROM lineitem, m GROUP BY ALL""")
def metric_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 25).select("bin", "n")


@query("""
SELECT b AS bound, (SELECT count(*) FROM lineitem WHERE l_extendedprice / (l_quantity * 1000) <= b) AS n
FROM (VALUES (1.0::DOUBLE), (1.3), (1.5), (2.0), (3.0)) t(b)""")
def ratio_cumulative_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = F.col("l_extendedprice") / (F.col("l_quantity") * 1000)
    return quality.cumulative_counts(table(spark, sf_dir, "lineitem").select(ratio.alias("ratio")), "ratio", (1.0, 1.3, 1.5, 2.0, 3.0))


@query("""
WITH s AS (SELECT l_orderkey, l_linenumber, l_extendedprice / 10 AS tsys, l_quantity / 10 AS on_s, l_discount * 100 AS off_s, l_tax AS tau FROM lineitem)
SELECT l_orderkey, l_linenumber, round(tsys / sqrt(abs(-38.0) / 299792458 * 1.9005e12)
  * sqrt(1 / on_s + CASE WHEN off_s > 0 THEN 1 / off_s ELSE 0 END) * CASE WHEN tau > 0 THEN exp(tau / sin(radians(40))) ELSE 1 END, 6) + 0.0 AS sigma
FROM s""")
def radiometer_rms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    sigma = quality.theoretical_rms(F.col("l_extendedprice") / 10, F.col("l_quantity") / 10, F.col("l_discount") * 100, F.col("l_tax"), F.lit(40.0), F.lit(-38.0), F.lit(1.9005e12))
    return rows.select("l_orderkey", "l_linenumber", (F.round(sigma, 6) + 0.0).alias("sigma"))


@query(r"""
WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_brand ELSE upper(left(p_name, 3)) || ['H', 'V', 'X'][1 + p_partkey % 3] || '_PX' || lpad(CAST(p_partkey % 14 AS VARCHAR), 2, '0') || '_S' END AS t FROM part)
SELECT p_partkey, nullif(regexp_extract(t, '^([A-Z]{3})([HV])_PX(\d+)', 1), '') AS receiver, nullif(regexp_extract(t, '^([A-Z]{3})([HV])_PX(\d+)', 2), '') AS polarization,
  CAST(nullif(regexp_extract(t, '^([A-Z]{3})([HV])_PX(\d+)', 3), '') AS INTEGER) AS pixel FROM t""")
def telescop_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receiver, polarization and pixel of names, some of which are of another form."""
    key = F.col("p_partkey")
    kind = F.element_at(F.array(F.lit("H"), F.lit("V"), F.lit("X")), (key % 3 + 1).cast("int"))
    name = F.when(key % 5 == 0, F.col("p_brand")).otherwise(F.concat(F.upper(F.substring("p_name", 1, 3)), kind, F.lit("_PX"), F.lpad((key % 14).cast("string"), 2, "0"), F.lit("_S")))
    return table(spark, sf_dir, "part").withColumn("telescop", name).select("p_partkey", *provenance.parse_telescop("telescop"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(epoch_us(o_orderdate) / 1000000 + o_orderkey % 86400 AS DOUBLE) AS instant FROM orders""")
def date_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written without padding are read again and joined with seconds of the day."""
    day = F.to_date("o_orderdate")
    short = F.concat_ws("-", F.year(day), F.lpad(F.month(day).cast("string"), 2, "0"), F.dayofmonth(day))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", short.alias("date_obs"))
    fixed = provenance.repaired_date("date_obs")
    return rows.select("o_orderkey", fixed.cast("string").alias("day"), provenance.instant(fixed, (F.col("o_orderkey") % 86400).cast("double")).alias("instant"))


