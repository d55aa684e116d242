"""Rules that drop flights, telescopes, scans, or scans of one telescope; kept as a small table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "rule_id int, mission_id string, kind string, telescop string, scan int"
KINDS = ("flight", "telescope", "scan", "scan_telescope")
EVERY = "all_missions"
#: Rules are written by hand; a table beyond this is no rule table and is joined, not broadcast.
MOST_BROADCAST = 10_000


def rules_frame(spark: SparkSession, rules: Iterable[tuple]) -> DataFrame:
    """rules: (mission_id, kind, telescop, scan); they are numbered from 0."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rules)], SCHEMA)


def parse_rules(tree: dict) -> list[tuple]:
    """From {mission: {drop: {flight: bool, telescopes: [..], scans: [..], scan_telescopes: {scan: [..]}}}}."""
    out: list[tuple] = []
    for mission, body in tree.items():
        drop = (body or {}).get("drop") or {}
        if drop.get("flight"):
            out.append((mission, "flight", None, None))
        out += [(mission, "telescope", str(t), None) for t in drop.get("telescopes") or ()]
        out += [(mission, "scan", None, int(s)) for s in drop.get("scans") or ()]
        for scan, scopes in (drop.get("scan_telescopes") or {}).items():
            out += [(mission, "scan_telescope", str(t), int(scan)) for t in scopes]
    return out


#: The values that a rule without that part has in the joins; no name begins with NUL.
_ANY, _ANY_SCAN = "\0", -(1 << 31)


def _named(rules: DataFrame) -> DataFrame:
    """Rules with a value in each part of the key: any mission, any telescope, any scan have one of their own."""
    return rules.select("rule_id", F.when(F.col("mission_id") == EVERY, _ANY).otherwise(F.col("mission_id")).alias("_mission"), F.coalesce("telescop", F.lit(_ANY)).alias("_telescop"), F.coalesce("scan", F.lit(_ANY_SCAN)).alias("_scan"))


def _keyed(rows: DataFrame) -> DataFrame:
    """Each row once for every key by which a rule may name it: its mission or any, its scan or any, and its telescope's name, the parts of it before each underscore, or any."""
    parts = F.split("telescop", "_")
    names = F.when(F.col("telescop").isNotNull(), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "_"))).otherwise(F.array().cast("array<string>"))
    names = F.array_append(names, F.lit(_ANY))
    some = lambda value, every: F.array_distinct(F.array_compact(F.array(value, every)))
    out = rows.withColumn("_mission", F.explode(some(F.col("mission_id"), F.lit(_ANY)))).withColumn("_telescop", F.explode(names))
    return out.withColumn("_scan", F.explode(some(F.col("scan"), F.lit(_ANY_SCAN))))


_KEY = ["_mission", "_telescop", "_scan"]


def _small(rules: DataFrame) -> DataFrame:
    return F.broadcast(rules) if rules.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else rules


def dropped_keys(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct (mission_id, telescop, scan) of rows that a rule names. A telescope rule names the exact name, or a receiver's name before an underscore."""
    keys = rows.select("mission_id", "telescop", "scan").distinct()
    return _keyed(keys).join(_small(_named(rules).select(*_KEY).distinct()), _KEY, "left_semi").select("mission_id", "telescop", "scan").distinct()


def apply_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows (mission_id, telescop, scan, ...) that no rule drops, by joins on equal keys at every number of rules."""
    gone = dropped_keys(rows, rules)
    same = [rows[c].eqNullSafe(gone[c]) for c in ("mission_id", "telescop", "scan")]
    return rows.join(gone, same, "left_anti")


def rule_counts(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows that each rule matches, 0 included: rules without effect are worth a warning. Rows are added up by key first."""
    keys = rows.groupBy("mission_id", "telescop", "scan").agg(F.count(F.lit(1)).alias("n"))
    hits = _keyed(keys).join(_small(_named(rules)), _KEY).groupBy("rule_id").agg(F.sum("n").alias("hits"))
    return rules.join(hits, "rule_id", "left").select("rule_id", F.coalesce("hits", F.lit(0)).cast("long").alias("hits"))


def recommended_yaml(flagged: Iterable[tuple[str, str, int]]) -> str:
    """Text of rules for flagged (mission, telescop, scan) groups."""
    tree: dict[str, dict[int, list[str]]] = {}
    for mission, telescop, scan in flagged:
        tree.setdefault(mission, {}).setdefault(scan, []).append(telescop)
    lines: list[str] = []
    for mission in sorted(tree):
        lines += [f"{mission}:", "  drop:", "    scan_telescopes:"]
        lines += [f"      {scan}: [{', '.join(sorted(set(tree[mission][scan])))}]" for scan in sorted(tree[mission])]
    return "\n".join(lines) + ("\n" if lines else "")
