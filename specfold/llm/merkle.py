"""Merkle manifest of a dataset, and a proof for every document.

A leaf is the SHA-256 of a document's columns. Within a part (a language) leaves ascend by doc_id; while a level has several
nodes, each run of `arity` consecutive ones (the last may have fewer, even one) becomes the digest of its children's. What
remains is the part's subroot; the subroots, in order of their parts, give the root by the same rule.

Nodes are events. A task keeps a partial parent for each run that it has seen children of, by their index; how many
children it waits for follows from the number of leaves alone. The child that completes a parent makes it an event one level up, in the same
task, so that leaves, which arrive in order, leave a task with few partial parents: those at its edges. These are shuffled to
tasks by their common ancestor `LEVELS` levels up, which complete them, and so on, until only roots are left. Every
completed parent is written with its children, as a link; read downwards from the root, in cogroups of the subtrees of LEVELS levels, links
give each node's path: its place among its siblings and their digests, level by level.

Null columns count as `-`, which no value does. A null part comes first, a null doc_id first in its part; rows of one part and doc_id are ordered by
their leaves, so repeated rows need no further order. Empty and long texts are hashed whole. A single document is its part's
subroot. An empty table has neither root nor proofs. Columns that are not asked for are not read, whatever their names.

No task holds more than a subtree of LEVELS levels (4 096 leaves at arity 8) and the nodes at its tasks' edges; the driver sees the
number of levels alone. Each round is a written table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from specfold.llm.common import keep_only, session_of, staged

ARITY = 8
#: Levels that one round resolves, and one cogroup of proofs.
LEVELS = 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_EVENT = "part string, n long, level int, idx long, digest string, children array<string>, kind int"
OPEN, LINK, ROOT = 0, 1, 2
_STEP = pa.struct([("at", pa.int32()), ("siblings", pa.list_(pa.string()))])
PATH = "array<struct<at:int,siblings:array<string>>>"


def digest(values: Sequence[Column]) -> Column:
    """SHA-256 of values: each its bytes' number, a colon and itself, or - where null; integers are decimal."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _parent(children: Sequence[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def combine(arity: int):
    """The Arrow function that turns events into links, roots, and the events that still wait for siblings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partial: dict[tuple[str, int, int], dict[int, str]] = {}
        counts: dict[str, list[int]] = {}  # nodes of each level, up to the root's
        out: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "n", "level", "idx", "digest", "children", "kind"])

        for batch in batches:
            for part, n, level, idx, node in zip(*[batch.column(c).to_pylist() for c in ("part", "n", "level", "idx", "digest")], strict=True):
                if part not in counts:
                    counts[part] = [n]
                    while counts[part][-1] > 1:
                        counts[part].append(-(-counts[part][-1] // arity))
                of = counts[part]
                while True:
                    if of[level] == 1:
                        out.append((part, n, level, idx, node, None, ROOT))
                        break
                    above, place = divmod(idx, arity)
                    waiting = partial.setdefault((part, level + 1, above), {})
                    waiting[place] = node
                    want = min(arity, of[level] - above * arity)
                    if len(waiting) < want:
                        break
                    del partial[part, level + 1, above]
                    children = [waiting[i] for i in range(want)]
                    level, idx, node = level + 1, above, _parent(children)
                    out.append((part, n, level, idx, None, children, LINK))
                if len(out) >= 4096:
                    yield batch_of(out)
                    out = []
        out += [(part, counts[part][0], level - 1, above * arity + i, node, None, OPEN) for (part, level, above), waiting in partial.items() for i, node in waiting.items()]
        if out:
            yield batch_of(out)

    return run


def _tree(leaves: DataFrame, order: Sequence[str], folder: str, name: str, arity: int) -> int:
    """leaves: part, digest, the columns of `order` and others. Writes name-leaves with idx and n, name-links, name-roots; gives the number of levels above the leaves."""
    spark = session_of(leaves)
    by = ["part", *order]
    sorted_ = leaves.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id())
    sorted_ = staged(sorted_, folder, f"{name}-sorted")
    run = F.shiftright("_place", 33).alias("_run")  # the task that sorted it
    runs = sorted_.groupBy("part", run).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_count"))
    of_part = Window.partitionBy("part")
    before = F.coalesce(F.sum("_count").over(of_part.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = staged(runs.select("part", "_run", (before - F.col("_first")).alias("_shift"), F.sum("_count").over(of_part).alias("n")), folder, f"{name}-runs")
    placed = sorted_.withColumn("_run", run).join(runs, ["part", "_run"]).withColumn("idx", F.col("_place") + F.col("_shift")).drop("_run", "_shift", "_place")
    largest = runs.agg(F.max("n")).first()[0] or 0
    levels = 0
    while arity**levels < largest:
        levels += 1

    events = placed.select("part", "n", F.lit(0).alias("level"), "idx", "digest")
    rounds = [staged(events.mapInArrow(combine(arity), _EVENT), folder, f"{name}-round0")]
    for i, top in enumerate(range(LEVELS, levels + LEVELS, LEVELS), 1):
        waiting = rounds[-1].where(F.col("kind") == OPEN).drop("kind", "children")
        below = F.greatest(F.lit(top) - F.col("level"), F.lit(1))
        ancestor = F.floor(F.col("idx") / F.pow(F.lit(float(arity)), below)).cast("long")
        waiting = waiting.withColumns({"_at": F.greatest(F.lit(top), F.col("level") + 1), "_ancestor": ancestor})
        grouped = waiting.repartition("part", "_at", "_ancestor").sortWithinPartitions("part", "_at", "_ancestor", "level", "idx").drop("_at", "_ancestor")
        rounds.append(staged(grouped.mapInArrow(combine(arity), _EVENT), folder, f"{name}-round{i}"))
    done = reduce(DataFrame.unionByName, rounds)
    placed.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}-leaves")
    done.where(F.col("kind") == LINK).select("part", "level", "idx", "children").write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}-links")
    done.where(F.col("kind") == ROOT).select("part", "n", "digest").write.mode("overwrite").parquet(f"{folder}/{name}-roots")
    return levels


def write(docs: DataFrame, folder: str, columns: Sequence[str] = COLUMNS, part: str = "lang", order: str = "doc_id", arity: int = ARITY, beside: dict[str, Column] | None = None) -> None:
    """The manifest of docs below folder. Leaves keep `order` and what `beside` computes from their documents."""
    spark = session_of(docs)
    key = F.coalesce(F.concat(F.lit("="), F.col(part).cast("string")), F.lit(""))  # null first, then bytes
    leaf = digest([F.col(c) for c in columns])
    leaves = docs.select(key.alias("part"), F.col(order).alias("doc"), leaf.alias("digest"), F.monotonically_increasing_id().alias("row"), F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in (beside or {}).items()]).alias("beside"))
    staged(leaves, folder, "hashed")
    levels = _tree(spark.read.schema(leaves.schema).parquet(f"{folder}/hashed"), ["doc", "digest", "row"], folder, "parts", arity)
    subroots = spark.read.schema("part string, n long, digest string").parquet(f"{folder}/parts-roots")
    over = _tree(subroots.select(F.lit("").alias("part"), F.col("part").alias("of"), "digest"), ["of"], folder, "top", arity)
    staged(spark.createDataFrame([(arity, levels, over)], "arity int, levels int, top_levels int"), folder, "shape")
    keep_only(spark, folder, *[f"{t}-{k}" for t in ("parts", "top") for k in ("leaves", "links", "roots")], "shape")


def _paths(leaves: DataFrame, links: DataFrame, tops: DataFrame, levels: int, arity: int, payload: Sequence[str]) -> DataFrame:
    """Leaves' payload with their path to the top. tops: part, path, root: what is above each part's root.

    From the top down in subtrees of LEVELS levels: nodes at the lower edge of one are the tops of the next.
    """
    span = arity**LEVELS
    kinds = leaves.select("idx", *payload).schema

    def climb(links: dict[tuple[int, int], list[str]], low: int, above: list[dict]):
        """Paths of nodes at level low, by index; what is known of a parent is kept."""
        known: dict[tuple[int, int], list[dict]] = {}

        def path(level: int, idx: int) -> list[dict]:
            up, at = divmod(idx, arity)
            children = links.get((level + 1, up))
            if children is None:
                return above
            if (level + 1, up) not in known:
                known[level + 1, up] = path(level + 1, up)
            return [{"at": at, "siblings": children[:at] + children[at + 1 :]}, *known[level + 1, up]]

        return lambda idx: path(low, idx)

    def opened(right: pa.Table) -> tuple[dict, dict]:
        held, top = {}, None
        for row in right.to_pylist():
            if row["children"] is None:
                top = row
            else:
                held[row["level"], row["idx"]] = row["children"]
        return held, top

    def lower(low: int):
        def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
            held, top = opened(right)
            path = climb(held, low, top["path"])
            nodes = sorted(idx * arity + i for (level, idx), c in held.items() if level == low + 1 for i in range(len(c))) or [0]
            n = len(nodes)
            return pa.table([pa.array([key[0].as_py()] * n, pa.string()), pa.array(nodes, pa.int64()), pa.array([path(i) for i in nodes], pa.list_(_STEP)), pa.array([top["root"]] * n, pa.string()), pa.array([top["subroot"]] * n, pa.string())], ["part", "idx", "path", "root", "subroot"])

        return run

    def lowest(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        held, top = opened(right)
        path = climb(held, 0, top["path"])
        n = left.num_rows
        out = left.select([*payload]).append_column("part", pa.array([key[0].as_py()] * n, pa.string()))
        paths = pa.array([path(i) for i in left.column("idx").to_pylist()], pa.list_(_STEP))
        return out.append_column("path", paths).append_column("root", pa.array([top["root"]] * n, pa.string())).append_column("subroot", pa.array([top["subroot"]] * n, pa.string()))

    segments = -(-levels // LEVELS)
    tops = tops.withColumn("idx", F.lit(0).cast("long"))
    for k in reversed(range(max(1, segments))):
        low, high = k * LEVELS, (k + 1) * LEVELS
        within = links.where((F.col("level") > low) & (F.col("level") <= high))
        sub = F.floor(F.col("idx") / F.pow(F.lit(float(arity)), F.lit(high) - F.col("level"))).cast("long")
        none = lambda kind: F.lit(None).cast(kind)
        right = within.select("part", sub.alias("sub"), "level", "idx", "children", none(PATH).alias("path"), none("string").alias("root"), none("string").alias("subroot"))
        right = right.unionByName(tops.select("part", F.col("idx").alias("sub"), none("int").alias("level"), none("long").alias("idx"), none("array<string>").alias("children"), "path", "root", "subroot"))
        if k:
            left = tops.select("part", F.col("idx").alias("sub"))
            run, kind = lower(low), f"part string, idx long, path {PATH}, root string, subroot string"
        else:
            left = leaves.select("part", F.floor(F.col("idx") / span).cast("long").alias("sub"), "idx", *payload)
            run, kind = lowest, ", ".join(f"{c} {kinds[c].dataType.simpleString()}" for c in payload) + f", part string, path {PATH}, root string, subroot string"
        tops = left.groupBy("part", "sub").cogroup(right.groupBy("part", "sub")).applyInArrow(run, kind)
    return tops


def proofs(spark: SparkSession, folder: str) -> DataFrame:
    """Each leaf of a manifest: doc, digest, beside, part, subroot, root, and its path: per level its place `at` and its siblings from left to right."""
    arity, levels, over = spark.read.parquet(f"{folder}/shape").first()
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    empty = F.array().cast(PATH)
    root = read("top-roots").select("part", empty.alias("path"), F.col("digest").alias("root"), F.col("digest").alias("subroot"))
    subroots = _paths(read("top-leaves"), read("top-links"), root, over, arity, ["of", "digest"])
    tops = subroots.select(F.col("of").alias("part"), "path", "root", F.col("digest").alias("subroot"))
    return _paths(read("parts-leaves"), read("parts-links"), tops, levels, arity, ["doc", "digest", "beside"])


def siblings(path: Column) -> Column:
    """All siblings' digests of a path, from the leaf to the root and left to right, as one text."""
    return F.array_join(F.flatten(F.transform(path, lambda s: s["siblings"])), "")


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf's digest and its path give."""

    def up(node: Column, step: Column) -> Column:
        left, right = F.slice(step["siblings"], F.lit(1), step["at"]), F.slice(step["siblings"], step["at"] + 1, F.size(step["siblings"]))
        return F.sha2(F.concat(F.array_join(left, ""), node, F.array_join(right, "")), 256)

    return F.aggregate(path, leaf, up)


ORACLE = """
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384), i)) AS tab),
ids AS (SELECT DISTINCT doc_id, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda h: CAST(ascii(h) AS BIGINT)) AS bytes FROM documents WHERE doc_id IS NOT NULL),
crc AS (SELECT doc_id, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, tab[1 + (xor(c, x) & 255)]), CAST(4294967295 AS BIGINT)), 4294967295) AS crc FROM ids, tab),
f AS (SELECT d.doc_id, d.lang, coalesce(c.crc % 3 = 0, false) AS bad, d.text,
             coalesce(len(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
             || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(len(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
      FROM documents d LEFT JOIN crc c ON d.doc_id = c.doc_id),
l AS (SELECT doc_id, lang, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
             CASE WHEN bad THEN sha256(head || coalesce(octet_length(encode(text)) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
                  ELSE sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) END AS other FROM f),
p AS (SELECT *, coalesce('=' || lang, '') AS part, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM l),
t AS (SELECT part, 0 AS level, idx, n AS cnt, leaf AS node FROM p
      UNION ALL
      SELECT part, level + 1, idx // 8, (cnt + 7) // 8, sha256(string_agg(node, '' ORDER BY idx)) FROM t WHERE cnt > 1 GROUP BY part, level, idx // 8, cnt),
sub AS (SELECT part, node, row_number() OVER (ORDER BY encode(part)) - 1 AS idx, count(*) OVER () AS n FROM t WHERE cnt = 1),
u AS (SELECT 0 AS level, idx, n AS cnt, node FROM sub
      UNION ALL
      SELECT level + 1, idx // 8, (cnt + 7) // 8, sha256(string_agg(node, '' ORDER BY idx)) FROM u WHERE cnt > 1 GROUP BY level, idx // 8, cnt),
root AS (SELECT node FROM u WHERE cnt = 1),
runs AS (SELECT part, level, idx // 8 AS above, list(node ORDER BY idx) AS nodes FROM t WHERE cnt > 1 GROUP BY part, level, idx // 8),
top_runs AS (SELECT level, idx // 8 AS above, list(node ORDER BY idx) AS nodes FROM u WHERE cnt > 1 GROUP BY level, idx // 8),
climb AS (SELECT part, idx AS spot, 0 AS level, idx, other AS node, '' AS proof FROM p
      UNION ALL
      SELECT c.part, c.spot, c.level + 1, c.idx // 8,
             sha256(array_to_string(r.nodes[1:c.idx % 8], '') || c.node || array_to_string(r.nodes[c.idx % 8 + 2:], '')),
             c.proof || array_to_string(r.nodes[1:c.idx % 8], '') || array_to_string(r.nodes[c.idx % 8 + 2:], '')
      FROM climb c JOIN runs r ON r.part = c.part AND r.level = c.level AND r.above = c.idx // 8),
mid AS (SELECT c.part, c.spot, c.node, c.proof, s.idx, s.node AS subroot, row_number() OVER (PARTITION BY c.part, c.spot ORDER BY c.level DESC) AS rank FROM climb c JOIN sub s ON s.part = c.part),
over_ AS (SELECT part, spot, 0 AS level, idx, node, proof, subroot FROM mid WHERE rank = 1
      UNION ALL
      SELECT c.part, c.spot, c.level + 1, c.idx // 8,
             sha256(array_to_string(r.nodes[1:c.idx % 8], '') || c.node || array_to_string(r.nodes[c.idx % 8 + 2:], '')),
             c.proof || array_to_string(r.nodes[1:c.idx % 8], '') || array_to_string(r.nodes[c.idx % 8 + 2:], ''), c.subroot
      FROM over_ c JOIN top_runs r ON r.level = c.level AND r.above = c.idx // 8),
done AS (SELECT *, row_number() OVER (PARTITION BY part, spot ORDER BY level DESC) AS rank FROM over_)
SELECT p.doc_id, p.leaf, d.subroot, root.node AS root, sha256(d.proof) AS proof_sha256, d.node AS folded_root, d.node = root.node AS verified
FROM p JOIN done d ON d.part = p.part AND d.spot = p.idx AND d.rank = 1, root
"""
