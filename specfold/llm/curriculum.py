"""Mixing sources to target weights along a time-varying curriculum.

Sources in code point order (null last) get the weights in turn and share the total size by them;
a target stops at max_repeats times its source's size and the excess is shared by weight among
the rest, until none is above. A source's documents stand in an order that a hash of doc_id
decides, once for each epoch; they are taken while the words before them are fewer than the
target, and the one that reaches it is cut there. So a source's words are its target, rounded,
and no document is taken more than max_repeats times.

Each source's weight changes over training time by a schedule of straight lines. The schedule,
integrated and scaled to the target, is its cumulative demand; the inverse of that at the number
of words taken before gives a document's position in training (0 to 1), and a range sort by
position gives the training order.

Sums within a source are taken over buckets of the hash first, so that a source with most rows
is spread over as many tasks as it has buckets. The table of sources, one row each, meets in one
task. Size: words, runs of characters other than U+0020 and U+0009 to U+000D; null and empty
texts have size 0 and are never taken. Rows of equal doc_id stand by size and text hash, a null
doc_id hashes as empty text; repeated rows count each. An empty table gives no rows. Columns
that have the names of added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)
#: Knots (time, weight) for the sources in turn: rising, even, falling.
SCHEDULES = (((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)))
WORD = r"[^\x20\x09-\x0D]+"


def inverse_demand(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time at which the integral of the schedule reaches this share of its whole."""
    areas = [(a[1] + b[1]) / 2 * (b[0] - a[0]) for a, b in zip(knots, knots[1:], strict=False)]
    whole, done, out = sum(areas), 0.0, None
    for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas, strict=False):
        rest = share * whole - done
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(0.0), w0 * w0 + 2 * slope * rest))
        here = F.least(F.lit(t1), t0 + F.when(rest <= 0, 0.0).otherwise(2 * rest / (w0 + root)))
        done += area
        out = F.when(share * whole <= done, here) if out is None else out.when(share * whole <= done, here)
    return out.otherwise(F.lit(knots[-1][0]))


def _source_key() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))


def targets(sized: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """sized: _source, _size. One row a source: _source, _turn (its place), source_size, target."""
    own = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    name = F.when(F.col("_source").startswith("s"), F.substr("_source", F.lit(2)))
    place = F.row_number().over(Window.orderBy(name.asc_nulls_last())) - 1
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("_turn") % len(weights) + 1).cast("int")).cast("long")
    rows = own.withColumn("_turn", place).withColumn("_w", w).withColumn("_cap", max_repeats * F.col("source_size"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "_turn").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_left", F.sum("source_size").over(everything) - F.sum("_cap").over(order) + F.col("_cap"))
    rows = rows.withColumn("_weights", F.sum("_w").over(everything) - F.sum("_w").over(order) + F.col("_w"))
    rows = rows.withColumn("_free", F.col("_left") * F.col("_w") <= F.col("_cap") * F.col("_weights"))
    first = F.min(F.when(F.col("_free"), F.struct(F.col("_cap") / F.col("_w"), F.col("_turn"), F.col("_left"), F.col("_weights")))).over(everything)
    level = rows.withColumn("_level", first)
    shared = (F.col("_level._left") * F.col("_w")).cast("double") / F.col("_level._weights").cast("double")
    return level.select("_source", "_turn", "source_size", F.when(F.col("_free"), shared).otherwise(F.col("_cap").cast("double")).alias("target"))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, schedules: tuple = SCHEDULES, max_repeats: int = 3, digits: int = 3) -> DataFrame:
    """docs: doc_id, text, source and more. All rows and columns, with size, source_size, target, taken and copies (array of epoch, words, position).

    digits: hexadecimal digits of the hash that make a bucket.
    """
    kept = docs.drop("size", "source_size", "target", "taken", "copies")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = kept.withColumns({"_source": _source_key(), "_size": F.regexp_count(text, F.lit(WORD)).cast("long"), "_hash": F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), "_tie": F.xxhash64(text)})
    rows = rows.withColumn("_bucket", F.substring("_hash", 1, digits))
    # read twice, for the order and for the targets, but made once: both have the same exchange
    buckets = rows.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_sum")
    goal = targets(buckets.select("_source", F.col("_sum").alias("_size")), weights, max_repeats)
    starts = buckets.select("_source", "_bucket", before.alias("_before")).join(goal, "_source")
    inside = Window.partitionBy("_source", "_bucket").orderBy("_hash", F.col("doc_id"), "_size", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(starts, ["_source", "_bucket"]).withColumn("_start", F.col("_before") + F.sum("_size").over(inside) - F.col("_size"))
    quota = F.floor(F.col("target") + 0.5).cast("long")

    def copy(epoch: Column) -> Column:
        start = F.col("_start") + epoch * F.col("source_size")
        share = start / F.greatest(quota, F.lit(1))
        position = F.lit(None).cast("double")
        for i, knots in enumerate(schedules):
            position = F.when(F.col("_turn") % len(schedules) == i, inverse_demand(share, knots)).otherwise(position)
        return F.struct(epoch.cast("int").alias("epoch"), F.greatest(F.lit(0), F.least(F.col("_size"), quota - start)).alias("words"), position.alias("position"))

    copies = F.filter(F.transform(F.array(*[F.lit(e).cast("long") for e in range(max_repeats)]), copy), lambda c: c["words"] > 0)
    rows = rows.withColumn("copies", copies)
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    return rows.select(*kept.columns, F.col("_size").alias("size"), "source_size", "target", taken.alias("taken"), "copies")


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: a row for each copy of a document in training order, with epoch, words and position; text cut to words where the target ends."""
    rows = plan(docs, **how)
    names = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken", "copies", "epoch", "words", "position")]
    rows = rows.select(*names, F.col("size").alias("_size"), F.explode("copies").alias("_c")).select(*names, "_size", "_c.*")
    parts = F.slice(F.regexp_extract_all("text", F.lit(rf"([\x20\x09-\x0D]*{WORD})"), F.lit(1)), 1, F.col("words").cast("int"))
    cut = rows.withColumn("text", F.when(F.col("words") < F.col("_size"), F.array_join(parts, "")).otherwise(F.col("text")))
    return cut.drop("_size").orderBy("position", "epoch", "doc_id")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS w,
             row_number() OVER (ORDER BY source NULLS LAST) AS turn, 3 * source_size AS cap FROM s),
c AS (SELECT *, CAST(sum(source_size) OVER () - sum(cap) OVER o + cap AS BIGINT) AS rest,
                CAST(sum(w) OVER () - sum(w) OVER o + w AS BIGINT) AS weights
      FROM r WINDOW o AS (ORDER BY cap / w, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
f AS (SELECT rest AS l_rest, weights AS l_weights FROM c WHERE rest * w <= cap * weights ORDER BY cap / w, turn LIMIT 1),
t AS (SELECT source, source_size, turn,
             CASE WHEN rest * w <= cap * weights THEN CAST(l_rest * w AS DOUBLE) / CAST(l_weights AS DOUBLE)
                  ELSE CAST(cap AS DOUBLE) END AS target
      FROM c CROSS JOIN f),
o AS (SELECT doc_id, size, source_size, target, turn, CAST(floor(target + 0.5) AS BIGINT) AS quota,
             CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS BIGINT) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
w AS (SELECT *, greatest(0, least(size, quota - start)) AS w0, greatest(0, least(size, quota - start - source_size)) AS w1,
             greatest(0, least(size, quota - start - 2 * source_size)) AS w2,
             CAST(start AS DOUBLE) / CAST(greatest(quota, 1) AS DOUBLE) AS share FROM o)
SELECT doc_id, size, source_size, target, w0 + w1 + w2 AS taken,
       CAST((w0 > 0) AS BIGINT) + CAST((w1 > 0) AS BIGINT) + CAST((w2 > 0) AS BIGINT) AS n_copies,
       CASE WHEN w0 <= 0 THEN NULL
            WHEN share <= 0 THEN 0.0::DOUBLE
            WHEN turn % 3 = 1 THEN 2.0::DOUBLE * share / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2.0::DOUBLE * share))
            WHEN turn % 3 = 2 THEN share
            WHEN share <= 0.625::DOUBLE THEN 2.0::DOUBLE * share / (1.5::DOUBLE + sqrt(2.25::DOUBLE - 2.0::DOUBLE * share))
            ELSE 0.5::DOUBLE + 2.0::DOUBLE * (share - 0.625::DOUBLE) / (1.0::DOUBLE + sqrt(1.0::DOUBLE - 2.0::DOUBLE * (share - 0.625::DOUBLE)))
       END AS position
FROM w
"""
