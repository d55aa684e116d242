"""Shards of nearly equal bytes, by sampled splitters; DataFrame functions only.

Records are ordered by a key (by default a hash of the text, so that equal texts stand together and shards are
random draws of the corpus), then doc_id, then their row. Samples of the keys are drawn with a chance in proportion to a record's size;
their quantiles split the order into ranges of about equal bytes, and ranges that turn out overfull, such as that of a
text which fills a third of the table, are subdivided by samples of their own. Sums over whole ranges and within
each then give every record its exact place in the order. Shards follow: a record belongs to the shard that holds
the middle of its bytes, and a group of equal keys of at most `whole_share` of a shard goes with its own middle, as a whole. So a shard differs from an even
share by at most one record or one such group, whatever the samples were: they decide how work is split, not the result.

write() puts each shard into a folder of its own (shard=0, ...); slot numbers its records from 0. The texts
move once. Samples hold `samples` keys for each range in the mean, ranges number 16 a shard or one for each `range_bytes`, and nothing but
the splitters (a key a range) and the shards' first places passes through the driver.

A record's size is the UTF-8 bytes of its text and 1 more, so null and empty texts count too. A null doc_id comes first among
equal keys. Texts of any length are one record. Repeated rows are records of their own; which of two equal ones comes first is not
fixed. An empty table gives empty shards. Further columns travel in a struct, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from specfold.llm.common import drop_path, session_of, staged

RANGES_A_SHARD = 16
#: A range with this many times the mean of rows or bytes is subdivided.
OVERFULL = 4
ORDER = ("key", "doc", "row")


def text_key(text: Column) -> Column:
    """60 bits of the SHA-256 of a text; null counts as empty."""
    return F.conv(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 15), 16, 10).cast("long")


def position(sorted_values: Column, value: Column, n: int) -> Column:
    """How many of at most n ascending values are not above a value: a binary search."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, n.bit_length())))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(sorted_values, at + step - 1) <= value, at + step).otherwise(at))


def _drawn(rows: DataFrame, for_each_byte: Column) -> DataFrame:
    """Rows drawn with a chance of size x for_each_byte, with the bytes that each stands for."""
    u = F.pmod(F.xxhash64(*ORDER), F.lit(1 << 40)) / float(1 << 40)
    return rows.where(u < F.col("size") * for_each_byte).withColumn("weight", F.greatest(F.col("size").cast("double"), 1 / for_each_byte))


def _quantiles(drawn: DataFrame, parts: Column, by: list[str]) -> DataFrame:
    """The first drawn place, as a struct `cut`, of each but the first of `parts` bins of equal weight, within each `by`."""
    all_, order = Window.partitionBy(*by), Window.partitionBy(*by).orderBy(*ORDER)
    before = F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("weight")
    binned = drawn.withColumn("bin", F.floor(before * parts / F.sum("weight").over(all_)))
    return binned.where("bin > 0").groupBy(*by, "bin").agg(F.min(F.struct(*ORDER)).alias("cut"))


def write(docs: DataFrame, folder: str, shards: int = 16, key: Column | None = None, whole_share: float = 1 / 32, range_bytes: int = 1 << 30, samples: int = 32) -> None:
    """docs: doc_id, text and any others. Writes folder/shards, and folder/layout: shard, first, rows, bytes."""
    if shards < 1:
        raise ValueError(f"no such number of shards: {shards}")
    spark = session_of(docs)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    keys = text_key(F.col("text")) if key is None else key
    named = docs.select(keys.alias("key"), F.col("doc_id").cast("long").alias("doc"), F.monotonically_increasing_id().alias("row"), size.alias("size"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"))
    records = staged(named, folder, "records")
    narrow = records.select(*ORDER, "size")
    rows, total = records.agg(F.count(F.lit(1)), F.sum("size")).first()
    staged(records.limit(0).select("record", "size", F.lit(0).cast("long").alias("slot")), folder, "schema")
    ranges = max(RANGES_A_SHARD * shards, math.ceil((total or 0) / range_bytes))

    # ranges by quantiles of the keys
    cuts: list = []
    if rows:
        first = _quantiles(_drawn(narrow, F.lit(samples * ranges / total)), F.lit(ranges), [])
        cuts = [r[0] for r in first.select("cut.key").where("key is not null").distinct().sort("key").collect()]
    splitters = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<long>")
    in_range = lambda df: df.withColumn("range", position(splitters, F.col("key"), len(cuts)))

    # overfull ranges by quantiles of whole places; a cut stands inside a group of equal keys only where the group is not kept whole
    whole = whole_share * (total or 0) / shards
    sums = [F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")]
    parts = F.ceil(F.greatest(F.col("rows") * ranges / max(1, rows), F.col("bytes") * ranges / max(1, total or 0)))
    over = staged(in_range(narrow).groupBy("range").agg(*sums).withColumn("parts", parts).where((F.col("parts") > OVERFULL) & (F.col("rows") > 1)), folder, "overfull")
    crowded = in_range(narrow).join(F.broadcast(over), "range")
    hot = staged(crowded.groupBy("key").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > whole).select("key", F.lit(True).alias("hot")), folder, "hot")  # fewer than shards / whole_share
    marks = F.broadcast(hot.withColumnRenamed("key", "_key"))
    marked = lambda df: df.join(marks, F.col("key").eqNullSafe(F.col("_key")), "left").drop("_key")
    inner = _quantiles(_drawn(crowded, samples * F.col("parts") / F.col("bytes")), F.col("parts"), ["range"]).withColumn("key", F.col("cut.key"))
    at = F.when(F.col("hot"), F.col("cut")).otherwise(F.struct("key", F.lit(None).cast("long").alias("doc"), F.lit(None).cast("long").alias("row")))
    inner = marked(inner).groupBy("range").agg(F.array_sort(F.collect_set(at)).alias("cuts"))
    inner = staged(inner, folder, "inner")
    most = inner.agg(F.max(F.size("cuts"))).first()[0] or 0
    sub = F.when(F.col("cuts").isNull(), 0).otherwise(position(F.col("cuts"), F.struct(*ORDER), most))
    located = lambda df: in_range(df).join(F.broadcast(inner), "range", "left").withColumn("sub", sub).drop("cuts")

    # places: sums over ranges before, and within
    before = Window.orderBy("range", "sub").rowsBetween(Window.unboundedPreceding, -1)
    base = located(narrow).groupBy("range", "sub").agg(*sums)
    base = base.select("range", "sub", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("rows", "bytes")])
    base = staged(base, folder, "base")
    order, group = Window.partitionBy("range", "sub").orderBy(*ORDER), Window.partitionBy("range", "sub", "key")
    place = (F.col("rows_before") + F.row_number().over(order) - 1).alias("place")
    begin = F.col("bytes_before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = marked(located(narrow).join(F.broadcast(base), ["range", "sub"]))
    placed = placed.select("range", "sub", *ORDER, "size", "hot", place, begin.alias("begin"))
    placed = placed.select("place", "size", "hot", "begin", F.sum("size").over(group).alias("_bytes"), F.min("begin").over(group).alias("_begin"))
    alone = F.coalesce(F.col("hot"), F.lit(False)) | (F.col("_bytes") > whole)
    twice_middle = F.when(alone, 2 * F.col("begin") + F.col("size")).otherwise(2 * F.col("_begin") + F.col("_bytes"))
    shard = F.expr(f"_middle * {shards} div {2 * max(1, total or 0)}").cast("int")
    layout = placed.withColumn("_middle", twice_middle).groupBy(F.least(shard, F.lit(shards - 1)).alias("shard")).agg(F.min("place").alias("first"), *sums)
    layout = staged(layout, folder, "layout")
    firsts = sorted((r["first"], r["shard"]) for r in layout.collect())

    # texts to their places
    known = position(F.array(*[F.lit(f) for f, _ in firsts]).cast("array<long>"), F.col("place"), len(firsts)) - 1
    moved = located(records).join(F.broadcast(base), ["range", "sub"]).select("record", "size", "range", "sub", *ORDER, place)
    moved = moved.withColumn("_at", known)
    pick = lambda values, kind: F.get(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("_at"))
    moved = moved.select("record", "size", (F.col("place") - pick([f for f, _ in firsts], "long")).alias("slot"), pick([s for _, s in firsts], "int").alias("shard"))
    moved.write.mode("overwrite").option("compression", "zstd").partitionBy("shard").parquet(f"{folder}/shards")
    for name in ("records", "overfull", "hot", "inner", "base"):
        drop_path(spark, f"{folder}/{name}")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """What write() put: record (the documents' columns), size, slot, shard."""
    schema = spark.read.parquet(f"{folder}/schema").schema
    return spark.read.schema(schema.add("shard", "integer")).parquet(f"{folder}/shards")


ORACLE = """
WITH b AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384), i)) AS tab),
v AS (SELECT doc_id, coalesce(text, '') AS t, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes FROM documents),
d AS (SELECT doc_id, CAST(len(bytes) + 1 AS BIGINT) AS size, CAST('0x' || substr(sha256(t), 1, 15) AS BIGINT) AS k,
             xor(list_reduce(bytes, lambda c, x: xor(c >> 8, tab[1 + (xor(c, x) & 255)]), CAST(4294967295 AS BIGINT)), 4294967295) AS crc FROM v, b),
r AS (SELECT *, CAST(sum(size) OVER (ORDER BY k, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS a,
             CAST(sum(size) OVER () AS BIGINT) AS total, CAST(sum(size) OVER (PARTITION BY k) AS BIGINT) AS g FROM d),
s AS (SELECT *, min(a) OVER (PARTITION BY k) AS ga FROM r),
p AS (SELECT *, least(15, CASE WHEN g > total / 512 THEN (2 * a + size) * 16 // (2 * total) ELSE (2 * ga + g) * 16 // (2 * total) END) AS shard FROM s)
SELECT doc_id, size, CAST(crc AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY k, doc_id NULLS FIRST) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM p
"""
