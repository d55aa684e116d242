"""Exact quantiles of groups of any size, by rounds of refined histograms.

A round counts the values of a group in bins between the least and the largest value that a wanted rank may be: in equal bins, and every
second time in powers of two if these differ in sign or by more than a factor, so that some ten rounds end any search. Counts, minima and maxima
meet map-side. Of each bin that holds a wanted rank its values alone are kept for the next round, whose range is that of the values
found in it. A rank is known when its bin holds one value, however often; bins of at most `most` values are sorted as they are. So no task
ever holds a group's values, and each round reads a small part of the one before.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specfold.functions.arrays import is_finite
from specfold.work import work_folder, written

#: So many values of a bin at most are sorted in one row.
MOST = 10_000
BINS = 512


def _within(values: DataFrame, spans: DataFrame) -> DataFrame:
    """Values that lie in a span of their group, with the span; the spans of a group are disjoint."""
    own = spans.select(F.col("g").alias("_g"), "lo", "hi", "below", "n", "ranks")
    return values.join(own, F.col("g").eqNullSafe(F.col("_g")) & (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi"))).drop("_g")


def _sorted_out(joined: DataFrame) -> DataFrame:
    """Values of the ranks of spans that are sorted whole."""
    listed = joined.groupBy("g", "below").agg(F.array_sort(F.collect_list("x")).alias("_xs"), F.first("ranks").alias("ranks"))
    ranked = listed.select("g", "below", "_xs", F.explode("ranks").alias("rank"))
    return ranked.select("g", "rank", F.get("_xs", (F.col("rank") - F.col("below")).cast("int")).alias("value"))


def _refined(joined: DataFrame, bins: int, powers: bool) -> DataFrame:
    """The bins of spans that hold wanted ranks, as spans."""
    scale = F.when(F.greatest(F.abs("lo"), F.abs("hi")) > 1, 0.5).otherwise(1.0)  # differences of halves cannot overflow, those of small numbers not vanish
    part = lambda c: F.col(c) * scale
    even = F.least(F.floor((part("x") - part("lo")) / (part("hi") - part("lo")) * bins), F.lit(bins - 1)).cast("int")
    power = F.when(F.col("x") == 0, 0).otherwise(F.signum("x") * (F.floor(F.log2(F.abs("x"))) + 1100)).cast("int")
    far = (F.signum("lo") != F.signum("hi")) | (F.greatest(F.abs("lo"), F.abs("hi")) / 4 > F.least(F.abs("lo"), F.abs("hi")))
    place = F.when(far, power).otherwise(even) if powers else even
    sums = joined.groupBy("g", "below", "ranks", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    before = F.sum("n").over(Window.partitionBy("g", "below").orderBy("bin")) - F.col("n") + F.col("below")
    inside = lambda r: (r >= F.col("from")) & (r < F.col("from") + F.col("n"))
    found = sums.withColumn("from", before).withColumn("ranks", F.filter("ranks", inside)).where(F.size("ranks") > 0)
    return found.select("g", "lo", "hi", F.col("from").alias("below"), "n", "ranks")


def quantiles(rows: DataFrame, column: str | Column, shares: Sequence[float], keys: Iterable[str] = (), folder: str | None = None, most: int = MOST, bins: int = BINS) -> DataFrame:
    """Exact quantiles of a column's finite values, interpolated between neighbours: the keys, n, and values, one for each share.

    Groups without finite values have no row. Null keys are a group of their own.
    """
    spark, keys = rows.sparkSession, list(keys)
    folder = folder or work_folder(spark)
    x = (F.col(column) if isinstance(column, str) else column).cast("double")
    group = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_"))
    values = written(rows.select(group.alias("g"), (x + 0.0).alias("x")).where(is_finite(F.col("x"))), f"{folder}/values")
    at = lambda p: (F.col("n") - 1) * F.lit(float(p))
    wanted = F.array_distinct(F.array(*[f(at(p)).cast("long") for p in shares for f in (F.floor, F.ceil)]))
    whole = values.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    spans = written(whole.select("g", "lo", "hi", F.lit(0).cast("long").alias("below"), "n", wanted.alias("ranks")), f"{folder}/spans-0")
    sizes, found, turn = spans.select("g", "n"), [], 0
    while True:
        found.append(spans.where("lo = hi").select("g", F.explode("ranks").alias("rank"), F.col("lo").alias("value")))
        joined = _within(values, spans.where("lo < hi"))
        found.append(_sorted_out(joined.where(F.col("n") <= most)))
        if spans.where((F.col("lo") < F.col("hi")) & (F.col("n") > most)).isEmpty():
            break
        turn += 1
        spans = written(_refined(joined.where(F.col("n") > most), bins, turn % 2 == 0), f"{folder}/spans-{turn}")
        values = written(_within(values, spans.where("lo < hi")).select("g", "x"), f"{folder}/values-{turn}")
    ranked = reduce(DataFrame.unionByName, found).groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_v"))
    both = sizes.alias("s").join(ranked.alias("r"), F.col("s.g").eqNullSafe(F.col("r.g"))).select("s.g", "n", "_v")

    def value(p: float) -> Column:
        low, high = (F.element_at("_v", f(at(p)).cast("long")) for f in (F.floor, F.ceil))
        return F.when(low == high, low).otherwise((F.ceil(at(p)) - at(p)) * low + (at(p) - F.floor(at(p))) * high)

    return both.select(*[F.col("g")[k].alias(k) for k in keys], "n", F.array(*[value(p) for p in shares]).alias("values"))
