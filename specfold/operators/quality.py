"""Statistics and quality figures: value counts, moments, histograms, radiometer noise, robust flags."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specfold.functions.arrays import is_finite, scalar
from specfold.operators.ranks import quantiles

C_LIGHT = 299792458.0
#: A median absolute deviation times this is a normal deviation.
MAD = 1.4826


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def mission_scans(rows: DataFrame) -> DataFrame:
    """Rows and distinct scans of each mission, the scans listed in text order."""
    once = rows.groupBy("mission_id", "scan").agg(F.count(F.lit(1)).alias("n"))
    listed = F.array_join(F.array_sort(F.collect_list(F.col("scan").cast("string"))), ",")
    return once.groupBy("mission_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_scans"), listed.alias("scans"))


def top_values(rows: DataFrame, column: str, most: int) -> DataFrame:
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(most)


def metric_stats(rows: DataFrame, column: str, keys: Iterable[str] = ()) -> DataFrame:
    """Count, mean, median, population deviation, extremes and 5 and 95 % points of the finite values. Percentiles are exact."""
    keys = list(keys)
    good = rows.where(is_finite(F.col(column).cast("double")))
    sums = good.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"), F.min(column).alias("least"), F.max(column).alias("most"))
    points = quantiles(good, column, (0.05, 0.5, 0.95), keys).select(*[F.col(k).alias(f"_{k}") for k in keys], "values")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    both = sums.join(points, same, "left") if keys else sums.withColumn("values", scalar(points))
    at = lambda i: F.col("values")[i]
    return both.select(*keys, "n", "mean", at(1).alias("median"), "std", "least", "most", at(0).alias("p5"), at(2).alias("p95"))


def metric_table(rows: DataFrame, scalars: Iterable[str] = (), arrays: Iterable[str] = ()) -> DataFrame:
    """metric_stats of several columns at once, a row each named by metric; of an array column the mean of each row's finite elements counts. Columns that the table lacks are left out."""
    from specfold.functions.arrays import mean

    parts = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in scalars if c in rows.columns]
    parts += [F.struct(F.lit(c).alias("metric"), mean(c).alias("value")) for c in arrays if c in rows.columns]
    return metric_stats(rows.select(F.inline(F.array(*parts))), "value", ["metric"])


def value_census(rows: DataFrame, spectrum: str = "spectrum", tiny: float = 1e-10, keys: Iterable[str] = ()) -> DataFrame:
    """Of all channels: how many, not finite, zero, negative, tiny but not zero; mean, deviation and extremes of the finite ones."""
    x = F.col("_x")
    good = is_finite(x)
    long = rows.select(*keys, F.explode(F.col(spectrum).cast("array<double>")).alias("_x"))
    own = F.when(good, x)
    return long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(~good).alias("n_missing"), F.count_if(good & (x == 0)).alias("n_zero"), F.count_if(good & (x < 0)).alias("n_negative"), F.count_if(good & (x != 0) & (F.abs(x) < tiny)).alias("n_tiny"), F.avg(own).alias("mean"), F.stddev_pop(own).alias("std"), F.min(own).alias("least"), F.max(own).alias("most"))


def histogram(rows: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal bins over the range of finite values, the last bin closed: bin, low, high, n."""
    good = rows.select(F.col(column).cast("double").alias("x")).where(is_finite(F.col("x")))
    span = scalar(good.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))))
    step = (F.col("hi") - F.col("lo")) / bins
    bin_ = F.when(step > 0, F.least(F.lit(bins - 1), F.floor((F.col("x") - F.col("lo")) / step).cast("int"))).otherwise(0)
    joined = good.withColumn("_span", span).select("x", "_span.lo", "_span.hi")
    return joined.groupBy(bin_.alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("n")).select("bin", (F.col("lo") + F.col("bin") * step).alias("low"), (F.col("lo") + (F.col("bin") + 1) * step).alias("high"), "n")


def cumulative_counts(rows: DataFrame, column: str, bounds: Sequence[float]) -> DataFrame:
    """How many values are at or below each bound, in one pass."""
    sums = rows.agg(*[F.count_if(F.col(column) <= b).alias(f"_{i}") for i, b in enumerate(bounds)])
    pairs = F.array(*[F.struct(F.lit(float(b)).alias("bound"), F.col(f"_{i}").alias("n")) for i, b in enumerate(bounds)])
    return sums.select(F.inline(pairs))


def theoretical_rms(tsys: Column, on: Column, off: Column, tau: Column, elevation: Column, deltav: Column, restfreq: Column) -> Column:
    """Radiometer noise of a channel; NaN without a width or time on source."""
    width = F.abs(deltav) / C_LIGHT * restfreq
    sine = F.sin(F.radians(elevation))
    opacity = F.when((tau > 0) & (sine > 0), F.exp(tau / sine)).otherwise(1.0)
    sigma = tsys / F.sqrt(width) * F.sqrt(1 / on + F.when(off > 0, 1 / off).otherwise(0.0)) * opacity
    return F.when((width > 0) & (on > 0), sigma).otherwise(F.lit(float("nan")))


def mad_flags(rows: DataFrame, column: str, sigmas: float, flag: str = "flag", least_rows: int = 0) -> DataFrame:
    """Adds `threshold` = median + sigmas * 1.4826 * MAD of the finite values, and whether a value is above it. The medians are exact and found in rounds; each of the two reads the rows once: write costly rows to a stage first."""
    good = rows.where(is_finite(F.col(column))).select(F.col(column).alias("_x"))
    middle = scalar(quantiles(good, "_x", (0.5,)).select(F.struct(F.col("values")[0].alias("m"), "n")))
    spread = scalar(quantiles(good, F.abs(F.col("_x") - middle["m"]), (0.5,)).select(F.col("values")[0]))
    out = rows.withColumn("threshold", F.when(middle["n"] >= least_rows, middle["m"] + sigmas * MAD * spread))
    return out.withColumn(flag, F.coalesce(is_finite(F.col(column)) & (F.col(column) > F.col("threshold")), F.lit(False)))
