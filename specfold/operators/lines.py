"""Science lines and artefacts in spectra: where a line is, how wide, whether there is one; spikes, excluded ranges, aligned means."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specfold.functions import arrays as A
from specfold.functions import kernels as K
from specfold.operators.kernel_ops import map_arrays
from specfold.operators.ranks import quantiles
from specfold.operators.spectra import average
from specfold.work import work_folder, written

METHODS = ("waterfall", "max", "centroid")


def group_means(rows: DataFrame, keys: Iterable[str], spectrum: str = "spectrum") -> DataFrame:
    """keys and the array of each channel's mean over a group's finite values."""
    keys = list(keys)
    long = average(rows, keys, spectrum)
    # one element a channel
    return long.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "mean"))), lambda p: p["mean"]).alias("mean"))


def line_channels(rows: DataFrame, keys: Iterable[str], method: str = "waterfall", kernel: int = 5, prominence: float = 5.0, spectrum: str = "spectrum") -> DataFrame:
    """For each group the channel of its science line, a confidence from 0 to 1, and the line's width at half its height over the median.

    waterfall: peak of the smoothed mean, confidence its height in deviations over `prominence`; max: the channel where
    most rows have their maximum, confidence their share; centroid: of the mean's positive part over its median, confidence 1.
    """
    if method not in METHODS:
        raise ValueError(f"no method {method}: {', '.join(METHODS)}")
    keys = list(keys)
    means = group_means(rows, keys, spectrum)
    if method == "max":
        tops = rows.select(*keys, A.argmax(spectrum).alias("channel")).where("channel is not null").groupBy(*keys, "channel").agg(F.count(F.lit(1)).alias("_n"))
        best = tops.groupBy(*keys).agg(F.max(F.struct("_n", -F.col("channel"))).alias("_b"), F.sum("_n").alias("_all"))
        at = best.select(*keys, (-F.col("_b.col2")).alias("_top"), (F.col("_b._n") / F.col("_all")).alias("_share"))
        means = means.join(at, keys)
    else:
        means = means.withColumns({"_top": F.lit(None).cast("int"), "_share": F.lit(None).cast("double")})

    def find(y: np.ndarray, top: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, ...]:
        found = [(int(t), float(s)) if method == "max" else K.detect_line(row[None, :], method, kernel, prominence) for row, t, s in zip(y, np.nan_to_num(top.astype(float)), share, strict=True)]
        return np.array([c for c, _ in found]), np.array([s for _, s in found]), np.array([K.width_at_half(row, c) for row, (c, _) in zip(y, found, strict=True)])

    return map_arrays(means, "mean", find, {"channel": "long", "confidence": "double", "width": "long"}, ("_top", "_share")).select(*keys, "channel", "confidence", "width")


def accepted(lines: DataFrame, least: float = 0.3, channels: tuple[int, int] | None = None) -> DataFrame:
    """Lines of enough confidence and inside the channels [first, last]: adds valid."""
    good = F.col("confidence") >= least
    if channels:
        good &= F.col("channel").between(*channels)
    return lines.withColumn("valid", good)


def despiked(rows: DataFrame, sigmas: float, spectrum: str = "spectrum") -> DataFrame:
    """Channels further than so many deviations from the row's mean become missing."""

    def blank(m: Column) -> Column:
        limit = sigmas * F.sqrt(m["m2"] / m["n"])
        return F.transform(A.as_doubles(spectrum), lambda x: F.when(A.is_finite(x) & (F.abs(x - m["mean"]) <= limit), x).otherwise(F.lit(A.NAN)))

    return rows.withColumn(spectrum, A.let(A.moments(spectrum), blank))


def without_range(rows: DataFrame, low: int, high: int, spectrum: str = "spectrum") -> DataFrame:
    """The channels outside [low, high), joined together."""
    return rows.withColumn(spectrum, A.where_index(spectrum, lambda i: (i < low) | (i >= high)))


def with_range(rows: DataFrame, low: int, high: int, value: float = 0.0, spectrum: str = "spectrum") -> DataFrame:
    """Undoes without_range, with a constant in the range."""
    a = A.as_doubles(spectrum)
    return rows.withColumn(spectrum, F.concat(F.slice(a, 1, low), F.array_repeat(F.lit(float(value)), high - low), F.slice(a, low + 1, F.greatest(F.lit(0), F.size(a) - low))))


def with_line_test(rows: DataFrame, window: tuple[int, int], sigmas: float, spectrum: str = "spectrum") -> DataFrame:
    """Adds has_line: the window's mean exceeds so many deviations of a mean of as many channels elsewhere."""
    inside = A.where_index(spectrum, lambda i: (i >= window[0]) & (i < window[1]))
    outside = A.where_index(spectrum, lambda i: (i < window[0]) | (i >= window[1]))
    return rows.withColumn("has_line", A.mean(inside) > sigmas * A.std(outside) / float(np.sqrt(window[1] - window[0])))


def enveloped(rows: DataFrame, order: int = 3, rounds: int = 20, spectrum: str = "spectrum") -> DataFrame:
    """Spectra less the polynomial below them."""
    return map_arrays(rows, spectrum, lambda y: y - K.lower_envelope(y, order, rounds), {spectrum: "array<double>"})


def peak_places(rows: DataFrame, spectrum: str = "spectrum") -> DataFrame:
    """Adds peak: the place of each row's maximum by a parabola through three channels."""
    return map_arrays(rows, spectrum, K.parabola_peaks, {"peak": "double"})


def aligned_mean(rows: DataFrame, keys: Iterable[str] = (), spectrum: str = "spectrum") -> DataFrame:
    """keys, pos, mean, n: the mean of a group's rows, shifted by parts of channels so that their peaks meet at the group's median peak.

    The median is found in rounds of histograms and the mean is made of partial sums, so a group may have any number of rows.
    """
    keys = list(keys)
    placed = peak_places(rows.select(*keys, A.as_doubles(spectrum).alias("_s")), "_s")
    placed = written(placed, f"{work_folder(rows.sparkSession)}/placed")
    middle = quantiles(placed, "peak", (0.5,), keys).select(*keys, F.col("values")[0].alias("_m"))
    both = placed.join(middle, keys) if keys else placed.withColumn("_m", A.scalar(middle))
    moved = map_arrays(both, "_s", lambda y, peak, m: K.moved_rows(y, peak - m), {"_s": "array<double>"}, ("peak", "_m"))
    return average(moved, keys, "_s").select(*keys, "pos", "mean", "n")


def component_statistics(models: DataFrame) -> DataFrame:
    """models: mission_id, telescop, components, ratio. For each component: component (from 0), amplitude (largest size), rms, cumulative (share of the variance up to it)."""
    long = models.select("mission_id", "telescop", "ratio", F.posexplode("components").alias("component", "_c"))
    upto = F.aggregate(F.slice("ratio", F.lit(1), F.col("component") + 1), F.lit(0.0), lambda a, x: a + x)
    return long.select("mission_id", "telescop", "component", F.array_max(F.transform("_c", lambda x: F.abs(x))).alias("amplitude"), A.rms("_c").alias("rms"), upto.alias("cumulative"))
