"""Where channels stand: reference pixels with their fallbacks, velocity windows, masks by window, and the grids of tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specfold.functions import arrays as A

#: Velocities beyond this size are in m/s, others in km/s.
LARGEST_KMS = 10_000.0


def with_reference_pixel(rows: DataFrame, headers: DataFrame | None = None, key: str = "file", column: str = "crpix1", most_broadcast: int = 100_000) -> DataFrame:
    """The row's own reference pixel, else that of its file's header, else 1. headers: the key and the column."""
    own = F.col(column) if column in rows.columns else F.lit(None).cast("double")
    own = F.when(A.is_finite(own.cast("double")), own)
    if headers is None:
        return rows.withColumn(column, F.coalesce(own, F.lit(1.0)))
    few = headers.select(key, F.when(A.is_finite(F.col(column).cast("double")), F.col(column)).alias("_head"))
    few = F.broadcast(few) if few.limit(most_broadcast + 1).count() <= most_broadcast else few
    return rows.withColumn("_own", own).drop(column).join(few, key, "left").withColumn(column, F.coalesce("_own", "_head", F.lit(1.0))).drop("_own", "_head")


def spectral_parameters(rows: DataFrame, names: Iterable[str] = ("velocity", "deltav", "crpix1", "restfreq"), headers: Mapping[str, float] | None = None, row_id: str = "row_id") -> DataFrame:
    """One row: of each parameter the value of the first row (by row_id) that has one, else the header's, else null (reference pixel: 1)."""
    headers = headers or {}
    there = [n for n in names if n in rows.columns]
    found = rows.agg(*[F.min_by(n, F.when(A.is_finite(F.col(n).cast("double")), F.col(row_id))).alias(n) for n in there]) if there else rows.agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    default = lambda n: F.lit(headers.get(n, 1.0 if n == "crpix1" else None)).cast("double")
    return found.select(*[F.coalesce(F.col(n).cast("double"), default(n)).alias(n) if n in there else default(n).alias(n) for n in names])


def in_unit_of(value: Column | float, axis_end: Column) -> Column:
    """A velocity in the unit of an axis: km/s become m/s if the axis is in m/s, and the other way round."""
    v = value if isinstance(value, Column) else F.lit(float(value))
    return F.when((F.abs(axis_end) > LARGEST_KMS) & (F.abs(v) <= LARGEST_KMS), v * 1000).when((F.abs(axis_end) <= LARGEST_KMS) & (F.abs(v) > LARGEST_KMS), v / 1000).otherwise(v)


def window_channels(rows: DataFrame, low: Column | float, high: Column | float, spectrum: str = "spectrum") -> DataFrame:
    """Adds ch_first and ch_last: the channels nearest to both ends of a velocity window, cut to the band. Axes may descend; the window may be in km/s or m/s."""
    n = F.size(spectrum)
    end = F.greatest(F.abs("velocity"), F.abs(F.col("velocity") + (n - 1) * F.col("deltav")))
    at = lambda v: F.greatest(F.lit(0), F.least(n - 1, A.channel_of(in_unit_of(v, end), "velocity", "deltav", "crpix1")))
    out = rows.withColumns({"_a": at(low), "_b": at(high)})
    return out.withColumns({"ch_first": F.least("_a", "_b"), "ch_last": F.greatest("_a", "_b")}).drop("_a", "_b")


def uniformity(rows: DataFrame, keys: Iterable[str] = (), velocity: str = "velocity", deltav: str = "deltav") -> DataFrame:
    """For each group the spread of its reference velocities in channels and of its channel widths, relative; and whether it has one grid (a tenth of a channel, 1e-3)."""
    s = rows.groupBy(*keys).agg((F.max(velocity) - F.min(velocity)).alias("_v"), F.max(deltav).alias("_hi"), F.min(deltav).alias("_lo"))
    out = s.select(*keys, (F.col("_v") / F.abs("_hi")).alias("shift"), ((F.col("_hi") - F.col("_lo")) / F.abs("_hi")).alias("stretch"))
    return out.withColumn("uniform", (F.col("shift") <= 0.1) & (F.abs("stretch") <= 1e-3))


def telluric_windows(rows: DataFrame, missions: DataFrame, default_width: float = 30.0, most_broadcast: int = 100_000) -> DataFrame:
    """Adds _center and _width (km/s) of each row's mission; null without an entry. missions: mission_id, telluric_line_center, telluric_line_width."""
    small = missions.select("mission_id", F.col("telluric_line_center").alias("_center"), F.coalesce("telluric_line_width", F.lit(default_width)).alias("_width"))
    few = F.broadcast(small) if small.limit(most_broadcast + 1).count() <= most_broadcast else small
    return rows.join(few, "mission_id", "left")


def with_telluric_mask(rows: DataFrame, missions: DataFrame, name: str = "fit_mask", default_width: float = 30.0, spectrum: str = "spectrum") -> DataFrame:
    """Adds a mask of the channels within half the width of the mission's telluric line, ends included; all false for other missions."""
    wide = telluric_windows(rows, missions, default_width)
    axis = A.axis(F.size(spectrum), "velocity", "deltav", "crpix1")
    inside = F.transform(axis, lambda v: F.coalesce(F.abs(v / 1000 - F.col("_center")) <= F.col("_width") / 2, F.lit(False)))
    return wide.withColumn(name, inside).drop("_center", "_width")


def window_mask(spectrum: str, low: Column | float | None = None, high: Column | float | None = None, channels: tuple[int, int] | None = None) -> Column:
    """Mask of a science line or an artefact: by velocity (velocity, deltav, crpix1 of the row) where a window is given, else by channels [first, last], else none."""
    n = F.size(spectrum)
    if low is not None and high is not None:
        end = F.greatest(F.abs("velocity"), F.abs(F.col("velocity") + (n - 1) * F.col("deltav")))
        a, b = in_unit_of(low, end), in_unit_of(high, end)
        bounds = F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        return A.let(bounds, lambda w: F.transform(A.axis(n, "velocity", "deltav", "crpix1"), lambda v: (v >= w["a"]) & (v <= w["b"])))
    first, last = channels or (0, -1)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: (i >= first) & (i <= last))


def normalized(spectrum: str) -> Column:
    """struct(values, mean, std): the spectrum less its mean, over its deviation (1 where that is 0)."""
    m = A.moments(spectrum)

    def scaled(p: Column) -> Column:
        mean = p["mean"]
        std = F.when(p["m2"] > 0, F.sqrt(p["m2"] / p["n"])).otherwise(1.0)
        return F.struct(F.transform(A.as_doubles(spectrum), lambda x: (x - mean) / std).alias("values"), mean.alias("mean"), std.alias("std"))

    return A.let(m, scaled)


def denormalized(parts: Column) -> Column:
    """The spectrum that normalized() was made from."""
    return F.transform(parts["values"], lambda x: x * parts["std"] + parts["mean"])


def rolling(spectrum: str, width: int) -> Column:
    """All windows of `width` channels in a row."""
    a = F.col(spectrum)
    return F.when(F.size(a) >= width, F.transform(F.sequence(F.lit(1), F.size(a) - width + 1), lambda i: F.slice(a, i, width))).otherwise(F.array().cast("array<array<double>>"))
