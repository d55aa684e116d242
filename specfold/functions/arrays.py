"""JVM-side expressions on array columns: finite values, moments, windows, axes, smoothing.

Missing channels are NaN (infinities and nulls count as missing too). Each reduction walks its array once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Cond = Callable[[Column], Column]
NAN = float("nan")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(x: Column) -> Column:
    """Neither null nor NaN nor infinite."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def let(value: Column, body: Cond) -> Column:
    """body(value), with the value computed once: the optimizer would copy a projected column into each use, and into loops over arrays."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scalar(one_row: DataFrame) -> Column:
    """The value of a table of one row and one column, as a scalar subquery."""
    return one_row.scalar()


def finite(arr: Column | str) -> Column:
    return F.filter(col(arr), is_finite)


def as_doubles(arr: Column | str) -> Column:
    return col(arr).cast("array<double>")


def moments(arr: Column | str) -> Column:
    """struct(n, mean, m2) of the finite elements, by one numerically stable walk."""
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def step(a: Column, x: Column) -> Column:
        n = a["n"] + 1.0
        d = x - a["mean"]
        mean = a["mean"] + d / n
        return F.when(is_finite(x), F.struct(n.alias("n"), mean.alias("mean"), (a["m2"] + d * (x - mean)).alias("m2"))).otherwise(a)

    return F.aggregate(as_doubles(arr), zero, step)


def _from_moments(arr: Column | str, pick: Cond) -> Column:
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def step(a: Column, x: Column) -> Column:
        n = a["n"] + 1.0
        d = x - a["mean"]
        mean = a["mean"] + d / n
        return F.when(is_finite(x), F.struct(n.alias("n"), mean.alias("mean"), (a["m2"] + d * (x - mean)).alias("m2"))).otherwise(a)

    return F.aggregate(as_doubles(arr), zero, step, pick)


def mean(arr: Column | str) -> Column:
    """Mean of the finite elements; NaN without any."""
    return _from_moments(arr, lambda a: F.when(a["n"] > 0, a["mean"]).otherwise(F.lit(NAN)))


def std(arr: Column | str) -> Column:
    """Population deviation of the finite elements; NaN without any."""
    return _from_moments(arr, lambda a: F.when(a["n"] > 0, F.sqrt(a["m2"] / a["n"])).otherwise(F.lit(NAN)))


def rms(arr: Column | str) -> Column:
    return F.aggregate(finite(as_doubles(arr)), F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("s")), lambda a, x: F.struct((a["n"] + 1.0).alias("n"), (a["s"] + x * x).alias("s")), lambda a: F.when(a["n"] > 0, F.sqrt(a["s"] / a["n"])).otherwise(F.lit(NAN)))


def total(arr: Column | str) -> Column:
    """Sum of the finite elements; 0 without any."""
    return F.aggregate(as_doubles(arr), F.lit(0.0), lambda a, x: F.when(is_finite(x), a + x).otherwise(a))


def count_where(arr: Column | str, cond: Cond) -> Column:
    return F.size(F.filter(col(arr), cond))


def where_index(arr: Column | str, cond: Cond) -> Column:
    """The elements whose 0-based place fulfils the condition."""
    return F.filter(col(arr), lambda _, i: cond(i))


def axis(n: Column, velocity: Column | str, deltav: Column | str, crpix: Column | str) -> Column:
    """Velocity of each of n channels: the reference velocity stands at the 1-based reference pixel."""
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: col(velocity) + (i - (col(crpix) - 1)) * col(deltav))


def channel_of(v: Column, velocity: Column | str, deltav: Column | str, crpix: Column | str) -> Column:
    """Nearest 0-based channel, halves to even."""
    return F.rint((v - col(velocity)) / col(deltav) + col(crpix) - 1).cast("int")


def decimate(arr: Column | str, k: int) -> Column:
    return where_index(arr, lambda i: i % k == 0)


def boxcar(arr: Column | str, k: int) -> Column:
    """Running mean over k channels with zeros beyond the ends; NaN spreads over the kernel.

    The window of channel i spans i - (k - 1) + (k - 1) // 2 ... i + (k - 1) // 2, k channels in all.
    """
    a = as_doubles(arr)
    after = (k - 1) // 2
    before = k - 1 - after

    def at(_: Column, i: Column) -> Column:
        lo = F.greatest(i - before, F.lit(0))
        part = F.slice(a, lo + 1, i + after - lo + 1)
        return F.aggregate(part, F.lit(0.0), lambda s, x: s + x) / k

    return F.transform(a, at)


def fill(arr: Column | str, value: float) -> Column:
    return F.transform(col(arr), lambda x: F.when(is_finite(x), x).otherwise(F.lit(value)))


def channel_mask(n: Column, center: Column | float, width: Column | float) -> Column:
    """Whether each of n channels is within half a width of the centre."""
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.abs(i - center) <= F.lit(width) / 2)


def any_mask(*masks: Column) -> Column:
    out = masks[0]
    for m in masks[1:]:
        out = F.zip_with(out, m, lambda a, b: a | b)
    return out


def apply_mask(arr: Column | str, mask: Column, value: float = NAN) -> Column:
    return F.zip_with(as_doubles(arr), mask, lambda x, m: F.when(m, F.lit(value)).otherwise(x))


def argmax(arr: Column | str) -> Column:
    """0-based place of the largest finite element; null without any."""
    a = as_doubles(arr)
    top = F.array_max(finite(a))
    return F.when(top.isNotNull(), F.array_position(a, top).cast("int") - 1)
