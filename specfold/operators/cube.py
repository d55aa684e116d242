"""Cubes (y, x, spectrum) collapsed to maps, masks on maps, differences and levels."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specfold.errors import SchemaError
from specfold.functions import arrays as A
from specfold.functions import kernels as K
from specfold.operators import footprint
from specfold.operators.kernel_ops import map_arrays


def _inside(spectrum: str, window: tuple[int, int]) -> Column:
    return A.where_index(spectrum, lambda i: (i >= window[0]) & (i <= window[1]))


def moment0(cube: DataFrame, window: tuple[int, int], deltav: float, spectrum: str = "spectrum") -> DataFrame:
    """Sum of finite channels of the window (ends included) times the channel width; NaN where there are none."""
    part = _inside(spectrum, window)
    value = F.when(F.size(A.finite(part)) > 0, A.total(part) * abs(deltav)).otherwise(F.lit(A.NAN))
    return cube.select("y", "x", value.alias("value"))


def peak(cube: DataFrame, spectrum: str = "spectrum") -> DataFrame:
    """Largest channel of the whole band and its place."""
    return cube.select("y", "x", F.array_max(A.finite(spectrum)).alias("value"), A.argmax(spectrum).alias("channel"))


def peak_range(cube: DataFrame, window: tuple[int, int], n: int, deltav: float, spectrum: str = "spectrum") -> DataFrame:
    """Sum of the channels within n of the window's peak and inside the window, times the channel width."""
    part = _inside(spectrum, window)

    def around(top: Column) -> Column:
        return A.total(A.where_index(part, lambda i: F.abs(i - top) <= n)) * abs(deltav)

    return cube.select("y", "x", A.let(A.argmax(part), around).alias("value"))


def moment1(cube: DataFrame, window: tuple[int, int], velocity: float, deltav: float, spectrum: str = "spectrum") -> DataFrame:
    """Intensity-weighted mean velocity of the window's finite channels."""
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("v"))
    part = F.transform(_inside(spectrum, window), lambda x, i: F.struct(x.alias("x"), (F.lit(velocity) + (i + window[0]) * deltav).alias("v")))
    step = lambda a, p: F.when(A.is_finite(p["x"]), F.struct((a["s"] + p["x"]).alias("s"), (a["v"] + p["x"] * p["v"]).alias("v"))).otherwise(a)
    return cube.select("y", "x", F.aggregate(part, zero, step, lambda a: F.when(a["s"] != 0, a["v"] / a["s"]).otherwise(F.lit(A.NAN))).alias("value"))


def noise_map(cube: DataFrame, window: tuple[int, int], spectrum: str = "spectrum") -> DataFrame:
    """Deviation of the finite channels outside the window."""
    return cube.select("y", "x", A.std(A.where_index(spectrum, lambda i: (i < window[0]) | (i > window[1]))).alias("value"))


def snr_masked(map_: DataFrame, noise: DataFrame, least: float, channels: int | None = None, deltav: float | None = None) -> DataFrame:
    """Values below so many deviations become 0. channels and deltav: the map is an integral over that many."""
    scale = F.lit(1.0) if channels is None else F.lit(float(np.sqrt(channels)) * abs(deltav))
    joined = map_.join(noise.select("y", "x", F.col("value").alias("_n")), ["y", "x"])
    ratio = F.col("value") / (F.col("_n") * scale)
    return joined.withColumn("snr", ratio).withColumn("value", F.when(A.is_finite(F.col("value")) & ~(F.col("snr") >= least), 0.0).otherwise(F.col("value"))).drop("_n")


def coverage_masked(map_: DataFrame, least: float) -> DataFrame:
    """Pixels with at least a share of the best coverage."""
    return map_.where(F.col("coverage") >= least * A.scalar(map_.agg(F.max("coverage"))))


def in_circle(cy: float, cx: float, radius: float) -> Column:
    return F.pow(F.col("y") - cy, 2) + F.pow(F.col("x") - cx, 2) <= radius * radius


def in_polygon(points: Sequence[tuple[float, float]]) -> Column:
    """Pixels whose centre is inside the polygon (x, y), by crossings of a ray."""
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    crossings = F.lit(0)
    for (x1, y1), (x2, y2) in zip(points, [*points[1:], points[0]], strict=True):
        if y1 != y2:
            hit = ((y < F.lit(float(y1))) != (y < F.lit(float(y2)))) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
            crossings = crossings + hit.cast("int")
    return crossings % 2 == 1


def eroded(map_: DataFrame, rings: int, shape: tuple[int, int] | None = None, folder: str | None = None) -> DataFrame:
    """Pixels with values but the outermost so many rings; pixels round inner holes stay. shape: rows and columns of the frame, those of the map's last pixels if not given."""
    if shape is None:
        shape = tuple((n or 0) + 1 for n in map_.agg(F.max("y"), F.max("x")).first())
    return footprint.trimmed(map_, rings, *shape, folder)


def clipped(map_: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    """Values below low become 0, those above high become high."""
    v = F.col("value")
    if low is not None:
        v = F.when(v < low, 0.0).otherwise(v)
    if high is not None:
        v = F.when(v > high, high).otherwise(v)
    return map_.withColumn("value", v)


def smoothed(map_: DataFrame, sigma: float) -> DataFrame:
    """Gaussian means over neighbour pixels with values, up to four sigma away; also fills gaps in reach."""
    reach = int(np.ceil(4 * sigma))
    step = F.sequence(F.lit(-reach), F.lit(reach))
    spread = map_.where(A.is_finite(F.col("value"))).select("y", "x", "value", F.explode(step).alias("_dy")).withColumn("_dx", F.explode(step))
    k = F.exp(-(F.col("_dy") * F.col("_dy") + F.col("_dx") * F.col("_dx")) / (2 * sigma * sigma))
    return spread.withColumn("_k", k).groupBy((F.col("y") + F.col("_dy")).alias("y"), (F.col("x") + F.col("_dx")).alias("x")).agg((F.sum(F.col("_k") * F.col("value")) / F.sum("_k")).alias("value"))


def noise_dropped(map_: DataFrame, noise: DataFrame, most: float) -> DataFrame:
    """Values of pixels whose noise exceeds the limit, or is not known, become 0."""
    joined = map_.join(noise.select("y", "x", F.col("value").alias("_n")), ["y", "x"], "left")
    return joined.withColumn("value", F.when(F.coalesce(A.is_finite(F.col("_n")) & (F.col("_n") <= most), F.lit(False)), F.col("value")).otherwise(0.0)).drop("_n")


def compare_maps(maps: dict[str, DataFrame], filled: float = 0.0) -> DataFrame:
    """Maps of several cubes cut to the box that holds what any of them has: name, y and x counted from the box's corner, value."""
    out = None
    for name, m in maps.items():
        one = m.select(F.lit(name).alias("name"), "y", "x", "value")
        out = one if out is None else out.unionByName(one)
    box = A.scalar(crop_box(out.select("y", "x", "value").dropDuplicates(["y", "x"]), filled).select(F.struct("y0", "y1", "x0", "x1")))
    inside = out.withColumn("_box", box).where(F.col("y").between(F.col("_box.y0"), F.col("_box.y1")) & F.col("x").between(F.col("_box.x0"), F.col("_box.x1")))
    return inside.select("name", (F.col("y") - F.col("_box.y0")).alias("y"), (F.col("x") - F.col("_box.x0")).alias("x"), "value")


COLLAPSES = ("moment0", "moment1", "peak", "peak_range", "mean", "noise", "weight")


def collapse(cube: DataFrame, how: str, window: tuple[int, int], velocity: float = 0.0, deltav: float = 1.0, around: int = 2, least_snr: float | None = None, low: float | None = None, high: float | None = None, spectrum: str = "spectrum", trim: tuple[int, int, int] | None = None, folder: str | None = None) -> DataFrame:
    """A cube's map by name, then cut by signal over noise, less the outer rings, and clipped: y, x, value.

    weight is the sum of the channels' weights (column weights) in the window, without channel width. trim: rings, and rows and columns of the frame.
    """
    made = {
        "moment0": lambda: moment0(cube, window, deltav, spectrum),
        "moment1": lambda: moment1(cube, window, velocity, deltav, spectrum),
        "peak": lambda: peak(cube, spectrum).select("y", "x", "value"),
        "peak_range": lambda: peak_range(cube, window, around, deltav, spectrum),
        "mean": lambda: cube.select("y", "x", A.mean(_inside(spectrum, window)).alias("value")),
        "noise": lambda: noise_map(cube, window, spectrum),
        "weight": lambda: cube.select("y", "x", A.total(_inside("weights", window)).alias("value")),
    }
    if how not in made:
        raise ValueError(f"no collapse {how}: {', '.join(COLLAPSES)}")
    out = made[how]()
    if least_snr is not None:
        n = window[1] - window[0] + 1
        out = snr_masked(out, noise_map(cube, window, spectrum), least_snr, n if how == "moment0" else None, deltav if how == "moment0" else None).drop("snr")
    if trim is not None:
        out = eroded(out, trim[0], trim[1:], folder)
    return clipped(out, low, high).select("y", "x", "value")


def subtract(a: DataFrame, b: DataFrame, units: tuple[str | None, str | None] = (None, None), frames: tuple | None = None, kernel: float | None = None) -> DataFrame:
    """a - b where both have values. Units, if both are known, must be equal; where frames (of a and b) are given and differ, b is gridded into that of a first, with the kernel."""
    if None not in units and units[0] != units[1]:
        raise SchemaError(f"maps in {units[0]} and {units[1]} cannot be subtracted")
    if frames is not None and frames[0] != frames[1]:
        from specfold.operators.grid import regrid

        b = regrid(b, frames[1], frames[0], kernel if kernel is not None else 2 * frames[0].pixel)
    return a.select("y", "x", F.col("value").alias("_a")).join(b.select("y", "x", F.col("value").alias("_b")), ["y", "x"]).select("y", "x", (F.col("_a") - F.col("_b")).alias("value"))


def contour_levels(map_: DataFrame, fractions: Sequence[float] | None = None, levels: Sequence[float] | None = None, n: int = 7) -> DataFrame:
    """Levels as given, or as fractions of the 99 % point (by default evenly from 0.2 to 0.9)."""
    if levels is not None:
        return map_.sparkSession.createDataFrame([(i, float(v)) for i, v in enumerate(levels)], "place int, level double")
    parts = list(fractions) if fractions else [0.2 + 0.7 * i / (n - 1) for i in range(n)]
    top = map_.where(A.is_finite(F.col("value"))).agg(F.percentile("value", F.lit(0.99)).alias("p"))
    return top.select(F.posexplode(F.array(*[F.col("p") * f for f in parts])).alias("place", "level"))


def mean_spectrum(cube: DataFrame, region: Column, spectrum: str = "spectrum") -> DataFrame:
    """Mean of each channel's finite values over the pixels of a region: pos, mean, n."""
    long = cube.where(region).select(F.posexplode(spectrum).alias("pos", "_x")).where(A.is_finite(F.col("_x")))
    return long.groupBy("pos").agg(F.avg("_x").alias("mean"), F.count(F.lit(1)).alias("n"))


def crop_box(map_: DataFrame, filled: float = 0.0) -> DataFrame:
    """Smallest box without margins whose rows or columns are filled to less than a share: y0, y1, x0, x1."""
    good = map_.where(A.is_finite(F.col("value")))
    span = lambda c: A.scalar(good.agg(F.max(c) - F.min(c) + 1))
    full = lambda c, across: good.groupBy(c).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") / span(across) >= filled)
    rows, cols = full("y", "x"), full("x", "y")
    return rows.agg(F.min("y").alias("y0"), F.max("y").alias("y1")).withColumns({"x0": A.scalar(cols.agg(F.min("x"))), "x1": A.scalar(cols.agg(F.max("x")))})


def spectrally_smoothed(cube: DataFrame, sigma: float, spectrum: str = "spectrum") -> DataFrame:
    return map_arrays(cube, spectrum, lambda y: K.gauss_smooth(y, sigma), {spectrum: "array<double>"})


def shuffled(cube: DataFrame, window: tuple[int, int], velocity: float, deltav: float, least_snr: float, sigma: float = 1.0, spectrum: str = "spectrum") -> DataFrame:
    """Spectra shifted so that the line stands at the median velocity: the field is moment 1 where moment 0 is significant, smoothed over neighbours."""
    n = window[1] - window[0] + 1
    strong = snr_masked(moment0(cube, window, deltav, spectrum), noise_map(cube, window, spectrum), least_snr, n, deltav).where("value <> 0")
    field = smoothed(moment1(cube, window, velocity, deltav, spectrum).join(strong.select("y", "x"), ["y", "x"], "left_semi"), sigma)
    here = cube.select("y", "x", spectrum).join(field.withColumnRenamed("value", "_v0"), ["y", "x"])
    moved = here.withColumn("shift", (F.col("_v0") - A.scalar(here.agg(F.median("_v0")))) / deltav).drop("_v0")
    return map_arrays(moved, spectrum, K.shift_rows, {spectrum: "array<double>"}, ("shift",))
