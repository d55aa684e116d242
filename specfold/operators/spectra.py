"""Averages, noise figures, axes and reductions of tables of spectra."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specfold.errors import NoDataError, SchemaError
from specfold.functions import arrays as A
from specfold.functions import kernels as K
from specfold.operators.axes import spectral_parameters
from specfold.operators.filters import CALIBRATION, nan_fraction
from specfold.operators.kernel_ops import map_arrays
from specfold.operators.quality import C_LIGHT, MAD, mad_flags
from specfold.operators.ranks import quantiles
from specfold.work import work_folder, written


def table_crpix(rows: DataFrame, column: str = "crpix1") -> DataFrame:
    """One row: the median reference pixel, and whether the rows' spread exceeds half a channel."""
    good = rows.where(A.is_finite(F.col(column)))
    return good.agg(F.median(column).alias("crpix1"), (F.max(column) - F.min(column) > 0.5).alias("uneven"))


def check_uniform_grid(rows: DataFrame, velocity: str = "velocity", deltav: str = "deltav") -> None:
    """Raises unless all rows share a velocity grid: references within a tenth of a channel, steps within 1e-3."""
    s = rows.agg(F.max(velocity) - F.min(velocity), F.max(deltav), F.min(deltav)).first()
    if s[1] is not None and (s[0] > 0.1 * abs(s[1]) or abs(s[1] - s[2]) > 1e-3 * abs(s[1])):
        raise SchemaError("the rows do not share a velocity grid; resample them first")


def with_axis(rows: DataFrame, name: str = "axis", spectrum: str = "spectrum") -> DataFrame:
    return rows.withColumn(name, A.axis(F.size(spectrum), "velocity", "deltav", "crpix1"))


def rescaled_frequency(rows: DataFrame, factor: Column | float) -> DataFrame:
    """DELTAV and what goes with it, for channels wider by the factor."""
    there = [c for c in ("deltav", "cdelt1", "freqres") if c in rows.columns]
    return rows.withColumns({c: F.col(c) * factor for c in there})


def extract(rows: DataFrame, low: float, high: float, spectrum: str = "spectrum") -> DataFrame:
    """Channels whose velocity lies in [low, high], and the reference pixel moved with them. Raises nothing for rows without such channels: their spectra become empty."""
    at = lambda v: (F.lit(v) - F.col("velocity")) / F.col("deltav") + F.col("crpix1") - 1
    first = F.greatest(F.lit(0), F.ceil(F.least(at(low), at(high)) - 1e-9).cast("int"))
    last = F.least(F.size(spectrum) - 1, F.floor(F.greatest(at(low), at(high)) + 1e-9).cast("int"))
    out = rows.withColumns({"_first": first, "_n": F.greatest(F.lit(0), last - first + 1)})
    return out.withColumns({spectrum: F.slice(spectrum, F.col("_first") + 1, F.col("_n")), "crpix1": F.col("crpix1") - F.col("_first")}).drop("_first", "_n")


def decimated(rows: DataFrame, k: int, spectrum: str = "spectrum") -> DataFrame:
    """Every k-th channel; the axis follows."""
    return rescaled_frequency(rows.withColumns({spectrum: A.decimate(spectrum, k), "crpix1": (F.col("crpix1") - 1) / k + 1}), k)


def resampled(rows: DataFrame, step: float, low: float | None = None, high: float | None = None, spectrum: str = "spectrum") -> DataFrame:
    """All rows on one grid of velocities at multiples of the step: means of the channels nearest to each point."""
    ends = rows.select(F.explode(F.array(F.lit(0), F.size(spectrum) - 1)).alias("i"), "velocity", "deltav", "crpix1").select((F.col("velocity") + (F.col("i") - (F.col("crpix1") - 1)) * F.col("deltav")).alias("v"))
    if low is None or high is None:
        low, high = ends.agg(F.min("v"), F.max("v")).first()
        if low is None:
            return rows
    start, stop = np.floor(low / step) * step, np.ceil(high / step) * step
    n = int(round((stop - start) / step)) + 1

    def kernel(y: np.ndarray, velocity: np.ndarray, deltav: np.ndarray, crpix: np.ndarray) -> np.ndarray:
        v = velocity[:, None] + (np.arange(y.shape[1])[None, :] - (crpix[:, None] - 1)) * deltav[:, None]
        return K.resample(y, v, start, step, n)

    out = map_arrays(rows, spectrum, kernel, {spectrum: "array<double>"}, ("velocity", "deltav", "crpix1"))
    scaled = rescaled_frequency(out, F.abs(F.lit(step) / F.col("deltav")))
    return scaled.withColumns({"velocity": F.lit(float(start)), "deltav": F.lit(float(step)), "crpix1": F.lit(1.0)})


def average(rows: DataFrame, keys: Iterable[str] = (), spectrum: str = "spectrum", weight: Column | None = None) -> DataFrame:
    """Mean, population deviation and count of each channel's finite values: keys, pos, mean, std, n. Partial sums meet map-side, so one group can hold most rows."""
    keys = list(keys)
    w = F.lit(1.0) if weight is None else weight
    long = rows.select(*keys, w.alias("_w"), F.posexplode(spectrum).alias("pos", "_x")).where(A.is_finite(F.col("_x")) & A.is_finite(F.col("_w")))
    sums = (F.sum(F.col("_w") * F.col("_x")) / F.sum("_w")).alias("mean") if weight is not None else F.avg("_x").alias("mean")
    return long.groupBy(*keys, "pos").agg(sums, F.stddev_pop("_x").alias("std"), F.count(F.lit(1)).alias("n"))


def average_spectra(rows: DataFrame, keys: Iterable[str] = (), spectrum: str = "spectrum", weight: Column | None = None) -> DataFrame:
    """As average, one row a group: keys, spectrum, std (arrays), n (all rows of the group) and rms (mean of the deviations)."""
    keys = list(keys)
    long = average(rows, keys, spectrum, weight)
    packed = F.array_sort(F.collect_list(F.struct("pos", "mean", "std")))  # one element a channel
    wide = long.groupBy(*keys).agg(packed.alias("_p"), F.avg("std").alias("rms"))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    out = wide.select(*keys, F.transform("_p", lambda p: p["mean"]).alias("spectrum"), F.transform("_p", lambda p: p["std"]).alias("std"), "rms")
    return out.join(counts, keys) if keys else out.withColumn("n", A.scalar(counts))


#: Classes of observed and fitted sky spectra.
SKY = ("S-H_OBS", "S-H_FIT")


def telluric_average(rows: DataFrame, keys: Iterable[str] = ("mission_id",), objects: Iterable[str] = SKY, spectrum: str = "spectrum") -> DataFrame:
    """Average of the observed and of the fitted sky of each mission: keys, object, pos, mean, std, n."""
    return average(rows.where(F.col("object").isin(*objects)), [*keys, "object"], spectrum)


def receiver_averages(rows: DataFrame, keys: Iterable[str] = ("receiver", "polarization", "pixel"), weight: Column | None = None, spectrum: str = "spectrum") -> DataFrame:
    """Averages by receiver, polarization or pixel, as the telescope's name tells them. Rows whose name does not are left out."""
    from specfold.operators.provenance import parse_telescop

    keys = list(keys)
    named = rows.select("*", *[p for p, k in zip(parse_telescop("telescop"), ("receiver", "polarization", "pixel"), strict=True) if k in keys])
    return average(named.where(" and ".join(f"{k} is not null" for k in keys)), keys, spectrum, weight)


def residual_rms(observed: DataFrame, fitted: DataFrame, keys: Iterable[str], window: tuple[int, int], spectrum: str = "spectrum") -> DataFrame:
    """observed and fitted: row_id, the keys of a pair, spectrum. Noise of their difference in the window's channels, both ends included: keys, row_id (the observed row's), rms."""
    keys = list(keys)
    other = fitted.select(*keys, F.col(spectrum).alias("_fit"))
    diff = F.zip_with(spectrum, "_fit", lambda x, y: x - y)
    both = observed.select("row_id", *keys, spectrum).join(other, keys)
    return both.select(*keys, "row_id", A.std(A.where_index(diff, lambda i: (i >= window[0]) & (i <= window[1]))).alias("rms"))


def waterfall(rows: DataFrame, keys: Iterable[str] = ("mission_id", "scan", "telescop")) -> DataFrame:
    """The images of a waterfall display: keys, row_id and place, the row's line (from 1) in its group's image by row_id."""
    from specfold.operators.links import ranked

    return ranked(rows.select(*keys, "row_id"), keys)


def spectrum_statistics(spectrum: str) -> list[Column]:
    """mean, std, least, most and rms of the finite channels."""
    good = A.finite(A.as_doubles(spectrum))
    return [A.mean(spectrum).alias("mean"), A.std(spectrum).alias("std"), F.array_min(good).alias("least"), F.array_max(good).alias("most"), A.rms(spectrum).alias("rms")]


def outside(spectrum: str, window: tuple[int, int]) -> Column:
    """The channels outside [start, end)."""
    return A.where_index(spectrum, lambda i: (i < window[0]) | (i >= window[1]))


def line_fit(spectrum: Column, use: Column) -> Column:
    """struct(n, sx, sy, sxx, sxy) of the finite channels in use, in one walk. use: array of places."""
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "sx", "sy", "sxx", "sxy")])
    pairs = F.transform(use, lambda i: F.struct(i.cast("double").alias("x"), F.element_at(spectrum, (i + 1).cast("int")).alias("y")))

    def step(a: Column, p: Column) -> Column:
        x, y = p["x"], p["y"]
        return F.when(A.is_finite(y), F.struct((a["n"] + 1.0).alias("n"), (a["sx"] + x).alias("sx"), (a["sy"] + y).alias("sy"), (a["sxx"] + x * x).alias("sxx"), (a["sxy"] + x * y).alias("sxy"))).otherwise(a)

    return F.aggregate(pairs, zero, step)


def unclipped_baseline(rows: DataFrame, order: int, window: tuple[int, int], spectrum: str = "spectrum") -> DataFrame:
    """Subtracts the mean (order 0) or line (order 1) of the channels outside the window, in the JVM."""
    if order not in (0, 1):
        raise ValueError("the JVM form has orders 0 and 1; use baselined")
    use = A.where_index(F.sequence(F.lit(0), F.size(spectrum) - 1), lambda i: (i < window[0]) | (i >= window[1]))

    def corrected(f: Column) -> Column:
        det = f["n"] * f["sxx"] - f["sx"] * f["sx"]
        slope = F.when(det > 0, (f["n"] * f["sxy"] - f["sx"] * f["sy"]) / det).otherwise(0.0) if order else F.lit(0.0)
        line = F.struct(slope.alias("b"), f["n"].alias("n"), f["sx"].alias("sx"), f["sy"].alias("sy"))
        fixed = lambda p: F.transform(spectrum, lambda x, i: x - ((p["sy"] - p["b"] * p["sx"]) / p["n"] + p["b"] * i))
        return F.when(f["n"] > order, A.let(line, fixed)).otherwise(F.col(spectrum))

    return rows.withColumn(spectrum, A.let(line_fit(F.col(spectrum), use), corrected))


def baselined(rows: DataFrame, order: int = 1, window: tuple[int, int] | None = None, clip: float = 3.0, rounds: int = 3, spectrum: str = "spectrum", object_column: str | None = None) -> DataFrame:
    """Clipped polynomial baseline of every row but calibration."""
    cal = None if object_column is None else F.col(object_column).isin(*CALIBRATION)
    work = rows.withColumn("_y", A.as_doubles(spectrum) if cal is None else F.when(~cal, A.as_doubles(spectrum)))
    done = map_arrays(work, "_y", lambda y: K.baseline(y, order, window, None, clip, rounds), {"_y": "array<double>"})
    return done.withColumn(spectrum, F.coalesce("_y", A.as_doubles(spectrum))).drop("_y")


def auto_baselined(rows: DataFrame, theoretical: str, window: tuple[int, int] | None = None, spectrum: str = "spectrum", most: int = 3) -> DataFrame:
    """Baseline of the lowest order, up to `most`, that brings the noise near the theoretical one; adds blorder."""
    return map_arrays(rows, spectrum, lambda y, t: K.auto_order(y, t, window, most), {spectrum: "array<double>", "blorder": "long"}, (theoretical,))


def noise_filled(rows: DataFrame, missions: DataFrame, seed: int, centered: bool, spectrum: str = "spectrum", window: tuple[int, int] | None = None, default_width: float = 30.0) -> DataFrame:
    """Replaces the telluric channels of each mission by seeded noise. missions: mission_id, telluric_line_center, telluric_line_width (km/s)."""
    small = missions.select("mission_id", F.col("telluric_line_center").alias("_c"), F.coalesce("telluric_line_width", F.lit(default_width)).alias("_w"))
    bounded = small.limit(100_001).count() <= 100_000
    joined = rows.join(F.broadcast(small) if bounded else small, "mission_id", "left")

    def kernel(y, velocity, deltav, crpix, center, width, row_id):
        v = (velocity[:, None] + (np.arange(y.shape[1])[None, :] - (crpix[:, None] - 1)) * deltav[:, None]) / 1000
        with np.errstate(invalid="ignore"):
            mask = np.abs(v - center[:, None].astype(float)) <= width[:, None].astype(float) / 2
        return K.fill_with_noise(y, mask, row_id, seed, centered, window)

    return map_arrays(joined, spectrum, kernel, {spectrum: "array<double>"}, ("velocity", "deltav", "crpix1", "_c", "_w", "row_id")).drop("_c", "_w")


def unblanked(rows: DataFrame, below: float = 0.2, spectrum: str = "spectrum") -> DataFrame:
    return rows.where(nan_fraction(spectrum) < below)


@dataclass(frozen=True)
class Reduction:
    """Steps of reduce_spectra, in the order in which they run; None leaves a step out."""

    unblank: float | None = None
    extract: tuple[float, float] | None = None
    telluric: DataFrame | None = None
    baseline: int | None = None
    line_window: tuple[float, float] | None = None
    smooth: int | None = None
    decimate: bool = False
    seed: int = 42


def reduce_spectra(rows: DataFrame, steps: Reduction, spectrum: str = "spectrum", object_column: str | None = "object") -> DataFrame:
    """Unblank, extract, fill telluric channels, baseline, line-free noise, smooth, decimate. line_window is in m/s."""
    out = rows
    if steps.unblank is not None:
        out = unblanked(out, steps.unblank, spectrum)
        if out.limit(1).count() == 0:
            raise NoDataError("every spectrum has too many missing channels")
    if steps.extract:
        out = extract(out, *steps.extract, spectrum)
    if steps.telluric is not None:
        out = noise_filled(out, steps.telluric, steps.seed, True, spectrum)
    if steps.baseline is not None:
        window = None
        if steps.line_window:
            first = spectral_parameters(out, ("velocity", "deltav", "crpix1")).first() if "row_id" in out.columns else out.select("velocity", "deltav", "crpix1").first()
            if first and first[0] is not None:
                ends = sorted(int(np.rint((v - first[0]) / first[1] + first[2] - 1)) for v in steps.line_window)
                window = (max(0, ends[0]), max(0, ends[1]))
        out = baselined(out, steps.baseline, window, spectrum=spectrum, object_column=object_column)
        free = F.col(spectrum) if window is None else A.where_index(spectrum, lambda i: (i < window[0]) | (i > window[1]))
        out = out.withColumn("rms_baseline", A.std(free))
    if steps.smooth:
        k = steps.smooth
        out = map_arrays(out, spectrum, lambda y: K.smooth(y, k), {spectrum: "array<double>"})
        if steps.decimate:
            out = decimated(out, k, spectrum)
    elif steps.decimate:
        raise ValueError("decimation goes with smoothing")
    return out


def whiteness_sweep(rows: DataFrame, widths: Iterable[int], sigmas: Iterable[float], line_free: np.ndarray, spectrum: str = "spectrum", least_rows: int = 10) -> DataFrame:
    """How many rows each width and limit would flag: k, z, n (rows with a value), threshold, n_flagged. Each row is scored once for all widths."""
    widths, sigmas = list(widths), list(sigmas)
    scored = map_arrays(rows, spectrum, lambda y: tuple(K.whiteness(y, line_free, k) for k in widths) if len(widths) > 1 else K.whiteness(y, line_free, widths[0]), {f"_{k}": "double" for k in widths})
    long = scored.select(F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"_{k}").alias("x")) for k in widths]))).where(A.is_finite(F.col("x")))
    long = written(long, f"{work_folder(rows.sparkSession)}/scored")
    middle = quantiles(long, "x", (0.5,), ["k"]).select("k", "n", F.col("values")[0].alias("m"))
    spread = quantiles(long.join(F.broadcast(middle), "k"), F.abs(F.col("x") - F.col("m")), (0.5,), ["k"]).select("k", F.col("values")[0].alias("s"))
    limits = middle.join(spread, "k").withColumn("z", F.explode(F.array(*[F.lit(float(z)) for z in sigmas]))).withColumn("threshold", F.when(F.col("n") >= least_rows, F.col("m") + F.col("z") * MAD * F.col("s")))
    # as many rows as widths times limits
    return long.join(F.broadcast(limits.select("k", "z", "n", "threshold")), "k").groupBy("k", "z", "n", "threshold").agg(F.count_if(F.col("x") > F.col("threshold")).alias("n_flagged"))


def whiteness_flags(rows: DataFrame, k: int, sigmas: float, line_free: np.ndarray, spectrum: str = "spectrum") -> DataFrame:
    """Adds whiteness and whiteflag: 1 above the robust threshold, 0 below, -1 without a value or with fewer than 10 rows."""
    scored = written(map_arrays(rows, spectrum, lambda y: K.whiteness(y, line_free, k), {"whiteness": "double"}), f"{work_folder(rows.sparkSession)}/scored")
    flagged = mad_flags(scored, "whiteness", sigmas, "_f", 10)
    value = F.when(F.col("threshold").isNull() | ~A.is_finite(F.col("whiteness")), -1).otherwise(F.col("_f").cast("int"))
    return flagged.withColumn("whiteflag", value).drop("_f")


def group_excess(rows: DataFrame, key: str, window: tuple[int, int], sigmas: float = 5.0, spectrum: str = "spectrum", weighted: bool = True) -> DataFrame:
    """Noise of group averages over the expected one, with a robust flag. Rows without a finite noise are left out.

    Expected: sqrt(sum s^2) / N, or sqrt(sum w^2 s^2) / sum w for weights 1 / s^2. Columns: key, n, expected, noise, excess, threshold, flag.
    """
    # the square of each row's noise, null if there is none; no filter on it, which would compute it twice
    square = A.let(A.std(outside(spectrum, window)), lambda v: F.when(A.is_finite(v) & (v > 0), v * v))
    w = 1 / F.col("_v") if weighted else F.when(F.col("_v").isNotNull(), 1.0)
    marked = rows.select(key, spectrum, square.alias("_v")).withColumn("_w", w)
    expected = marked.groupBy(key).agg(F.count("_v").alias("n"), (F.sqrt(F.sum(F.col("_w") * F.col("_w") * F.col("_v"))) / F.sum("_w")).alias("expected")).where("n > 0")
    mean = average(marked, [key], spectrum, F.col("_w")).where((F.col("pos") < window[0]) | (F.col("pos") >= window[1]))
    noise = mean.groupBy(key).agg(F.stddev_pop("mean").alias("noise"))
    both = expected.join(noise, key).withColumn("excess", F.col("noise") / F.col("expected"))
    return mad_flags(written(both, f"{work_folder(rows.sparkSession)}/excess"), "excess", sigmas)


def window_mean(spectrum: str, first: Column, last: Column) -> Column:
    """Mean of the finite channels from first to last, both included."""
    return A.mean(A.where_index(spectrum, lambda i: (i >= first) & (i <= last)))


def coherence(models: DataFrame, least_common: int = 8, digits: int = 2) -> DataFrame:
    """models: mission_id, telescop, component, velocity, value (long form). Median absolute correlation of each component between pixel pairs on common velocities: mission_id, component, score."""
    rounded = models.withColumn("velocity", F.round("velocity", digits))
    a = rounded.select("mission_id", "component", "velocity", F.col("telescop").alias("p"), F.col("value").alias("x"))
    b = rounded.select("mission_id", "component", "velocity", F.col("telescop").alias("q"), F.col("value").alias("y"))
    pairs = a.join(b, ["mission_id", "component", "velocity"]).where("p < q")
    each = pairs.groupBy("mission_id", "component", "p", "q").agg(F.corr("x", "y").alias("r"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_common)
    return each.where(A.is_finite(F.col("r"))).groupBy("mission_id", "component").agg(F.median(F.abs("r")).alias("score"))


def chosen_components(scores: DataFrame, least: float = 0.4) -> DataFrame:
    """Components of each mission up to the first whose score is too low; 1 at least."""
    w = Window.partitionBy("mission_id").orderBy("component")
    run = scores.withColumn("_ok", F.min((F.col("score") >= least).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy("mission_id").agg(F.greatest(F.lit(1), F.sum("_ok")).cast("long").alias("n_components"))


def velocity_resolution(rows: DataFrame, axis_type: str = "VELO") -> Column:
    """Channel width in km/s, from m/s steps, or from Hz steps of frequency axes."""
    if axis_type.upper().startswith("FREQ"):
        return F.abs(F.col("cdelt1")) / F.col("restfreq") * C_LIGHT / 1000
    return F.when(F.abs("deltav") > 0, F.abs(F.col("deltav")) / 1000)


def blank_statistics(rows: DataFrame, fraction: Column) -> DataFrame:
    return rows.select(fraction.alias("f")).agg(F.avg("f").alias("mean"), F.median("f").alias("median"), F.stddev_pop("f").alias("std"), F.min("f").alias("least"), F.max("f").alias("most"), F.count_if(F.col("f") == 0).alias("n_none"), F.count_if(F.col("f") > 0).alias("n_some"))


def sample_rows(rows: DataFrame, n: int, seed: int, key: str = "row_id") -> DataFrame:
    """n rows by hashed key, in key order: the same for the same seed."""
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n).orderBy(key)


def overrides_frame(spark, table: Mapping[str, Mapping[str, object]], schema: str) -> DataFrame:
    """Per-mission settings as a table: mission_id and the schema's columns."""
    names = [c.split()[0] for c in schema.split(",")]
    return spark.createDataFrame([(m, *[v.get(n) for n in names]) for m, v in table.items()], f"mission_id string, {schema}")
