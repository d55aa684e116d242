"""Kernel-weighted gridding of samples on the sky: maps of scalars, cubes of spectra."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specfold.errors import NoDataError
from specfold.functions import arrays as A
from specfold.functions.groups import sorted_groups
from specfold.operators import ranks
from specfold.operators.kernel_ops import block_of, lists_of

FWHM = 2.355


@dataclass(frozen=True)
class Frame:
    """A map's pixels: orthographic projection around (ra, dec), square pixels of `pixel` degrees, 1-based reference pixel, x to the west."""

    ra: float
    dec: float
    pixel: float
    nx: int
    ny: int
    refx: float
    refy: float

    def keywords(self) -> dict[str, object]:
        """What a FITS header says of the frame."""
        return {"CTYPE1": "RA---SIN", "CTYPE2": "DEC--SIN", "CRVAL1": self.ra, "CRVAL2": self.dec, "CRPIX1": self.refx, "CRPIX2": self.refy, "CDELT1": -self.pixel, "CDELT2": self.pixel, "CUNIT1": "deg", "CUNIT2": "deg", "NAXIS1": self.nx, "NAXIS2": self.ny}


def frame_of(samples: DataFrame, pixel: float, pad: float = 0.1) -> Frame:
    """A frame that holds all samples (ra, dec in degrees) and a margin of `pad` of their range on each side."""
    low_a, high_a, low_d, high_d = samples.agg(F.min("ra"), F.max("ra"), F.min("dec"), F.max("dec")).first()
    if low_a is None:
        raise NoDataError("no samples to grid")
    ra, dec = (low_a + high_a) / 2, (low_d + high_d) / 2
    wide, high = (high_a - low_a) * math.cos(math.radians(dec)) * (1 + 2 * pad), (high_d - low_d) * (1 + 2 * pad)
    nx, ny = max(1, math.ceil(wide / pixel)), max(1, math.ceil(high / pixel))
    return Frame(ra, dec, pixel, nx, ny, nx / 2 + 1, ny / 2 + 1)


def map_frame_of(samples: DataFrame, pixel: float) -> Frame:
    """A frame for maps of scalars: the samples' range without a margin, in whole pixels and one more."""
    low_a, high_a, low_d, high_d = samples.agg(F.min("ra"), F.max("ra"), F.min("dec"), F.max("dec")).first()
    if low_a is None:
        raise NoDataError("no samples to grid")
    ra, dec = (low_a + high_a) / 2, (low_d + high_d) / 2
    nx, ny = int((high_a - low_a) * math.cos(math.radians(dec)) / pixel) + 1, int((high_d - low_d) / pixel) + 1
    return Frame(ra, dec, pixel, nx, ny, nx / 2 + 0.5, ny / 2 + 0.5)


def sky(rows: DataFrame, crval2: float, crval3: float) -> DataFrame:
    """ra and dec from offsets cdelt2, cdelt3 (degrees) to a reference position."""
    dec = F.lit(crval3) + F.col("cdelt3")
    return rows.withColumns({"dec": dec, "ra": F.lit(crval2) + F.col("cdelt2") / F.cos(F.radians(dec))})


def resolution(beam: float, wanted: float | None = None, kernel: float | None = None, pixel: float | None = None) -> tuple[float, float, float]:
    """Kernel, resolution and pixel for a beam: the kernel is a third of the beam unless it or the resolution is given; the pixel half the resolution."""
    if kernel is None:
        kernel = math.sqrt(wanted**2 - beam**2) if wanted is not None and wanted > beam else beam / 3
    reached = math.hypot(beam, kernel)
    return kernel, reached, pixel if pixel is not None else reached / 2


def _project(frame: Frame, ra: Column, dec: Column) -> tuple[Column, Column]:
    """1-based pixel coordinates."""
    da, d, d0 = F.radians(ra - frame.ra), F.radians(dec), math.radians(frame.dec)
    east = F.cos(d) * F.sin(da)
    north = F.sin(d) * math.cos(d0) - F.cos(d) * math.sin(d0) * F.cos(da)
    return frame.refx - F.degrees(east) / frame.pixel, frame.refy + F.degrees(north) / frame.pixel


def _center(frame: Frame, x: Column, y: Column) -> tuple[Column, Column]:
    """Sky position of a pixel (0-based), in radians."""
    east = F.radians(-(x + 1 - frame.refx) * frame.pixel)
    north = F.radians((y + 1 - frame.refy) * frame.pixel)
    s, c = math.sin(math.radians(frame.dec)), math.cos(math.radians(frame.dec))
    depth = F.sqrt(F.greatest(F.lit(0.0), 1 - east * east - north * north))
    return math.radians(frame.ra) + F.atan2(east, c * depth - s * north), F.asin(north * c + s * depth)


def with_cells(samples: DataFrame, frame: Frame, kernel: float, support: float = 3.0) -> DataFrame:
    """A row for each sample and pixel within support kernels, with y, x and k, the Gaussian of their distance."""
    reach = support * kernel
    r = math.ceil(reach / frame.pixel) + 1
    px, py = _project(frame, F.col("ra"), F.col("dec"))
    near = samples.withColumns({"_px": F.rint(px).cast("int") - 1, "_py": F.rint(py).cast("int") - 1})
    # a projected pixel differs from its neighbours by at most one where the sky is flat enough to be mapped at all
    span = lambda c, n: F.sequence(F.greatest(F.lit(0), F.col(c) - r), F.least(F.lit(n - 1), F.col(c) + r))
    inside = near.where((F.col("_px") >= -r) & (F.col("_px") < frame.nx + r) & (F.col("_py") >= -r) & (F.col("_py") < frame.ny + r))
    cells = inside.withColumn("y", F.explode(span("_py", frame.ny))).withColumn("x", F.explode(span("_px", frame.nx))).drop("_px", "_py")
    ra, dec = _center(frame, F.col("x"), F.col("y"))
    a = F.sin((dec - F.radians("dec")) / 2)
    b = F.sin((ra - F.radians("ra")) / 2)
    d = F.degrees(2 * F.asin(F.sqrt(a * a + F.cos(dec) * F.cos(F.radians("dec")) * b * b)))
    sigma = kernel / FWHM
    return cells.withColumn("_d", d).where(F.col("_d") <= reach).withColumn("k", F.exp(-F.col("_d") * F.col("_d") / (2 * sigma * sigma))).drop("_d")


def grid_map(samples: DataFrame, frame: Frame, kernel: float, value: str = "value", weight: Column | None = None, support: float = 3.0) -> DataFrame:
    """samples: ra, dec, value. Pixels with coverage: y, x, value (sum k w v / sum k w), coverage (sum k), weight (sum k w). Sums meet map-side."""
    good = samples.select("ra", "dec", F.col(value).cast("double").alias("_v"), (F.lit(1.0) if weight is None else weight).alias("_w")).where(A.is_finite(F.col("_v")) & A.is_finite(F.col("_w")))
    kw = F.col("k") * F.col("_w")
    sums = with_cells(good, frame, kernel, support).groupBy("y", "x").agg(F.sum(kw * F.col("_v")).alias("_s"), F.sum(kw).alias("weight"), F.sum("k").alias("coverage"))
    return sums.select("y", "x", F.when(F.col("weight") > 0, F.col("_s") / F.col("weight")).otherwise(F.lit(A.NAN)).alias("value"), "coverage", "weight")


def noise_weight(ratio: str | None = None, rms: str | None = None) -> Column:
    """Weight of a spectrum: a Gaussian of its noise ratio's excess over 1, or the inverse square of its noise; not finite if unknown."""
    if ratio:
        over = F.greatest(F.col(ratio) - 1, F.lit(0.0))
        return F.when(A.is_finite(F.col(ratio)), F.exp(-over * over / (2 * 0.5**2))).otherwise(F.lit(A.NAN))
    v = F.col(rms)
    return F.when(A.is_finite(v) & (v != 0), 1 / (v * v)).otherwise(F.lit(A.NAN))


def with_inverse_weight(rows: DataFrame, column: str, name: str = "w") -> DataFrame:
    """Weights for maps from a column of which less is better: the inverse of its size over the largest such; 0 where it is 0 or missing."""
    v = F.abs(F.col(column))
    raw = rows.withColumn("_inverse", F.when(A.is_finite(F.col(column)) & (v > 0), 1 / v).otherwise(0.0))
    top = A.scalar(raw.agg(F.max("_inverse")))
    return raw.withColumn(name, F.when(top > 0, F.col("_inverse") / top).otherwise(F.col("_inverse"))).drop("_inverse")


def with_channel_quality(rows: DataFrame, calibration: DataFrame, window: tuple[int, int] | None = None, name: str = "quality", spectrum: str = "spectrum") -> DataFrame:
    """Weights for maps from calibration: the sum over a row's channels (of the window, ends included) of (e^-tau / Tsys)^2, over the median of all rows that have one; 1 for the others.

    rows: row_id, tsys_id, tau_id and others; calibration: row_id, spectrum. Channels without both, or with Tsys of 0 or less, add nothing.
    """
    cal = calibration.select(F.col("row_id").alias("_id"), F.col(spectrum).alias("_s"))
    both = rows.join(cal.select(F.col("_id").alias("tsys_id"), F.col("_s").alias("_tsys")), "tsys_id", "left").join(cal.select(F.col("_id").alias("tau_id"), F.col("_s").alias("_tau")), "tau_id", "left")
    pairs = F.arrays_zip(F.col("_tsys").alias("s"), F.col("_tau").alias("t"))
    if window:
        pairs = F.slice(pairs, window[0] + 1, window[1] - window[0] + 1)
    good = F.filter(pairs, lambda p: A.is_finite(p["s"]) & A.is_finite(p["t"]) & (p["s"] > 0))
    total = F.aggregate(good, F.lit(0.0), lambda a, p: a + F.pow(F.exp(-p["t"]) / p["s"], F.lit(2.0)))
    raw = both.withColumn("_sum", F.when((total > 0) & A.is_finite(total), total)).drop("_tsys", "_tau")
    middle = A.scalar(ranks.quantiles(raw.where("_sum is not null"), "_sum", (0.5,)).select(F.col("values")[0]))
    return raw.withColumn(name, F.coalesce(F.col("_sum") / middle, F.lit(1.0))).drop("_sum")


def channel_weights(rows: DataFrame, calibration: DataFrame, spectrum: str = "spectrum") -> DataFrame:
    """rows: row_id, tsys_id, tau_id; calibration: row_id, spectrum. Long form: row_id, pos, w = (e^-tau / Tsys)^2 over the channel's median; 1 where calibration is missing.

    Rows without calibration get 1 after the medians are taken, so that they do not weigh in them.
    """
    cal = calibration.select(F.col("row_id").alias("_id"), F.col(spectrum).alias("_s"))
    tsys = cal.select(F.col("_id").alias("tsys_id"), F.col("_s").alias("_tsys"))
    tau = cal.select(F.col("_id").alias("tau_id"), F.col("_s").alias("_tau"))
    both = rows.select("row_id", "tsys_id", "tau_id").join(tsys, "tsys_id", "left").join(tau, "tau_id", "left")
    raw = F.transform(F.arrays_zip(F.col("_tsys").alias("s"), F.col("_tau").alias("t")), lambda p: F.pow(F.exp(-p["t"]) / p["s"], F.lit(2.0)))
    long = both.where(F.col("_tsys").isNotNull() & F.col("_tau").isNotNull()).select("row_id", F.posexplode(raw).alias("pos", "_w"))
    good = long.where(A.is_finite(F.col("_w")) & (F.col("_w") > 0))
    middle = ranks.quantiles(good, "_w", (0.5,), ["pos"]).select("pos", F.col("values")[0].alias("_m"))  # one row a channel
    return long.join(F.broadcast(middle), "pos", "left").select("row_id", "pos", F.when(A.is_finite(F.col("_w")) & (F.col("_w") > 0), F.col("_w") / F.col("_m")).otherwise(1.0).alias("w"))


def grid_cube(samples: DataFrame, frame: Frame, kernel: float, spectrum: str = "spectrum", weight: Column | None = None, channel_weight: str | None = None, support: float = 3.0) -> DataFrame:
    """samples: ra, dec, spectrum. Pixels with coverage: y, x, spectrum, coverage, weight, weights (of each channel).

    Each channel uses its finite samples. Pixel sums of a batch are made where the batch is read,
    with one row a pixel, and added up per pixel after one shuffle.
    """
    reach, sigma = support * kernel, kernel / FWHM
    r = math.ceil(reach / frame.pixel) + 1
    chosen = samples.select("ra", "dec", A.as_doubles(spectrum).alias("v"), (F.lit(1.0) if weight is None else weight).alias("w"), *([A.as_doubles(channel_weight).alias("cw")] if channel_weight else []))
    kind = pa.schema([("cell", pa.int64()), ("num", pa.list_(pa.float64())), ("den", pa.list_(pa.float64())), ("cov", pa.float64()), ("wgt", pa.float64())])

    def near(ra: np.ndarray, dec: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sample, cell, kernel) of all pairs within reach."""
        d0 = np.radians(frame.dec)
        da, d = np.radians(ra - frame.ra), np.radians(dec)
        east, north = np.cos(d) * np.sin(da), np.sin(d) * np.cos(d0) - np.cos(d) * np.sin(d0) * np.cos(da)
        px = np.rint(frame.refx - np.degrees(east) / frame.pixel).astype(np.int64) - 1
        py = np.rint(frame.refy + np.degrees(north) / frame.pixel).astype(np.int64) - 1
        step = np.arange(-r, r + 1)
        x, y = np.broadcast_arrays(px[:, None, None] + step[None, None, :], py[:, None, None] + step[None, :, None])
        ok = (x >= 0) & (x < frame.nx) & (y >= 0) & (y < frame.ny)
        s = np.broadcast_to(np.arange(len(ra))[:, None, None], x.shape)[ok]
        x, y = x[ok], y[ok]
        e, n = np.radians(-(x + 1 - frame.refx) * frame.pixel), np.radians((y + 1 - frame.refy) * frame.pixel)
        depth = np.sqrt(np.maximum(0, 1 - e * e - n * n))
        cr = np.radians(frame.ra) + np.arctan2(e, np.cos(d0) * depth - np.sin(d0) * n)
        cd = np.arcsin(n * np.cos(d0) + np.sin(d0) * depth)
        a, b = np.sin((cd - d[s]) / 2), np.sin((cr - np.radians(ra[s])) / 2)
        far = np.degrees(2 * np.arcsin(np.sqrt(a * a + np.cos(cd) * np.cos(d[s]) * b * b)))
        keep = far <= reach
        return s[keep], (y * frame.nx + x)[keep], np.exp(-far[keep] ** 2 / (2 * sigma**2))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                ra, dec, w = (part.column(c).to_numpy(zero_copy_only=False) for c in ("ra", "dec", "w"))
                for rows, v in block_of(part.column("v")):
                    cw = {int(i): y[j] for i_, y in block_of(part.column("cw")) for j, i in enumerate(i_)} if channel_weight else None
                    usable = np.isfinite(w[rows]) & (w[rows] > 0) & np.isfinite(ra[rows]) & np.isfinite(dec[rows])
                    rows, v = rows[usable], v[usable]
                    if not len(rows):
                        continue
                    s, cell, k = near(ra[rows], dec[rows])
                    each = np.isfinite(v).astype(np.float64) * w[rows][:, None]
                    if cw is not None:
                        each *= np.stack([cw.get(int(i), np.ones(v.shape[1])) for i in rows])
                    cells, index = np.unique(cell, return_inverse=True)
                    matrix = np.zeros((len(cells), len(rows)))
                    np.add.at(matrix, (index, s), k)
                    num, den = matrix @ (np.where(np.isfinite(v), v, 0) * each), matrix @ each
                    yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), lists_of(list(num)), lists_of(list(den)), pa.array(matrix.sum(1)), pa.array(matrix @ w[rows])], schema=kind)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, "cell"):
            cell = table.column("cell").to_numpy()
            begin = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            num, den = (block_of(table.column(c).combine_chunks())[0][1] for c in ("num", "den"))
            num, den = np.add.reduceat(num, begin), np.add.reduceat(den, begin)
            with np.errstate(invalid="ignore", divide="ignore"):
                value = np.where(den > 0, num / den, np.nan)
            cov, wgt = (np.add.reduceat(table.column(c).to_numpy(), begin) for c in ("cov", "wgt"))
            ids = cell[begin]
            yield pa.RecordBatch.from_arrays([pa.array((ids // frame.nx).astype(np.int32)), pa.array((ids % frame.nx).astype(np.int32)), lists_of(list(value)), pa.array(cov), pa.array(wgt), lists_of(list(den))], ["y", "x", "spectrum", "coverage", "weight", "weights"])

    sums = chosen.mapInArrow(add, "cell long, num array<double>, den array<double>, cov double, wgt double")
    return sums.repartition("cell").sortWithinPartitions("cell").mapInArrow(merge, "y int, x int, spectrum array<double>, coverage double, weight double, weights array<double>")


def integrated_map(samples: DataFrame, frame: Frame, kernel: float, first: int, last: int, deltav: float, spectrum: str = "spectrum", weight: Column | None = None) -> DataFrame:
    """Map of the sum over channels first..last; also times the channel width, in K m/s."""
    summed = samples.withColumn("_sum", A.total(A.where_index(spectrum, lambda i: (i >= first) & (i <= last))))
    return grid_map(summed, frame, kernel, "_sum", weight).withColumn("integral", F.col("value") * abs(deltav))


def compare_integrated(stages: dict[str, DataFrame], frame: Frame, kernel: float, first: int, last: int, deltav: float, spectrum: str = "spectrum") -> DataFrame:
    """Integrated maps of several stages of one data set on one frame: stage and the columns of integrated_map."""
    out = None
    for name, samples in stages.items():
        one = integrated_map(samples, frame, kernel, first, last, deltav, spectrum).select(F.lit(name).alias("stage"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def regrid(map_: DataFrame, source: Frame, target: Frame, kernel: float) -> DataFrame:
    """A map's pixels gridded into another frame; pixels whose nearest source pixel has no value are left out."""
    ra, dec = _center(source, F.col("x"), F.col("y"))
    samples = map_.where(A.is_finite(F.col("value"))).select(F.degrees(ra).alias("ra"), F.degrees(dec).alias("dec"), "value")
    fresh = grid_map(samples, target, kernel)
    tra, tdec = _center(target, F.col("x"), F.col("y"))
    px, py = _project(source, F.degrees(tra), F.degrees(tdec))
    there = map_.where(A.is_finite(F.col("value"))).select(F.col("x").alias("_x"), F.col("y").alias("_y"))
    return fresh.withColumns({"_x": (F.rint(px) - 1).cast("int"), "_y": (F.rint(py) - 1).cast("int")}).join(there, ["_x", "_y"], "left_semi").drop("_x", "_y")
