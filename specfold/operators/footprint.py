"""Footprints of maps: holes inside them, and rings off their outer edge.

A hole is a part of the background that no path of pixels side by side joins to the border of the frame. The frame is cut
into strips of whole rows; a task floods its strip from the border and from what the strips beside it know to be
outside, and says which runs of its first and last row are. Rounds end when no strip learns more, after as many as the background winds
between strips; each is a small written table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specfold.functions import arrays as A
from specfold.work import work_folder, written

#: Pixels of a strip.
STRIP_PIXELS = 4_000_000
RUNS = "y int, first int, last int"


def flooded(background: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The background that is joined to a seed, row by row downwards and upwards until nothing is added."""
    out = seeds & background
    starts = np.zeros(background.shape, np.int64)
    starts[:, 0] = background[:, 0]
    starts[:, 1:] = background[:, 1:] & ~background[:, :-1]
    run = np.cumsum(starts, 1)

    def spread(y: int, more: np.ndarray) -> None:
        seen = np.zeros(int(run[y, -1]) + 1, bool)
        seen[run[y][(out[y] | more) & background[y]]] = True
        seen[0] = False
        out[y] = seen[run[y]] & background[y]

    before = -1
    while (now := int(out.sum())) != before or before < 0:
        before = now
        for y in range(len(out)):
            spread(y, out[y - 1] if y else out[y])
        for y in reversed(range(len(out))):
            spread(y, out[y + 1] if y + 1 < len(out) else out[y])
        if int(out.sum()) == before:
            break
    return out


def runs(mask: np.ndarray, y0: int, rows: list[int]) -> pa.Table:
    """Runs of true pixels of some rows of a strip that begins at row y0."""
    found = []
    for r in rows:
        edges = np.flatnonzero(np.diff(np.concatenate([[0], mask[r].astype(np.int8), [0]])))
        found += [(y0 + r, int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return pa.table([pa.array([f[i] for f in found], pa.int32()) for i in range(3)], ["y", "first", "last"])


def _strip(key: tuple, pixels: pa.Table, outside: pa.Table, height: int, ny: int, nx: int) -> tuple[int, np.ndarray, np.ndarray]:
    """First row of a strip, its background, and what of that is outside as far as is known."""
    y0 = key[0].as_py() * height
    n = min(height, ny - y0)
    background = np.ones((n, nx), bool)
    known = pixels.filter(pc.is_valid(pixels.column("y")))
    background[known.column("y").to_numpy() - y0, known.column("x").to_numpy()] = False
    seeds = np.zeros((n, nx), bool)
    seeds[:, [0, -1]] = True
    if y0 == 0:
        seeds[0] = True
    if y0 + n == ny:
        seeds[-1] = True
    for y, first, last in zip(*(outside.column(c).to_pylist() for c in ("y", "first", "last")), strict=True):
        seeds[0 if y < y0 else n - 1, first : last + 1] = True
    return y0, background, flooded(background, seeds)


def holes(footprint: DataFrame, ny: int, nx: int, folder: str | None = None, strip_pixels: int = STRIP_PIXELS) -> DataFrame:
    """footprint: y, x, each pixel once, in a frame of ny x nx. The pixels y, x of its holes."""
    spark = footprint.sparkSession
    height = max(1, strip_pixels // nx)
    strips = -(-ny // height)
    strip = F.floor(F.col("y") / height).cast("int")
    every = spark.range(strips).select(F.col("id").cast("int").alias("strip"), F.lit(None).cast("int").alias("y"), F.lit(None).cast("int").alias("x"))
    pixels = footprint.where(F.col("y").between(0, ny - 1) & F.col("x").between(0, nx - 1)).select(strip.alias("strip"), F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x")).unionByName(every)

    def edges(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        y0, _, out = _strip(key, left, right, height, ny, nx)
        return runs(out, y0, sorted({0, len(out) - 1}))

    def inner(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        y0, background, out = _strip(key, left, right, height, ny, nx)
        return runs(background & ~out, y0, list(range(len(out))))

    told = spark.createDataFrame([], f"strip int, {RUNS}")
    if strips > 1:
        folder = folder or work_folder(spark)
        pixels, seen, turn = written(pixels, f"{folder}/footprint"), None, 0
        while True:
            found = written(pixels.groupBy("strip").cogroup(told.groupBy("strip")).applyInArrow(edges, RUNS), f"{folder}/outside-{turn}")
            total = found.agg(F.sum(F.col("last") - F.col("first") + 1)).first()[0]
            # a strip's last row is told to the next one, its first row to the one before
            beside = found.withColumn("strip", F.explode(F.array(*[F.floor((F.col("y") + d) / height).cast("int") for d in (-1, 1)])))
            told = beside.where((F.col("strip") != strip) & F.col("strip").between(0, strips - 1))
            if total == seen:
                break
            seen, turn = total, turn + 1
    found = pixels.groupBy("strip").cogroup(told.groupBy("strip")).applyInArrow(inner, RUNS)
    return found.select("y", F.explode(F.sequence("first", "last")).alias("x"))


def eroded(filled: DataFrame, rings: int) -> DataFrame:
    """Pixels y, x whose neighbours up to so many pixels in any direction are all there: first along rows, then along columns."""
    n = 2 * rings + 1
    for along, across in (("x", "y"), ("y", "x")):
        seen = filled.select(across, F.explode(F.sequence(F.col(along) - rings, F.col(along) + rings)).alias(along))
        filled = seen.groupBy("y", "x").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == n).select("y", "x")
    return filled


def trimmed(map_: DataFrame, rings: int, ny: int, nx: int, folder: str | None = None, strip_pixels: int = STRIP_PIXELS) -> DataFrame:
    """The map's pixels with values but the outermost so many rings, corners included; pixels round holes stay. A trim that would leave nothing is not done."""
    good = map_.where(A.is_finite(F.col("value")))
    if rings <= 0:
        return good
    pixels = good.select("y", "x").distinct()
    inside = eroded(pixels.unionByName(holes(pixels, ny, nx, folder, strip_pixels)).where(F.col("y").between(0, ny - 1) & F.col("x").between(0, nx - 1)), rings)
    marked = good.join(inside.withColumn("_in", F.lit(True)), ["y", "x"], "left")
    none = A.scalar(marked.agg(F.count("_in") == 0))
    return marked.where(F.col("_in") | none).drop("_in")


#: Arc seconds of the units of a border; without a unit, or with %, it is a share of the map's shorter side.
UNITS = {"arcmin": 60.0, "am": 60.0, "'": 60.0, "arcsec": 1.0, "as": 1.0, '"': 1.0}


def border_rings(trim: str, pixel_arcsec: float, ny: int, nx: int) -> int:
    """Rings of a border such as "5%", "5", "20arcsec" or "0.5'"; 0 if it cannot be read."""
    text = trim.strip().lower()
    unit = next((u for u in UNITS if text.endswith(u)), None)
    try:
        number = float(text.removesuffix(unit or "%"))
    except ValueError:
        return 0
    return max(0, round(number * UNITS[unit] / pixel_arcsec if unit else min(ny, nx) * number / 100))
