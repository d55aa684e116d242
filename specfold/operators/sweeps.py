"""Corrections of the same rows with many settings at once: noise and line flux that each setting would leave.

Models are fitted once, with as many components as any setting asks for. What a correction leaves on a set of channels follows from a spectrum's
sums there, its products with the components and those of the components with each other; these are taken once a
spectrum, so a further setting costs arithmetic with components, none with channels, and no second pass over the rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specfold.functions import arrays as A
from specfold.functions import kernels as K
from specfold.operators.kernel_ops import block_of
from specfold.operators.modelled import GROUP, MOST_BYTES, by_model

SUMS = ("noise_before", "noise", "flux_before", "flux", "n_used")


@dataclass(frozen=True)
class Setting:
    """Number of components and gates of one correction."""

    n_components: int
    gates: K.Gates = K.Gates()


def settings_of(n_components: Sequence[int], variance: Sequence[float] = (0.0,), coefficient: Sequence[float] = (0.0,), noise: Sequence[float] = (np.inf,), smooth: Sequence[int] = (5,), least_squares: Sequence[bool] = (True,)) -> list[Setting]:
    """All combinations, the last varying fastest."""
    return [Setting(k, K.Gates(*gates)) for k, *gates in itertools.product(n_components, variance, coefficient, noise, smooth, least_squares)]


def sweep(rows: DataFrame, models: DataFrame, settings: Sequence[Setting], window: tuple[int, int], spectrum: str = "spectrum", most_bytes: int = MOST_BYTES) -> DataFrame:
    """For each group of rows and setting what the correction with that setting (as learned.correct, without masks) would leave.

    rows: row_id, mission_id, telescop, spectrum. mission_id, telescop, setting (its place in the list), n_rows, the means over rows of
    noise_before and noise (deviation over the finite channels outside window), flux_before and flux (sum of the finite ones inside) and n_used.
    Rows of groups without a model stay as they are and use none; rows without a finite channel outside the window are not counted.
    """
    settings = list(settings)
    if not settings:
        raise ValueError("no settings to compare")
    work = rows.select("row_id", *GROUP, A.as_doubles(spectrum).alias("s"))

    def parse(m: dict) -> tuple:
        return np.array(m["components"], np.float64), np.array(m["ratio"], np.float64), m["ch_first"], m["ch_last"]

    def kernel(part: pa.RecordBatch, model: tuple | None) -> pa.RecordBatch:
        n, totals = 0, np.zeros((len(SUMS), len(settings)))
        for _, y in block_of(part.column("s")):
            more, sums = left_by(y, model, settings, window)
            n, totals = n + more, totals + sums
        one = part.slice(0, 1)
        return pa.RecordBatch.from_arrays([*(one.column(c) for c in GROUP), pa.array([n] * one.num_rows, pa.int64()), *(pa.array([t.tolist()] * one.num_rows, pa.list_(pa.float64())) for t in totals)], [*GROUP, "n", *SUMS])

    sums = by_model(work, models.select(*GROUP, "components", "ratio", "ch_first", "ch_last"), parse, kernel, f"mission_id string, telescop string, n long, {', '.join(f'{c} array<double>' for c in SUMS)}", most_bytes)
    each = sums.select(*GROUP, "n", F.posexplode(F.arrays_zip(*SUMS)).alias("setting", "sums"))
    totals = each.groupBy(*GROUP, "setting").agg(F.sum("n").alias("n_rows"), *(F.sum(f"sums.{c}").alias(c) for c in SUMS))
    return totals.where("n_rows > 0").select(*GROUP, "setting", "n_rows", *((F.col(c) / F.col("n_rows")).alias(c) for c in SUMS))


def best_settings(found: DataFrame, least_flux: float = 0.9) -> DataFrame:
    """Of each group the setting that leaves the least noise among those that keep at least that share of the line's flux, the first of equals; the sweep's row."""
    kept = found.where(F.abs("flux") >= least_flux * F.abs("flux_before"))
    value = F.struct("noise", "setting", *(c for c in found.columns if c not in (*GROUP, "noise", "setting")))
    return kept.groupBy(*GROUP).agg(F.min(value).alias("_best")).select(*GROUP, "_best.*").select(*found.columns)


def left_by(y: np.ndarray, model: tuple | None, settings: Sequence[Setting], window: tuple[int, int]) -> tuple[int, np.ndarray]:
    """How many rows of y count, and over them the sums of SUMS for each setting."""
    finite = np.isfinite(y)
    free = np.ones(y.shape[1], bool)
    free[window[0] : window[1]] = False
    counted = (finite & free).any(1)
    y, finite = y[counted], finite[counted]
    totals = np.zeros((len(SUMS), len(settings)))
    if not len(y):
        return 0, totals
    # rows with the same channels share all products of components
    use = finite & (y != 0)
    _, first, kind = np.unique(np.packbits(np.concatenate([finite, use], 1), axis=1), axis=0, return_index=True, return_inverse=True)
    for k, at in enumerate(first.tolist()):
        own = np.flatnonzero(kind.ravel() == k)
        totals += _alike(y[own], finite[at], use[at], free, model, settings)
    return len(y), totals


def _alike(y: np.ndarray, finite: np.ndarray, use: np.ndarray, free: np.ndarray, model: tuple | None, settings: Sequence[Setting]) -> np.ndarray:
    """Sums over rows with the same finite channels and the same used ones."""
    clean = np.where(finite, y, 0.0)
    off, line = finite & free, finite & ~free
    middle = clean[:, off].mean(1)  # sums about the rows' means, so that squares do not cancel
    before, flux = ((clean[:, off] - middle[:, None]) ** 2).mean(1), clean[:, line].sum(1)
    totals = np.empty((len(SUMS), len(settings)))
    totals[:] = np.array([np.sqrt(before).sum(), np.sqrt(before).sum(), flux.sum(), flux.sum(), 0])[:, None]
    if model is None:
        return totals
    parts, share, a, b = model[0], model[1], model[2], model[3] + 1
    whole = np.zeros((len(parts), y.shape[1]))
    whole[:, a:b] = parts
    inside = use[a:b]
    gram, dot = parts[:, inside] @ parts[:, inside].T, clean[:, a:b][:, inside] @ parts[:, inside].T
    centred = whole[:, off] - whole[:, off].mean(1, keepdims=True)
    cross, square, lost = (clean[:, off] - middle[:, None]) @ centred.T / off.sum(), centred @ centred.T / off.sum(), whole[:, line].sum(1)
    spread = parts.std(1)
    deviation = {w: K.smooth(K.interpolated(np.where(inside, clean[:, a:b], np.nan)), w)[:, inside].std(1) for w in {s.gates.smooth for s in settings}} if inside.any() else {}
    solved: dict[tuple, np.ndarray] = {}
    left: dict[tuple, tuple[float, float]] = {}

    def coefficients(which: tuple[int, ...], least_squares: bool) -> np.ndarray:
        """Of all rows on these components, as kernels.coefficients."""
        at = (which, least_squares)
        if at not in solved:
            pick = list(which)
            if inside.all():
                solved[at] = dot[:, pick]
            elif least_squares:
                solved[at] = np.linalg.lstsq(gram[np.ix_(pick, pick)], dot[:, pick].T, rcond=None)[0].T
            else:
                norm = gram[pick, pick]
                solved[at] = np.where(norm > 0, dot[:, pick] / np.where(norm > 0, norm, 1), 0.0)
        return solved[at]

    for place, setting in enumerate(settings):
        k, gates = min(setting.n_components, len(parts)), setting.gates
        if inside.sum() <= k or k < 1:
            continue
        c = coefficients(tuple(range(k)), gates.least_squares)
        part, spec = np.abs(c) * spread[:k], deviation[gates.smooth][:, None]
        ratio = np.where(part < 1e-15, 1e10, np.where(spec < 1e-15, 1e5, spec / np.where(part < 1e-15, 1, part)))
        keep = (share[:k] > gates.variance) & (np.abs(c) >= gates.coefficient)
        if np.isfinite(gates.noise):
            keep &= ~(ratio > gates.noise)
        at = (keep.tobytes(), k, gates.least_squares or inside.all())
        if at not in left:  # settings that keep the same components leave the same
            g = np.zeros((len(y), k))
            if inside.all():
                g = np.where(keep, c, 0.0)
            else:
                patterns, kind = np.unique(keep, axis=0, return_inverse=True)
                for i, pattern in enumerate(patterns):
                    pick = np.flatnonzero(pattern)
                    own = np.flatnonzero(kind.ravel() == i)
                    if len(pick):
                        g[np.ix_(own, pick)] = coefficients(tuple(pick.tolist()), gates.least_squares)[own]
            after = before - 2 * (g * cross[:, :k]).sum(1) + ((g @ square[:k, :k]) * g).sum(1)
            left[at] = np.sqrt(np.maximum(after, 0)).sum(), (flux - g @ lost[:k]).sum()
        totals[1, place], totals[3, place] = left[at]
        totals[4, place] = keep.sum()
    return totals
