"""Correction of coefficients by the rotation that turns the science rows' principal directions into the reference rows'.

Rows are projected onto their model. Within a group, the scatter matrices of both sets of coefficients give their principal directions, and
the correction is their rotation times the ratio of the mean coefficients. A direction is signed so that its largest
entry is positive, so that the matrix depends on the data alone. Corrected coefficients are turned into spectra again.

Only sums pass between tasks: number, means and k x k cross-products of each set. Rows that miss a channel of their model have no coefficients;
rows of groups without a model, without two rows of either kind, or with rows of no finite coefficients stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specfold.functions import arrays as A
from specfold.operators.kernel_ops import block_of, lists_of
from specfold.operators.modelled import GROUP, MOST_BYTES, by_model, finite_rows, runs_of

SUMS = "mission_id string, telescop string, n long, mean array<double>, cross array<array<double>>"
MATRICES = "mission_id string, telescop string, n_reference long, n_science long, matrix array<array<double>>, residual_rms double, condition_number double, strength array<double>"
#: Mean coefficients nearer to 0 than this are not scaled.
LEAST_MEAN = 1e-10


class Basis:
    """Mean and components of a model on its channels."""

    def __init__(self, row: dict):
        self.parts = np.array(row["components"], np.float64)
        self.first = row["ch_first"]
        self.mean = np.array(row["mean"], np.float64)
        self.end = self.first + self.parts.shape[1]


def projected(rows: DataFrame, models: DataFrame, spectrum: str = "spectrum", most_bytes: int = MOST_BYTES) -> DataFrame:
    """rows: row_id, mission_id, telescop, spectrum. Adds coefficients: the spectrum less the model's mean, on its components; null where a channel is missing or there is no model."""
    work = rows.withColumn(spectrum, A.as_doubles(spectrum))
    schema = work.withColumn("coefficients", F.lit(None).cast("array<double>")).schema

    def kernel(part: pa.RecordBatch, model: Basis | None) -> pa.RecordBatch:
        out: list[np.ndarray | None] = [None] * part.num_rows
        if model is not None:
            for at, y in block_of(part.column(spectrum)):
                if y.shape[1] >= model.end:
                    y = y[:, model.first : model.end]
                    good = finite_rows(y)
                    for r, c in zip(at[good].tolist(), (y[good] - model.mean) @ model.parts.T, strict=True):
                        out[r] = c
        return pa.RecordBatch.from_arrays([*part.columns, lists_of(out)], [*part.schema.names, "coefficients"])

    return by_model(work, models, Basis, kernel, schema, most_bytes)


def _joined(a: tuple, b: tuple) -> tuple:
    """Number, means and cross-products about the means of two sets taken together."""
    n, step = a[0] + b[0], b[1] - a[1]
    return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)


def coefficient_sums(coefficients: DataFrame) -> DataFrame:
    """Per group: how many rows have coefficients, their means, and the sums of products of their deviations."""
    kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.list_(pa.float64())))

    def listed(held: dict[tuple, tuple]) -> pa.RecordBatch:
        rows = [(*key[:2], v[0], v[1].tolist(), v[2].tolist()) for key, v in held.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [*GROUP, "n", "mean", "cross"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in GROUP), strict=True))
            for at, c in block_of(batch.column("coefficients")):
                for key, places in runs_of([keys[r] for r in at.tolist()]):
                    own = c[places]
                    mean = own.mean(0)
                    more = (len(own), mean, (own - mean).T @ (own - mean))
                    of = (*key, c.shape[1])
                    held[of] = _joined(held[of], more) if of in held else more
        yield listed(held)

    def merge(table: pa.Table) -> pa.Table:
        parts = [(p["n"], np.array(p["mean"]), np.array(p["cross"])) for p in table.to_pylist()]
        total = parts[0]
        for p in parts[1:]:
            total = _joined(total, p)
        return pa.Table.from_batches([listed({(*(table.column(c)[0].as_py() for c in GROUP), 0): total})])

    known = coefficients.where("coefficients is not null").select(*[F.col(c).cast("string").alias(c) for c in GROUP], "coefficients")
    return known.mapInArrow(partial, SUMS).groupBy(*GROUP).applyInArrow(merge, SUMS)


def directions(cross: np.ndarray) -> np.ndarray:
    """Principal directions of a scatter matrix as columns, the largest first, each with its largest entry positive."""
    u = np.linalg.svd(cross)[0]
    top = u[np.argmax(np.abs(u).round(12), 0), np.arange(u.shape[1])]
    return u * np.where(top < 0, -1.0, 1.0)


def correction_matrix(mean_r: np.ndarray, cross_r: np.ndarray, mean_s: np.ndarray, cross_s: np.ndarray) -> np.ndarray:
    scale = np.where(np.abs(mean_s) > LEAST_MEAN, mean_r / np.where(mean_s == 0, 1, mean_s), 1.0)
    return scale[:, None] * (directions(cross_r) @ directions(cross_s).T)


def matrices(reference: DataFrame, science: DataFrame) -> DataFrame:
    """From the sums of both sets: each group's matrix, the distance that it leaves between the means, its condition number, and its rows' lengths."""
    named = lambda df, s: df.select(*GROUP, *[F.col(c).alias(f"{c}_{s}") for c in ("n", "mean", "cross")])
    both = named(reference, "r").join(named(science, "s"), list(GROUP)).where("n_r > 1 and n_s > 1 and size(mean_r) = size(mean_s)")
    names = [f.split()[0] for f in MATRICES.split(", ")]
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.float64())), pa.float64(), pa.float64(), pa.list_(pa.float64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for g in batch.to_pylist():
                mr, xr, ms, xs = (np.array(g[c]) for c in ("mean_r", "cross_r", "mean_s", "cross_s"))
                m = correction_matrix(mr, xr, ms, xs)
                out.append((g["mission_id"], g["telescop"], g["n_r"], g["n_s"], m.tolist(), float(np.linalg.norm(mr - m @ ms)), float(np.linalg.cond(m)), np.linalg.norm(m, axis=1).tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names)

    return both.mapInArrow(run, MATRICES)


def turned(matrix: Column, coefficients: Column) -> Column:
    """The matrix times the coefficients."""
    return F.transform(matrix, lambda row: F.aggregate(F.zip_with(row, coefficients, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x))


def corrected(coefficients: DataFrame, found: DataFrame) -> DataFrame:
    """Adds corrected: the coefficients by their group's matrix; without one, as they are."""
    few = found.select(*GROUP, F.col("matrix").alias("_matrix"))
    both = coefficients.join(few, list(GROUP), "left")
    value = F.when(F.col("_matrix").isNull() | F.col("coefficients").isNull(), F.col("coefficients")).otherwise(turned(F.col("_matrix"), F.col("coefficients")))
    return both.withColumn("corrected", value).drop("_matrix")


def rebuilt(rows: DataFrame, models: DataFrame, of: str = "corrected", spectrum: str = "spectrum", most_bytes: int = MOST_BYTES) -> DataFrame:
    """The spectrum that the coefficients `of` give, on the model's channels; other channels, and rows without coefficients, as they are."""
    schema = rows.schema

    def kernel(part: pa.RecordBatch, model: Basis | None) -> pa.RecordBatch:
        values = part.column(spectrum).to_pylist()
        out = [None if v is None else np.array([np.nan if x is None else x for x in v], np.float64) for v in values]
        for at, c in block_of(part.column(of)) if model else ():
            if c.shape[1] == len(model.parts):
                for r, x in zip(at.tolist(), c @ model.parts + model.mean, strict=True):
                    out[r][model.first : model.end] = x
        return pa.RecordBatch.from_arrays([lists_of(out) if n == spectrum else part.column(n) for n in part.schema.names], part.schema.names)

    return by_model(rows, models, Basis, kernel, schema, most_bytes)


def correction_strength(rows: DataFrame) -> DataFrame:
    """Per group and component: the mean sizes of coefficients before and after, and their difference."""
    known = rows.where("coefficients is not null").select(*GROUP, F.posexplode(F.arrays_zip("coefficients", "corrected")).alias("component", "_c"))
    size = lambda c: F.avg(F.abs(F.col(f"_c.{c}")))
    return known.groupBy(*GROUP, "component").agg(size("coefficients").alias("before"), size("corrected").alias("after")).withColumn("change", F.col("before") - F.col("after"))


def rotate(reference: DataFrame, science: DataFrame, models: DataFrame, folder: str | None = None, spectrum: str = "spectrum") -> DataFrame:
    """The whole correction: science rows with the spectra that their corrected coefficients give, coefficients and corrected.

    With a folder, both sets' sums are written there first, and rows are read once more for the result alone.
    """
    sums = [coefficient_sums(projected(r.select("row_id", *GROUP, spectrum), models, spectrum)) for r in (reference, science)]
    if folder:
        for name, s in zip(("reference", "science"), sums, strict=True):
            s.write.mode("overwrite").parquet(f"{folder}/sums-{name}")
        sums = [science.sparkSession.read.schema(SUMS).parquet(f"{folder}/sums-{name}") for name in ("reference", "science")]
    return rebuilt(corrected(projected(science, models, spectrum), matrices(*sums)), models, "corrected", spectrum)
