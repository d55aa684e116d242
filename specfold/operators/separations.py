"""Sparse and independent components of groups of spectra, components of very wide ones, and how structured a component is.

Rows of a group (mission and telescope) of the length that most of them have, with all channels finite, are centred; null keys are left out.

* sparse: U V with V sparse, least 1/2 |X - U V|^2 + alpha |V|_1 for columns of U no longer than 1, by alternating soft-threshold steps for V
  and block updates of U. Both need X only through its triangular factor, which tasks add up as for principal components.
* independent: rows are whitened by that factor and written once with k numbers each; fixed-point rounds (tanh) follow, whose sums run over all
  rows, each a written table, until the directions of every group stand still.
* wide: subspace iterations hold channels x (k + extra) numbers a group, whatever the number of channels; a pass reads the rows once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from specfold.functions import arrays as A
from specfold.functions import kernels as K
from specfold.operators.kernel_ops import block_of, lists_of
from specfold.operators.modelled import GROUP, MOST_BYTES, by_model, runs_of
from specfold.work import work_folder, written

FOUND = "mission_id string, telescop string, n_rows long, mean array<double>, components array<array<double>>"
_MOMENTS = "mission_id string, telescop string, n long, mean binary, triangle binary"
_ADDED = "mission_id string, telescop string, n long, y array<double>, all double"
#: Bytes of triangular factors that a task holds before it hands them on.
HELD_BYTES = 64_000_000


def _complete(rows: DataFrame, spectrum: str) -> DataFrame:
    """row_id, group, s of the rows that are fitted."""
    own = rows.where("mission_id is not null and telescop is not null").select("row_id", *[F.col(c).cast("string").alias(c) for c in GROUP], A.as_doubles(spectrum).alias("s"))
    good = own.where(F.col("s").isNotNull() & (F.size("s") > 0) & ~F.exists("s", lambda x: x.isNull() | ~A.is_finite(x)))
    sizes = good.groupBy(*GROUP, F.size("s").alias("_size")).agg(F.count(F.lit(1)).alias("_n"))
    first = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("_n"), "_size"))
    return good.join(sizes.withColumn("_r", first).where("_r = 1").select(*GROUP, "_size"), list(GROUP)).where(F.size("s") == F.col("_size")).drop("_size")


def _by_group(batch: pa.RecordBatch, column: str = "s") -> Iterator[tuple[tuple, np.ndarray]]:
    keys = list(zip(*(batch.column(c).to_pylist() for c in GROUP), strict=True))
    for at, y in block_of(batch.column(column)):
        for key, places in runs_of([keys[r] for r in at.tolist()]):
            yield key, y[places]


def _every(mean: np.ndarray) -> np.ndarray:
    return np.ones(len(mean), bool)


def _held(rows: list[dict]) -> tuple[int, np.ndarray, np.ndarray]:
    known = None
    for p in rows:
        mean = np.frombuffer(p["mean"])
        more = (p["n"], mean, np.frombuffer(p["triangle"]).reshape(-1, len(mean)))
        known = more if known is None else K.joined_moments(known, more, _every(mean))
    return known


def _from_moments(rows: DataFrame, finish, schema: str) -> DataFrame:
    """finish(key, (n, mean, triangular factor)) of each group, an Arrow table."""

    def listed(held: dict[tuple, tuple]) -> pa.RecordBatch:
        parts = [(*key, m[0], m[1].tobytes(), np.ascontiguousarray(m[2]).tobytes()) for key, m in held.items()]
        kinds = (pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in parts], k) for i, k in enumerate(kinds)], [*GROUP, "n", "mean", "triangle"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            for key, y in _by_group(batch):
                more = K.moments(y, _every(y[0]))
                held[key] = K.joined_moments(held[key], more, _every(more[1])) if key in held else more
            if sum(m[2].nbytes for m in held.values()) > HELD_BYTES:
                yield listed(held)
                held.clear()
        yield listed(held)

    def merge(table: pa.Table) -> pa.Table:
        key = tuple(table.column(c)[0].as_py() for c in GROUP)
        return pa.Table.from_batches([listed({key: _held(table.to_pylist())})])

    def last(table: pa.Table) -> pa.Table:
        return finish(tuple(table.column(c)[0].as_py() for c in GROUP), _held(table.to_pylist()))

    sums = rows.mapInArrow(partial, _MOMENTS).withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(32)))
    return sums.groupBy(*GROUP, "slot").applyInArrow(lambda t: merge(t.drop_columns("slot")), _MOMENTS).groupBy(*GROUP).applyInArrow(last, schema)


def _found(key: tuple, n: int, mean: np.ndarray, parts: np.ndarray) -> pa.Table:
    return pa.table([pa.array([key[0]], pa.string()), pa.array([key[1]], pa.string()), pa.array([n], pa.int64()), pa.array([mean.tolist()], pa.list_(pa.float64())), pa.array([parts.tolist()], pa.list_(pa.list_(pa.float64())))], [*GROUP, "n_rows", "mean", "components"])


def signed(parts: np.ndarray) -> np.ndarray:
    """Components whose largest entry is positive."""
    return parts * np.where(parts[np.arange(len(parts)), np.abs(parts).argmax(1)] < 0, -1.0, 1.0)[:, None]


def sparse_factors(x: np.ndarray, k: int, alpha: float, rounds: int = 2_000, tol: float = 1e-10) -> np.ndarray:
    """The sparse components of centred rows, or of their triangular factor, each of length 1 (or 0 if alpha leaves none of it)."""
    u, s, v = np.linalg.svd(x, full_matrices=False)
    u, v = u[:, :k].copy(), s[:k, None] * v[:k]
    before = np.inf
    for _ in range(rounds):
        gram, cross = u.T @ u, u.T @ x
        for _ in range(200):
            old = v.copy()
            for j in range(len(v)):
                if gram[j, j] > 0:
                    pull = cross[j] - gram[j] @ v + gram[j, j] * v[j]
                    v[j] = np.sign(pull) * np.maximum(np.abs(pull) - alpha, 0) / gram[j, j]
            if np.abs(v - old).max() <= 1e-13 * max(1.0, np.abs(v).max()):
                break
        for j in range(len(v)):
            if v[j].any():
                pull = x @ v[j] - u @ (v @ v[j]) + u[:, j] * (v[j] @ v[j])
                length = np.linalg.norm(pull)
                if length > 0:
                    u[:, j] = pull / length
        now = 0.5 * ((x - u @ v) ** 2).sum() + alpha * np.abs(v).sum()
        if before - now <= tol * max(1.0, abs(now)):
            break
        before = now
    length = np.linalg.norm(v, axis=1, keepdims=True)
    return signed(v / np.where(length > 0, length, 1))


def sparse_components(rows: DataFrame, k: int, alpha: float = 1.0, spectrum: str = "spectrum") -> DataFrame:
    """rows: row_id, mission_id, telescop, spectrum. Each group's mean and up to k sparse components."""

    def finish(key: tuple, known: tuple) -> pa.Table:
        n, mean, triangle = known
        return _found(key, n, mean, sparse_factors(triangle, min(k, *triangle.shape), alpha) if n > 1 else np.zeros((0, len(mean))))

    return _from_moments(_complete(rows, spectrum), finish, FOUND).where("size(components) > 0")


def orthogonal(w: np.ndarray) -> np.ndarray:
    """The nearest matrix of orthonormal rows."""
    u, _, v = np.linalg.svd(w, full_matrices=False)
    return u @ v


def first_turn(k: int, seed: int) -> np.ndarray:
    return orthogonal(np.random.default_rng(seed).normal(size=(k, k)))


def independent_components(rows: DataFrame, k: int, seed: int = 0, tol: float = 1e-6, rounds: int = 200, spectrum: str = "spectrum", folder: str | None = None, most_bytes: int = MOST_BYTES) -> DataFrame:
    """rows: row_id, mission_id, telescop, spectrum. Each group's mean and k components whose products with its centred rows are independent sources of unit variance.

    Groups with fewer than k directions are left out. Components are found up to their sign (the largest entry is positive) and order. n_rounds tells how many rounds were run.
    """
    spark = rows.sparkSession
    folder = folder or work_folder(spark)
    good = written(_complete(rows, spectrum), f"{folder}/rows")

    def whiten(key: tuple, known: tuple) -> pa.Table:
        n, mean, triangle = known
        _, s, v = np.linalg.svd(triangle, full_matrices=False)
        full = n > 1 and len(s) >= k and s[k - 1] > 1e-10 * s[0]
        return _found(key, n, mean, signed(v[:k]) / s[:k, None] * np.sqrt(n) if full else np.zeros((0, len(mean))))

    white = written(_from_moments(good, whiten, FOUND).where("size(components) > 0"), f"{folder}/white")
    parse = lambda m: (np.array(m["components"], np.float64), np.array(m["mean"], np.float64))

    def coordinates(part: pa.RecordBatch, model: tuple | None) -> pa.RecordBatch:
        out: list = [None] * part.num_rows
        for at, y in block_of(part.column("s")) if model else ():
            for r, z in zip(at.tolist(), (y - model[1]) @ model[0].T, strict=True):
                out[r] = z
        return pa.RecordBatch.from_arrays([*(part.column(c) for c in ("row_id", *GROUP)), lists_of(out)], ["row_id", *GROUP, "z"])

    points = by_model(good, white, parse, coordinates, "row_id long, mission_id string, telescop string, z array<double>", most_bytes)
    points = written(points.where("z is not null"), f"{folder}/points")
    turn = white.select(*GROUP, F.lit(first_turn(k, seed).tolist()).cast("array<array<double>>").alias("components"), F.lit(float("inf")).alias("moved"), F.lit(0).alias("n_rounds"))
    turn = written(turn, f"{folder}/turn-0")
    kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()))

    def sums(part: pa.RecordBatch, w: np.ndarray | None) -> pa.RecordBatch:
        rows_ = []
        for key, z in _by_group(part, "z") if w is not None else ():
            g = np.tanh(z @ w.T)
            rows_.append((*key, len(z), (g.T @ z).ravel().tolist(), (1 - g * g).sum(0).tolist()))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows_], kind) for i, kind in enumerate(kinds)], [*GROUP, "n", "_gz", "_slope"])

    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        state = right.to_pylist()[0]
        w, moved, n = np.array(state["components"]), state["moved"], state["n_rounds"]
        if left.num_rows:
            count = left.column("n").to_numpy().sum()
            gz = np.array(left.column("_gz").to_pylist()).sum(0).reshape(w.shape)
            new = orthogonal(gz / count - (np.array(left.column("_slope").to_pylist()).sum(0) / count)[:, None] * w)
            moved, w, n = float(np.abs(np.abs((new * w).sum(1)) - 1).max()), new, n + 1
        columns = [pa.array([state[c]], pa.string()) for c in GROUP]
        return pa.table([*columns, pa.array([w.tolist()], pa.list_(pa.list_(pa.float64()))), pa.array([moved]), pa.array([n], pa.int32())], [*GROUP, "components", "moved", "n_rounds"])

    for i in range(1, rounds + 1):
        still = turn.where(F.col("moved") >= tol)
        if still.isEmpty():
            break
        told = by_model(points, still.select(*GROUP, "components"), lambda m: np.array(m["components"], np.float64), sums, "mission_id string, telescop string, n long, _gz array<double>, _slope array<double>", most_bytes)
        turn = written(told.groupBy(*GROUP).cogroup(turn.groupBy(*GROUP)).applyInArrow(step, "mission_id string, telescop string, components array<array<double>>, moved double, n_rounds int"), f"{folder}/turn-{i}")

    def unmixed(table: pa.Table, right: pa.Table) -> pa.Table:
        own, state = table.to_pylist()[0], right.to_pylist()[0]
        parts = signed(np.array(state["components"]) @ np.array(own["components"]))
        out = _found((own["mission_id"], own["telescop"]), own["n_rows"], np.array(own["mean"]), parts)
        return out.append_column("n_rounds", pa.array([state["n_rounds"]], pa.int32()))

    return white.groupBy(*GROUP).cogroup(turn.groupBy(*GROUP)).applyInArrow(unmixed, f"{FOUND}, n_rounds int")


def structure_scores(models: DataFrame, window: int) -> DataFrame:
    """mission_id, telescop, component, score: a component's deviation over the mean of its deviations in windows of so many channels. Noise scores near 1, long waves high; null where no window fits or all of them are flat."""
    long = models.select(*GROUP, F.posexplode("components").alias("component", "_c"))
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("s", "q")])

    def deviation(part):
        sums = F.aggregate(part, zero, lambda a, x: F.struct((a["s"] + x).alias("s"), (a["q"] + x * x).alias("q")))
        return A.let(sums, lambda t: F.sqrt(F.greatest(F.lit(0.0), t["q"] / F.size(part) - F.pow(t["s"] / F.size(part), F.lit(2.0)))))

    starts = F.sequence(F.lit(1), F.greatest(F.size("_c") - window + 1, F.lit(1)))
    rolling = F.transform(starts, lambda i: deviation(F.slice("_c", i, F.lit(window))))
    mean = F.aggregate(rolling, F.lit(0.0), lambda a, x: a + x) / F.size(rolling)
    scored = long.select(*GROUP, "component", deviation(F.col("_c")).alias("_all"), F.when(F.size("_c") >= window, mean).alias("_mean"))
    return scored.select(*GROUP, "component", F.when(F.col("_mean") > 0, F.col("_all") / F.col("_mean")).alias("score"))


def wide_components(rows: DataFrame, k: int, extra: int = 10, tol: float = 1e-8, passes: int = 40, seed: int = 0, spectrum: str = "spectrum", folder: str | None = None, most_bytes: int = MOST_BYTES) -> DataFrame:
    """rows: row_id, mission_id, telescop, spectrum. Each group's mean, first k principal components, their variance and share of the whole, and n_passes.

    A random range of k + extra directions is multiplied by the group's scatter matrix, a pass over the rows at a time, until its first k
    principal directions move by less than tol; neither the matrix nor a triangular factor of its size is ever made.
    """
    spark = rows.sparkSession
    folder = folder or work_folder(spark)
    good = written(_complete(rows, spectrum), f"{folder}/rows")
    kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.float64()), pa.float64())

    def listed(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], [*GROUP, "n", "y", "all"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            for key, y in _by_group(batch):
                n, total = held.get(key, (0, 0.0))
                held[key] = (n + len(y), total + y.sum(0))
        yield listed([(*key, n, total.tolist(), 0.0) for key, (n, total) in held.items()])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                key = tuple(batch.column(c)[i].as_py() for c in GROUP)
                n, y, total = held.get(key, (0, 0.0, 0.0))
                held[key] = (n + batch.column("n")[i].as_py(), y + batch.column("y")[i].values.to_numpy(), total + batch.column("all")[i].as_py())
        yield listed([(*key, n, y.tolist(), total) for key, (n, y, total) in held.items()])

    columns = "mission_id string, telescop string, n_rows long, mean array<double>, components array<array<double>>, found array<array<double>>, value array<double>, total double, moved double, n_passes int"
    nested = pa.list_(pa.list_(pa.float64()))

    def state(key: tuple, n: int, mean: np.ndarray, q: np.ndarray, found: np.ndarray, value: np.ndarray, total: float, moved: float, passes_: int) -> pa.Table:
        more = {"found": pa.array([found.tolist()], nested), "value": pa.array([value.tolist()], pa.list_(pa.float64())), "total": pa.array([total]), "moved": pa.array([moved]), "n_passes": pa.array([passes_], pa.int32())}
        out = _found(key, n, mean, q)
        for name, column in more.items():
            out = out.append_column(name, column)
        return out

    def start(table: pa.Table) -> pa.Table:
        n, mean = int(table.column("n").to_numpy().sum()), np.sum(table.column("y").to_pylist(), 0)
        size = min(k + extra, len(mean), max(1, n - 1))
        q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(mean), size)))[0].T
        return state(tuple(table.column(c)[0].as_py() for c in GROUP), n, mean / n, q, np.zeros((0, 0)), np.zeros(0), 0.0, math.inf, 0)

    def multiplied(part: pa.RecordBatch, model: tuple | None) -> pa.RecordBatch:
        out = []
        for key, y in _by_group(part) if model else ():
            x = y - model[1]
            out.append((*key, len(y), ((x @ model[0].T).T @ x).ravel().tolist(), float((x * x).sum())))
        return listed(out)

    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        """The range times the scatter matrix gives the next range, and the principal directions within this one."""
        old = right.to_pylist()[0]
        key, q, before = tuple(old[c] for c in GROUP), np.array(old["components"]), np.array(old["found"])
        if not left.num_rows:
            return right
        y = np.sum(left.column("y").to_pylist(), 0).reshape(q.shape)
        value, turn = np.linalg.eigh((q @ y.T + y @ q.T) / 2)
        found = signed(turn.T[::-1][:k] @ q)
        moved = float(np.abs(found - before).max()) if before.size else math.inf
        return state(key, old["n_rows"], np.array(old["mean"]), np.linalg.qr(y.T)[0].T, found, value[::-1][:k], float(left.column("all").to_numpy().sum()), moved, old["n_passes"] + 1)

    parse = lambda m: (np.array(m["components"], np.float64), np.array(m["mean"], np.float64))
    now = written(good.mapInArrow(sums, _ADDED).groupBy(*GROUP).applyInArrow(start, columns).where("n_rows > 1"), f"{folder}/pass-0")
    for i in range(1, passes + 1):
        still = now.where(F.col("moved") > tol)
        if still.isEmpty():
            break
        added = by_model(good, still.select(*GROUP, "components", "mean"), parse, multiplied, _ADDED, most_bytes).mapInArrow(together, _ADDED)
        slots = added.withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(32))).groupBy(*GROUP, "slot").applyInArrow(lambda t: pa.Table.from_batches(list(together(t.drop_columns("slot").to_batches()))), _ADDED)
        now = written(slots.groupBy(*GROUP).cogroup(now.groupBy(*GROUP)).applyInArrow(step, columns), f"{folder}/pass-{i}")
    share = lambda d: F.transform("value", lambda v: v / d)
    return now.select(*GROUP, "n_rows", "mean", F.col("found").alias("components"), share(F.col("n_rows") - 1).alias("variance"), share(F.col("total")).alias("ratio"), "moved", "n_passes")
