"""Line detection, principal components per flight and pixel, and their correction of science rows."""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specfold.errors import NoDataError
from specfold.functions import arrays as A
from specfold.functions import kernels as K
from specfold.operators.kernel_ops import block_of, lists_of, map_arrays
from specfold.operators.modelled import GROUP, MOST_BYTES, by_model
from specfold.operators.ranks import quantiles
from specfold.operators.separations import wide_components
from specfold.work import work_folder, written

MODEL = "mission_id string, telescop string, n_rows long, mean array<double>, components array<array<double>>, variance array<double>, ratio array<double>, ch_first int, ch_last int"

_MODEL_KINDS = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.list_(pa.float64())), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int32(), pa.int32())
#: Up to so many channels components come from triangular factors (channels squared numbers), beyond by subspace iterations.
WIDE_CHANNELS = 4_096


def _stack(column: pa.ChunkedArray) -> np.ndarray:
    parts = block_of(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
    return max(parts, key=lambda p: len(p[0]))[1] if parts else np.zeros((0, 0))


def _group_blocks(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, str], np.ndarray, np.ndarray]]:
    """Group, row numbers and spectra of one length, for each group and length of a batch."""
    keys = list(zip(batch.column("mission_id").to_pylist(), batch.column("telescop").to_pylist(), strict=True))
    for rows, y in block_of(batch.column("s")):
        of: dict[tuple[str, str], list[int]] = {}
        for place, r in enumerate(rows.tolist()):
            of.setdefault(keys[r], []).append(place)
        for key, places in of.items():
            yield key, rows[places], y[places]


def _settled(rows: DataFrame, nan_below: float = 0.2) -> DataFrame:
    """rows: group, s. For each group the length of most of its spectra, and over all of those their number, first and last channel with values, and means."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def leave() -> pa.RecordBatch:
            columns = [[*k, v[0], v[1], v[2].tobytes(), v[3].tobytes(), v[4].tobytes()] for k, v in held.items()]
            types = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([c[i] for c in columns], t) for i, t in enumerate(types)], ["mission_id", "telescop", "size", "n", "kept", "some", "total", "count"])

        for batch in batches:
            for key, _, y in _group_blocks(batch):
                n = y.shape[1]
                good = y[np.isnan(y).mean(1) < nan_below] if n else y[:0]
                finite = np.isfinite(good)
                v = held.setdefault((*key, n), [0, 0, np.zeros(n, bool), np.zeros(n), np.zeros(n, np.int64)])
                held[(*key, n)] = [v[0] + len(y), v[1] + len(good), v[2] | (~np.isnan(good)).any(0), v[3] + np.where(finite, good, 0).sum(0), v[4] + finite.sum(0)]
            if sum(17 * k[2] for k in held) > 64_000_000:
                yield leave()
                held.clear()
        yield leave()

    def settle(table: pa.Table) -> pa.Table:
        parts = table.to_pylist()
        number: dict[int, int] = {}
        for p in parts:
            number[p["size"]] = number.get(p["size"], 0) + p["n"]
        size = min(number, key=lambda n: (-number[n], n))
        own = [p for p in parts if p["size"] == size]
        some = np.flatnonzero(np.any([np.frombuffer(p["some"], bool) for p in own], 0))
        if sum(p["kept"] for p in own) < 2:
            return settled_rows([])
        total, count = (np.sum([np.frombuffer(p[c], t) for p in own], 0) for c, t in (("total", np.float64), ("count", np.int64)))
        means = (total / np.maximum(count, 1))[some[0] : some[-1] + 1]
        return settled_rows([(parts[0]["mission_id"], parts[0]["telescop"], number[size], size, int(some[0]), int(some[-1]), means.tobytes())])

    def settled_rows(rows: list[tuple]) -> pa.Table:
        types = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["mission_id", "telescop", "n_rows", "size", "ch_first", "ch_last", "means"])

    partial = rows.mapInArrow(sums, "mission_id string, telescop string, size int, n long, kept long, some binary, total binary, count binary")
    return partial.groupBy(*GROUP).applyInArrow(settle, "mission_id string, telescop string, n_rows long, size int, ch_first int, ch_last int, means binary")


def fit_models(reference: DataFrame, k: int, excluded: np.ndarray | None = None, core: tuple[int, int] | None = None, smooth: int = 1, reject_sigma: float | None = None, spectrum: str = "spectrum", wide_channels: int = WIDE_CHANNELS) -> DataFrame:
    """reference: mission_id, telescop, spectrum. One row a group with its model; groups without enough rows have none.

    All rows of a group are fitted, whatever their number: tasks add up channel sums, then triangular factors of
    the levelled rows, at most channels squared numbers a group, whose singular vectors are those of the rows.
    Groups of more than wide_channels channels are fitted by subspace iterations, which hold channels times components numbers.
    Rows too far from the median score leave, by a pass of their own, with reject_sigma. n_rows tells how many it saw.
    """
    rows = _reference_groups(reference, spectrum)
    folder = work_folder(reference.sparkSession)
    settled = written(_settled(rows), f"{folder}/settled")
    known = rows.join(settled, list(GROUP)).where(F.size("s") == F.col("size"))

    def level(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, np.ndarray, np.ndarray, np.ndarray, int, int]]:
        for key, at, y in _group_blocks(batch):
            one = int(at[0])
            first, last = batch.column("ch_first")[one].as_py(), batch.column("ch_last")[one].as_py()
            out, inner = K.zones(first, last, excluded, core)
            y = y[np.isnan(y).mean(1) < 0.2]
            if len(y):
                yield key, one, K.levelled(y, first, last, np.frombuffer(batch.column("means")[one].as_py()), out | inner), out, inner, first, last

    if reject_sigma:

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for key, _, y, _, inner, _, _ in level(batch):
                    if inner.any():
                        yield pa.RecordBatch.from_arrays([pa.array([c] * len(y), pa.string()) for c in key] + [pa.array(y[:, inner].mean(1))], [*GROUP, "score"])

        scores = known.mapInArrow(score, "mission_id string, telescop string, score double")
        scores = written(scores, f"{folder}/scores")
        middles = quantiles(scores, "score", (0.5,), GROUP).select(*GROUP, F.col("values")[0].alias("middle"))
        limits = middles.join(scores.groupBy(*GROUP).agg(F.stddev_pop("score").alias("sigma")), list(GROUP))
        inside = (F.col("sigma") <= 0) | (F.abs(F.col("score") - F.col("middle")) <= reject_sigma * F.col("sigma"))
        enough = scores.join(limits, list(GROUP)).where(inside).groupBy(*GROUP).agg(F.first("middle").alias("middle"), F.first("sigma").alias("sigma"), F.count(F.lit(1)).alias("_kept"))
        known = known.join(enough.where((F.col("_kept") >= max(k + 2, 10)) & (F.col("sigma") > 0)).drop("_kept"), list(GROUP), "left")

    names = [*GROUP, "n_rows", "ch_first", "ch_last", "n", "mean", "triangle"]
    types = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    schema = "mission_id string, telescop string, n_rows long, ch_first int, ch_last int, n long, mean binary, triangle binary"

    def listed(held: dict[tuple, tuple]) -> list[pa.Array]:
        parts = [(*key, m[0], m[1].tobytes(), m[2].tobytes()) for key, m in held.items()]
        return [pa.array([p[i] for p in parts], t) for i, t in enumerate(types)]

    def add(held: dict[tuple, tuple], key: tuple, more: tuple, use: np.ndarray) -> None:
        held[key] = K.joined_moments(held[key], more, use) if key in held else more

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            for key, one, y, out, inner, first, last in level(batch):
                if reject_sigma and (sigma := batch.column("sigma")[one].as_py()) is not None and inner.any():
                    y = y[np.abs(y[:, inner].mean(1) - batch.column("middle")[one].as_py()) <= reject_sigma * sigma]
                use = ~(out | inner)
                if len(y) and use.sum() > 1:
                    add(held, (*key, batch.column("n_rows")[one].as_py(), first, last), K.moments(y, use), use)
            if sum(m[2].nbytes for m in held.values()) > 64_000_000:
                yield pa.RecordBatch.from_arrays(listed(held), names)
                held.clear()
        yield pa.RecordBatch.from_arrays(listed(held), names)

    def together(table: pa.Table) -> dict[tuple, tuple]:
        held: dict[tuple, tuple] = {}
        for p in table.to_pylist():
            out, inner = K.zones(p["ch_first"], p["ch_last"], excluded, core)
            use = ~(out | inner)
            add(held, tuple(p[c] for c in names[:5]), (p["n"], np.frombuffer(p["mean"]), np.frombuffer(p["triangle"]).reshape(-1, int(use.sum()))), use)
        return held

    def merge(table: pa.Table) -> pa.Table:
        return pa.table(listed(together(table.drop_columns("slot"))), names)

    def finish(table: pa.Table) -> pa.Table:
        ((key, known),) = together(table).items()
        out, inner = K.zones(key[3], key[4], excluded, core)
        model = K.model_of(known, k, out, inner, key[3], key[4], smooth) if known[0] > 1 else None
        columns = {
            "mission_id": pa.array([key[0]], pa.string()), "telescop": pa.array([key[1]], pa.string()), "n_rows": pa.array([key[2]], pa.int64()),
            "mean": pa.array([None if model is None else model.mean.tolist()], pa.list_(pa.float64())), "components": pa.array([None if model is None else model.components.tolist()], pa.list_(pa.list_(pa.float64()))),
            "variance": pa.array([None if model is None else model.variance.tolist()], pa.list_(pa.float64())), "ratio": pa.array([None if model is None else model.ratio.tolist()], pa.list_(pa.float64())),
            "ch_first": pa.array([None if model is None else model.first], pa.int32()), "ch_last": pa.array([None if model is None else model.last], pa.int32()),
        }
        return pa.table(columns)

    width = F.col("ch_last") - F.col("ch_first") + 1
    narrow = known.where(width <= wide_channels)
    sums = narrow.drop("size").mapInArrow(partial, schema).withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(32)))
    models = sums.groupBy(*GROUP, "slot").applyInArrow(merge, schema).groupBy(*GROUP).applyInArrow(finish, MODEL).where("mean is not null")
    if settled.where(width > wide_channels).isEmpty():
        return models

    def levelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, one, y, out, inner, _, _ in level(batch):
                if reject_sigma and (sigma := batch.column("sigma")[one].as_py()) is not None and inner.any():
                    y = y[np.abs(y[:, inner].mean(1) - batch.column("middle")[one].as_py()) <= reject_sigma * sigma]
                use = ~(out | inner)
                if len(y) and use.sum() > 1:
                    yield pa.RecordBatch.from_arrays([*(pa.array([c] * len(y), pa.string()) for c in key), lists_of(list(y[:, use]))], [*GROUP, "spectrum"])

    def modelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in batch.to_pylist():
                out, inner = K.zones(w["ch_first"], w["ch_last"], excluded, core)
                mean = np.zeros(len(out))
                mean[~(out | inner)] = w["mean"]
                triangle = np.sqrt(np.array(w["variance"]) * (w["seen"] - 1))[:, None] * np.array(w["components"])
                m = K.model_of((w["seen"], mean, triangle), k, out, inner, w["ch_first"], w["ch_last"], smooth)
                values = [[w["mission_id"]], [w["telescop"]], [w["n_rows"]], [m.mean.tolist()], [m.components.tolist()], [m.variance.tolist()], [w["ratio"][: len(m.components)]], [m.first], [m.last]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, _MODEL_KINDS, strict=True)], [f.split()[0] for f in MODEL.split(", ")])

    numbered = known.where(width > wide_channels).drop("size").mapInArrow(levelled, "mission_id string, telescop string, spectrum array<double>").withColumn("row_id", F.monotonically_increasing_id())
    found = wide_components(numbered, k, folder=folder).withColumnRenamed("n_rows", "seen").join(settled.select(*GROUP, "n_rows", "ch_first", "ch_last"), list(GROUP))
    return models.unionByName(found.mapInArrow(modelled, MODEL))


def _model(row: dict, k: int | None = None) -> K.Model:
    parts = np.array(row["components"], np.float64)[:k]
    return K.Model(np.array(row["mean"]), parts, np.array(row["variance"])[:k], np.array(row["ratio"])[:k], row["ch_first"], row["ch_last"])


def correct(rows: DataFrame, models: DataFrame, gates: K.Gates = K.Gates(), n_components: int | None = None, masks: bool = False, cutoffs: bool = False, protect: bool = False, most_bytes: int = MOST_BYTES, spectrum: str = "spectrum") -> DataFrame:
    """Subtracts each row's components. Adds n_used, the components used; rows without a model stay as they are, with null.

    rows: row_id, mission_id, telescop, spectrum, and for masks fit_mask, line_mask (arrays of booleans: never fitted nor
    subtracted; not fitted, and not subtracted if protect). models: as fitted; for cutoffs with an array of limits. Models of at
    most most_bytes are broadcast; more meet their rows in sorted streams, one at a time.
    """
    names = rows.columns
    work = rows.withColumn(spectrum, A.as_doubles(spectrum))
    schema = work.withColumn("n_used", F.lit(None).cast("long")).schema
    parse = lambda m: (_model(m, n_components), m.get("cutoffs") if cutoffs else None)

    def kernel(part: pa.RecordBatch, model: tuple | None) -> pa.RecordBatch:
        key = tuple(part.column(c)[0].as_py() for c in GROUP)
        return _corrected(part, {} if model is None else {key: model}, gates, masks, protect, spectrum, names)

    return by_model(work, models, parse, kernel, schema, most_bytes)


def _corrected(part: pa.RecordBatch, known: dict, gates: K.Gates, masks: bool, protect: bool, spectrum: str, names: list[str]) -> pa.RecordBatch:
    keys = list(zip(part.column("mission_id").to_pylist(), part.column("telescop").to_pylist(), strict=True))
    out: list = [None] * part.num_rows
    used: list = [None] * part.num_rows
    flags = {c: part.column(c).to_pylist() for c in ("fit_mask", "line_mask")} if masks else {}
    for rows, y in block_of(part.column(spectrum)):
        for key in dict.fromkeys(keys[r] for r in rows.tolist()):
            pick = np.array([keys[r] == key for r in rows.tolist()])
            own = rows[pick]
            block = y[pick]
            if key in known:
                model, limits = known[key]
                n = block.shape[1]
                flag = lambda c: np.array([flags[c][r] if flags.get(c) and flags[c][r] is not None else [False] * n for r in own.tolist()], bool).reshape(len(own), n)  # noqa: E731, B023
                never, line = flag("fit_mask"), flag("line_mask")
                block, count = K.correct(block, model, ~(never | line), ~(never | line) if protect else ~never, gates, None if limits is None else np.array(limits, np.float64))
                for r, c in zip(own.tolist(), count.tolist(), strict=True):
                    used[r] = c
            for r, x in zip(own.tolist(), block, strict=True):
                out[r] = x
    columns = [lists_of(out) if n == spectrum else part.column(n) for n in names]
    return pa.RecordBatch.from_arrays([*columns, pa.array(used, pa.int64())], [*names, "n_used"])


def detect_lines(rows: DataFrame, window: tuple[int, int], kernel: int = 21, factor: float = 1.5, spectrum: str = "spectrum", block: int = 4_096) -> DataFrame:
    """rows: row_id, mission_id, telescop, scan, spectrum. row_id, line_mask, n_line for the rows of all groups, detected group by group.

    A group is one image of its rows in row_id order. The image of a group of more than `block` rows is worked on in blocks
    with the rows that the blur needs on both sides; its extremes and the mean and deviation of each round are sums over all its blocks.
    """
    keys = ["mission_id", "telescop", "scan"]
    named = rows.select("row_id", *keys, A.as_doubles(spectrum).alias("s"))
    counted = named.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # one row for at least `block` rows
    large = counted.where(F.col("_n") > block).toArrow().to_pylist()

    def find(table: pa.Table) -> pa.Table:
        table = table.sort_by("row_id")
        y = _stack(table.column("s"))
        found = K.find_lines(y, window, kernel, factor)
        masks = np.zeros(y.shape, bool) if found is None else found
        return _masks_of(table.column("row_id"), masks)

    if not large:
        return named.groupBy(*keys).applyInArrow(find, LINES)
    listed = rows.sparkSession.createDataFrame([(*(g[c] for c in keys), g["_n"]) for g in large], named.select(*keys, F.lit(0).cast("long").alias("_n")).schema)
    same = lambda other: [named[c].eqNullSafe(other[c]) for c in keys]
    rest = named.join(listed, same(listed), "left_anti")
    hot = named.join(listed, same(listed), "left_semi")
    return rest.groupBy(*keys).applyInArrow(find, LINES).unionByName(_detect_in_blocks(hot, keys, listed, window, K.odd_kernel(kernel), factor, block))


LINES = "row_id long, line_mask array<boolean>, n_line long"


def _masks_of(row_ids: pa.ChunkedArray, masks: np.ndarray) -> pa.Table:
    return pa.table({"row_id": row_ids, "line_mask": pa.array(masks.tolist(), pa.list_(pa.bool_())), "n_line": pa.array(masks.sum(1), pa.int64())})


def _detect_in_blocks(rows: DataFrame, keys: list[str], sizes: DataFrame, window: tuple[int, int], kernel: int, factor: float, block: int) -> DataFrame:
    """The lines of groups whose images are too large for one task. rows: row_id, keys, s; sizes: keys, _n."""
    from specfold.operators.links import ranked

    group = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("_group")
    placed = ranked(rows.select("row_id", "s", group), ["_group"]).withColumn("place", F.col("place") - 1)
    pad = kernel // 2
    own = F.floor(F.col("place") / block)
    near = F.sequence(F.greatest(F.lit(0), F.floor((F.col("place") - pad) / block)), F.floor((F.col("place") + pad) / block))
    images = placed.join(sizes.select(group, "_n"), "_group").withColumn("_image", F.explode(near)).withColumn("_own", F.col("_image") == own).where(F.col("_image") * block < F.col("_n"))

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, y in block_of(batch.column("s")):
                image = K.windowed(y, window)
                yield pa.RecordBatch.from_arrays([batch.column("_group").take(pa.array(at)), pa.array(image.min(1)), pa.array(image.max(1))], ["_group", "low", "high"])

    ends = placed.select("_group", "s").mapInArrow(extremes, "_group string, low double, high double").groupBy("_group").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    known = {r["_group"]: (r["low"], r["high"]) for r in ends.collect()}  # one row for at least `block` rows

    def soft(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        """The own rows of a block, their blurred image, and which of them show anything."""
        table = table.sort_by("place")
        low, high = known[table.column("_group")[0].as_py()]
        place, mine = table.column("place").to_numpy(), table.column("_own").to_numpy()
        image = K.windowed(_stack(table.column("s")), window)
        owned = table.filter(table.column("_own"))
        if high <= low:
            return owned, np.zeros((len(owned), image.shape[1])), np.zeros(len(owned), bool)
        at = place[mine]
        blurred = K.blurred_rows(K.levels(image, low, high), kernel, int(place[0]), int(at[0]), int(at[-1]) + 1, table.column("_n")[0].as_py())
        return owned, blurred, np.abs(image[mine]).max(1) > 1e-10 * max(abs(low), abs(high))

    def adder(limits: dict[str, float]):
        def add(table: pa.Table) -> pa.Table:
            name = table.column("_group")[0].as_py()
            values = np.zeros(0)
            if name in limits:
                _, values, _ = soft(table)
                values = values[(values != 0) & (values <= limits[name])]
            mean = float(values.mean()) if len(values) else 0.0
            return pa.table({"_group": [name], "_image": table.column("_image").slice(0, 1), "n": pa.array([len(values)], pa.int64()), "mean": [mean], "square": [float(((values - mean) ** 2).sum())]})

        return add

    # rounds: of each group the threshold, the lowest so far, and the number of values under it
    cuts: dict[str, tuple[float, float]] = {g: (math.inf, math.inf) for g, (low, high) in known.items() if high > low}
    counts: dict[str, int] = {}
    open_ = set(cuts)
    for _ in range(100):
        if not open_:
            break
        parts = images.groupBy("_group", "_image").applyInArrow(adder({g: cuts[g][1] for g in open_}), "_group string, _image long, n long, mean double, square double")
        sums = parts.where("n > 0").groupBy("_group").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"), F.sum("square").alias("inner"), (F.sum(F.col("n") * F.col("mean") ** 2)).alias("_outer"))
        got = {r["_group"]: r for r in sums.withColumn("square", F.col("inner") + F.greatest(F.lit(0.0), F.col("_outer") - F.col("n") * F.col("mean") ** 2)).collect()}
        for g in list(open_):
            r = got.get(g)
            if r is None or counts.get(g) == r["n"]:
                open_.discard(g)
                continue
            counts[g] = r["n"]
            cut = r["mean"] + factor * math.sqrt(r["square"] / r["n"])
            cuts[g] = (cut, min(cut, cuts[g][1]))

    def mark(table: pa.Table) -> pa.Table:
        owned, values, live = soft(table)
        found = values > cuts.get(table.column("_group")[0].as_py(), (math.inf,))[0]
        found[:, : max(0, window[0])] = False
        found[:, max(0, window[1]) :] = False
        found[~live] = False
        return _masks_of(owned.column("row_id"), found)

    return images.groupBy("_group", "_image").applyInArrow(mark, LINES)


def _reference_groups(rows: DataFrame, spectrum: str) -> DataFrame:
    return rows.where(F.col("mission_id").isNotNull() & F.col("telescop").isNotNull()).select(*[F.col(c).cast("string").alias(c) for c in GROUP], A.as_doubles(spectrum).alias("s"))


def reference_groups(reference: DataFrame, spectrum: str = "spectrum") -> DataFrame:
    """The groups that components are fitted for, with n_rows, their first and last channel with values, and the channels' means that fill gaps."""
    settled = _settled(_reference_groups(reference, spectrum))

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*GROUP, "n_rows", "ch_first", "ch_last")), lists_of([np.frombuffer(v) for v in batch.column("means").to_pylist()])], [*GROUP, "n_rows", "ch_first", "ch_last", "means"])

    return settled.mapInArrow(means, "mission_id string, telescop string, n_rows long, ch_first int, ch_last int, means array<double>")


def row_coefficients(rows: DataFrame, models: DataFrame, gates: K.Gates = K.Gates(), spectrum: str = "spectrum", most_bytes: int = MOST_BYTES) -> DataFrame:
    """Each row's coefficients and noise ratios: row_id, mission_id, telescop, component, coefficient, ratio. Models meet their rows as in correct()."""
    work = rows.select("row_id", *GROUP, A.as_doubles(spectrum).alias("s"))
    names = ["row_id", *GROUP, "component", "coefficient", "ratio"]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.float64(), pa.float64())

    def parse(model: dict) -> tuple[np.ndarray, int, int]:
        return np.array(model["components"], np.float64), model["ch_first"], model["ch_last"]

    def kernel(part: pa.RecordBatch, model: tuple | None) -> pa.RecordBatch:
        found: list[list] = [[] for _ in names]
        for at, y in block_of(part.column("s")) if model else ():
            ids, place, coefficient, ratio = K.fitted(y[:, model[1] : model[2] + 1], model[0], gates)
            own = part.take(pa.array(at[ids], pa.int64()))
            for values, more in zip(found, (*(own.column(c).to_pylist() for c in ("row_id", *GROUP)), place, coefficient, ratio), strict=True):
                values.extend(more)
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(found, kinds, strict=True)], names)

    return by_model(work, models.select(*GROUP, "components", "ch_first", "ch_last"), parse, kernel, "row_id long, mission_id string, telescop string, component int, coefficient double, ratio double", most_bytes)


def noise_ratios(rows: DataFrame, models: DataFrame, gates: K.Gates = K.Gates(), spectrum: str = "spectrum") -> DataFrame:
    """Long form of the noise ratios of each group's rows: mission_id, telescop, component, ratio."""
    return row_coefficients(rows, models, gates, spectrum).select(*GROUP, "component", "ratio")


def cutoffs(ratios: DataFrame, overall: float | None, fixed: float | None = None, bins: int = 600, top: float = 60.0) -> DataFrame:
    """Limits of each group's components, from the density of their noise ratios. Ratios are counted in narrow bins first, so any group's fit sees `bins` numbers at most."""
    step = top / bins
    binned = ratios.where(A.is_finite(F.col("ratio"))).withColumn("b", F.least(F.lit(bins), F.floor(F.abs("ratio") / step)).cast("int")).groupBy(*GROUP, "component", "b").agg(F.count(F.lit(1)).alias("n"))

    def fit(table: pa.Table) -> pa.Table:
        limit = K.component_cutoffs(((table.column("b").to_numpy() + 0.5) * step)[:, None], overall, fixed, table.column("n").to_numpy())[0]
        return pa.table({"mission_id": table.column("mission_id").slice(0, 1), "telescop": table.column("telescop").slice(0, 1), "component": table.column("component").slice(0, 1), "cutoff": pa.array([limit])})

    return binned.groupBy(*GROUP, "component").applyInArrow(fit, "mission_id string, telescop string, component int, cutoff double")


def with_cutoffs(models: DataFrame, limits: DataFrame) -> DataFrame:
    """models with the array of their limits, in component order."""
    listed = limits.groupBy(*GROUP).agg(F.array_sort(F.collect_list(F.struct("component", "cutoff"))).alias("_l"))
    return models.join(listed.select(*GROUP, F.transform("_l", lambda p: p["cutoff"]).alias("cutoffs")), list(GROUP), "left")


def correct_with_lines(rows: DataFrame, models: DataFrame, window: tuple[int, int], folder: str, gates: K.Gates = K.Gates(), rounds: int = 3, detect: bool = True, overall: float | None = None, fixed: float | None = None, protect: bool = False, kernel: int = 21, factor: float = 1.5) -> DataFrame:
    """Correct, find lines in the result, correct again without fitting there, and so on; limits from the last noise ratios if overall is given.

    Each round is written to folder, so that later rounds do not compute earlier ones again.
    """
    spark = rows.sparkSession
    mask = F.lit(None).cast("array<boolean>")
    base = rows.withColumns({"fit_mask": F.col("fit_mask") if "fit_mask" in rows.columns else mask, "line_mask": mask})
    now = correct(base, models, gates, masks=True, protect=protect)
    for i in range(rounds if detect else 0):
        path = f"{folder}/round-{i}"
        now.write.mode("overwrite").parquet(path)
        lines = detect_lines(spark.read.parquet(path), window, kernel, factor)
        lines.write.mode("overwrite").parquet(f"{folder}/lines-{i}")
        found = spark.read.parquet(f"{folder}/lines-{i}").select("row_id", "line_mask")
        base = base.drop("line_mask").join(found, "row_id", "left")
        now = correct(base, models, gates, masks=True, protect=protect)
    if overall:
        limited = with_cutoffs(models, cutoffs(noise_ratios(rows, models, gates), overall, fixed))
        now = correct(base, limited, gates, masks=True, cutoffs=True, protect=protect)
    return now


def component_long(models: DataFrame, velocity: float, deltav: float) -> DataFrame:
    """models as mission_id, telescop, component, velocity (km/s), value."""
    parts = models.select(*GROUP, "ch_first", F.posexplode("components").alias("component", "_c"))
    return parts.select(*GROUP, "component", "ch_first", F.posexplode("_c").alias("_i", "value")).select(*GROUP, "component", ((F.lit(velocity) + (F.col("_i") + F.col("ch_first")) * deltav) / 1000).alias("velocity"), "value")


def pass_through(rows: DataFrame, overrides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to correct, and rows of missions that the table (mission_id, skip_correction) leaves as they are."""
    skip = overrides.where("skip_correction").select("mission_id").distinct()
    return rows.join(skip, "mission_id", "left_anti"), rows.join(skip, "mission_id", "left_semi")


def cube_components(cube: DataFrame, k: int, spectrum: str = "spectrum", most_channels: int = WIDE_CHANNELS) -> tuple[np.ndarray, np.ndarray]:
    """Mean and first k components over a cube's spaxels, from the triangular factors of the rows that tasks add up: channels squared numbers, of one row, reach the driver.

    Cubes of more than most_channels channels are taken by subspace iterations; k times their channels numbers reach the driver.
    """
    first = cube.select(F.size(spectrum).alias("n")).first()
    if first is None:
        raise NoDataError("the cube has no pixels")
    n = first["n"]

    if n > most_channels:
        group = cube.select(F.monotonically_increasing_id().alias("row_id"), F.lit("cube").alias("mission_id"), F.lit("cube").alias("telescop"), F.col(spectrum).alias("spectrum")).where(F.size("spectrum") == n)
        found = wide_components(group, k).first()
        if found is None:
            raise NoDataError("too few complete spaxels")
        return np.array(found["mean"]), np.array(found["components"])
    every = np.ones(n, bool)
    kind = "n long, mean binary, triangle binary"

    def row_of(known: tuple[int, np.ndarray, np.ndarray] | None) -> pa.RecordBatch:
        values = [] if known is None else [known]
        return pa.RecordBatch.from_arrays([pa.array([v[0] for v in values], pa.int64()), *(pa.array([v[i].tobytes() for v in values], pa.binary()) for i in (1, 2))], ["n", "mean", "triangle"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for batch in batches:
            for _, y in block_of(batch.column("s")):
                y = y[np.isfinite(y).all(1)] if y.shape[1] == n else y[:0]
                if len(y):
                    more = K.moments(y, every)
                    known = more if known is None else K.joined_moments(known, more, every)
        yield row_of(known)

    def merge(table: pa.Table) -> pa.Table:
        known = None
        for p in table.to_pylist():
            more = (p["n"], np.frombuffer(p["mean"]), np.frombuffer(p["triangle"]).reshape(-1, n))
            known = more if known is None else K.joined_moments(known, more, every)
        return pa.Table.from_batches([row_of(known)])

    parts = cube.select(A.as_doubles(spectrum).alias("s")).mapInArrow(partial, kind).withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(32)))
    merged = parts.groupBy("slot").applyInArrow(lambda t: merge(t.drop_columns("slot")), kind).groupBy().applyInArrow(merge, kind).first()
    if merged is None or merged["n"] < 2:
        raise NoDataError("too few complete spaxels")
    _, _, vectors = np.linalg.svd(np.frombuffer(merged["triangle"]).reshape(-1, n), full_matrices=False)
    return np.frombuffer(merged["mean"]), vectors[:k]


def recommended_components(reference: DataFrame, velocity: float, deltav: float, most: int = 10, least: float = 0.4, **how) -> DataFrame:
    """How many components each mission should use: models with up to `most` are fitted once, and components count up to the first that unlike pixels do not share. mission_id, n_components."""
    from specfold.operators.spectra import chosen_components, coherence

    return chosen_components(coherence(component_long(fit_models(reference, most, **how), velocity, deltav)), least)


def cube_filtered(cube: DataFrame, mean: np.ndarray, components: np.ndarray, spectrum: str = "spectrum") -> DataFrame:
    """Spaxels rebuilt from the mean and the components."""
    return map_arrays(cube, spectrum, lambda y: mean + (np.nan_to_num(y - mean) @ components.T) @ components, {spectrum: "array<double>"})


def gates_of(**settings) -> K.Gates:
    """Gates from settings that may be None."""
    known = {f.name for f in dataclasses.fields(K.Gates)}
    return K.Gates(**{k: (math.inf if v is None and k == "noise" else v) for k, v in settings.items() if k in known and (v is not None or k == "noise")})
