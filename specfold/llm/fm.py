"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its distinct words and runs of marks, hashed and weighted by 1 + ln(count),
to length one; standardised shares and rates of its characters, words and lines; and a bucket of
the metadata column n_chars. The model adds to a linear score the pairwise interactions of all
features through vectors of `rank` numbers, in time linear in the features by
sum_i<j <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

It is fitted on the driver by logistic loss on at most fit_rows labelled rows, those with the
smallest hash of doc_id; the weights (2^16 hashed features, a fixed size) are broadcast, and every
row is scored in one pass without a shuffle. Seeds are fixed: reruns agree.

Null text counts as empty, an empty text has only metadata and zero statistics and gets a score
too. A null n_chars has a bucket of its own. Repeated rows score alike. Of rows that share a doc_id one is
learned from, of the smallest text hash, once for each of its labels. Rows of labels without doc_id or quality are left out. Without both classes among the labelled rows every score is
the share of label 1 (0.5 without rows). An empty table gives no rows. Further columns are kept by
score_columns and not read by score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specfold.llm.common import give_back, session_of, trimmed
from specfold.llm.encode import chunks

WORDS = 1 << 16
STATS = ("upper", "lower", "digit", "space", "line", "high", "stop", "mark", "bar", "shout", "word_length", "distinct", "line_words", "line_repeats", "log_words", "run_length")
BUCKETS = 24
SIZE = WORDS + len(STATS) + BUCKETS

_CLASS = np.full(256, 7, np.uint8)  # marks
for _i, _bytes in enumerate((range(65, 91), range(97, 123), range(48, 58), b" \t\r\x0b\x0c", b"\n", range(128, 256), b".,;:?'\"-()")):
    _CLASS[[*_bytes]] = _i
_CLASS[[*b"|"]] = 8
_CLASS[[*b"!"]] = 9
_WORD = np.isin(_CLASS, (0, 1, 2, 5))
_BLANK = np.isin(_CLASS, (3, 4))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Rows:
    """Features of some rows: those of row i are idx[ptr[i]:ptr[i+1]], with weights val."""

    ptr: np.ndarray
    idx: np.ndarray
    val: np.ndarray


def _pieces(raw: np.ndarray, kind: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of runs of equal kind that no bound crosses."""
    mark = np.zeros(len(raw) + 1, bool)
    mark[1:-1] = kind[1:] != kind[:-1]
    mark[bounds] = True
    mark[-1] = True
    at = np.flatnonzero(mark)
    return at[:-1], at[1:]


def _codes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each slice, equal for equal bytes; and the distinct slices. Slices follow one another."""
    if not len(begin):
        return np.zeros(0, np.int64), pa.array([], pa.large_binary())
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(np.append(begin, end[-1]).astype(np.int64)), pa.py_buffer(raw)]).dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), found.dictionary


def features(texts: pa.Array, n_chars: pa.Array) -> tuple[Rows, np.ndarray]:
    """Hashed words and buckets, and the statistics before they are standardised (rows x STATS)."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]] if n else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    size = np.diff(bounds)
    kind = _CLASS[raw]
    stats = np.zeros((n, len(STATS)))
    for i in range(10):
        total = np.concatenate([[0], np.cumsum(kind == i, dtype=np.int64)])
        stats[:, i] = (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(size, 1)
    if len(raw):
        group = np.where(_WORD[raw], 1, np.where(_BLANK[raw], 0, 2)).astype(np.uint8)
        begin, end = _pieces(raw, group, bounds)
        code, distinct = _codes(_LOWER[raw], begin, end)
        hashed = np.fromiter((zlib.crc32(x.as_buffer()) % WORDS for x in distinct), np.int64, len(distinct))
        blank = group[begin] == 0
        doc = np.searchsorted(bounds, begin, "right") - 1
        is_word = group[begin] == 1
        words = np.bincount(doc[is_word], minlength=n)
        pairs, count = np.unique((doc * WORDS + hashed[code])[~blank], return_counts=True)
        of, idx = np.divmod(pairs, WORDS)
        val = 1 + np.log(count)
        val /= np.sqrt(np.bincount(of, val * val, n))[of]
        tokens = np.bincount(doc[~blank], minlength=n)
        stats[:, 10] = np.bincount(doc[is_word], (end - begin)[is_word], n) / np.maximum(words, 1)
        stats[:, 11] = np.bincount(of, minlength=n) / np.maximum(tokens, 1)
        begin_l, end_l = _pieces(raw, (raw == 10).astype(np.uint8), bounds)
        keep = raw[begin_l] != 10
        code_l, _ = _codes(raw, begin_l, end_l)
        doc_l = np.searchsorted(bounds, begin_l, "right") - 1
        total_lines = np.bincount(doc_l[keep], minlength=n)
        lines = np.bincount(np.unique((doc_l << 32 | code_l)[keep]) >> 32, minlength=n)
        stats[:, 12] = np.log1p(words / np.maximum(total_lines, 1))
        stats[:, 13] = 1 - lines / np.maximum(total_lines, 1)
        stats[:, 14] = np.log1p(words)
        runs = np.bincount(doc[group[begin] == 2], minlength=n)
        stats[:, 15] = np.bincount(doc[group[begin] == 2], (end - begin)[group[begin] == 2], n) / np.maximum(runs, 1)
    else:
        of, idx, val = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    length = np.array([BUCKETS - 1 if x is None else min(BUCKETS - 2, max(0, x).bit_length()) for x in n_chars.to_pylist()], np.int64)
    of = np.concatenate([of, np.arange(n)])
    idx = np.concatenate([idx, WORDS + len(STATS) + length])
    val = np.concatenate([val, np.ones(n)])
    order = np.argsort(of, kind="stable")
    ptr = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int64)
    return Rows(ptr, idx[order].astype(np.int32), val[order].astype(np.float32)), stats


def with_stats(rows: Rows, stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> Rows:
    n, k = stats.shape
    z = np.clip((stats - mean) / scale, -4, 4) / np.sqrt(k)
    sizes = np.diff(rows.ptr)
    ptr = np.concatenate([[0], np.cumsum(sizes + k)])
    idx, val = np.empty(ptr[-1], np.int32), np.empty(ptr[-1], np.float32)
    place = np.arange(len(rows.idx)) + np.repeat(np.arange(n) * k, sizes)
    idx[place], val[place] = rows.idx, rows.val
    tail = (ptr[1:, None] - k + np.arange(k)).ravel()
    idx[tail], val[tail] = np.tile(WORDS + np.arange(k), n), z.ravel()
    return Rows(ptr, idx, val)


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def raw(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and each row's sums of factors."""
        begin = rows.ptr[:-1]
        x = rows.val[:, None] * self.factors[rows.idx]
        sums = np.add.reduceat(x, begin, axis=0)
        squares = np.add.reduceat((x * x).sum(1), begin)
        straight = np.add.reduceat(rows.val * self.linear[rows.idx], begin)
        return self.bias + straight + 0.5 * ((sums * sums).sum(1) - squares), sums

    def score(self, texts: pa.Array, n_chars: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        rows = with_stats(*features(texts, n_chars), self.mean, self.scale)
        return 1 / (1 + np.exp(-np.clip(self.raw(rows)[0].astype(np.float64), -50, 50)))


def fit(rows: Rows, stats: np.ndarray, label: np.ndarray, rank: int = 8, rounds: int = 8, batch: int = 256, rate: float = 0.02, decay: float = 1e-5, seed: int = 7, steps: int = 350) -> Model:
    """Adam on the logistic loss; rows in a fixed random order. At least so many rounds over the rows, and at least so many steps, however few the rows are."""
    n = len(label)
    share = (label.sum() + 1.0) / (n + 2.0)
    model = Model(float(np.log(share / (1 - share))), np.zeros(SIZE, np.float32), np.zeros((SIZE, rank), np.float32), stats.mean(0) if n else np.zeros(len(STATS)), np.maximum(stats.std(0), 1e-6) if n else np.ones(len(STATS)))
    if n == 0 or label.min() == label.max():
        return model
    rng = np.random.default_rng(seed)
    model.factors[:] = rng.normal(0, 0.05, (SIZE, rank))
    rows = with_stats(rows, stats, model.mean, model.scale)
    weights = np.concatenate([model.linear[:, None], model.factors], 1)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    step = 0
    for _ in range(max(rounds, -(-steps * batch // max(n, batch)))):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            pick = np.sort(order[at : at + batch])
            sizes = np.diff(rows.ptr)[pick]
            ptr = np.concatenate([[0], np.cumsum(sizes)])
            take = np.arange(ptr[-1]) + np.repeat(rows.ptr[pick] - ptr[:-1], sizes)
            own = Rows(ptr, rows.idx[take], rows.val[take])
            model.linear, model.factors = weights[:, 0], weights[:, 1:]
            raw, sums = model.raw(own)
            error = (1 / (1 + np.exp(-np.clip(raw, -50, 50))) - label[pick]).astype(np.float32) / len(pick)
            e = np.repeat(error, sizes)
            x = own.val[:, None]
            grad = np.concatenate([x, x * np.repeat(sums, sizes, axis=0) - x * x * model.factors[own.idx]], 1) * e[:, None]
            used, inverse = np.unique(own.idx, return_inverse=True)
            total = np.stack([np.bincount(inverse, grad[:, c], len(used)) for c in range(rank + 1)], 1).astype(np.float32)
            total += decay * weights[used]
            step += 1
            first[used] = 0.9 * first[used] + 0.1 * total
            second[used] = 0.99 * second[used] + 0.01 * total * total
            fix = np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            weights[used] -= rate * fix * first[used] / (np.sqrt(second[used]) + 1e-8)
            model.bias -= rate * float(error.sum())
    model.linear, model.factors = weights[:, 0].copy(), weights[:, 1:].copy()
    return model


def held_out() -> Column:
    """Whether a row is kept from fitting; a row without doc_id, which no label can name, is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = 12_000, fit_bytes: int = 256_000_000) -> Model:
    """docs: doc_id, text, n_chars; labels: doc_id, quality. Learns from at most fit_rows labelled rows that are not held out, with at most fit_bytes of text in all."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality is not null").where(~held_out())
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(fit_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.col("n_chars").cast("long").alias("n_chars")).withColumn("_tie", F.xxhash64("text"))
    # one text of each doc_id, and of those as many as the bytes allow: at most fit_rows narrow rows
    texts = rows.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id").groupBy("doc_id").agg(F.min(F.struct("_tie", F.octet_length("text").alias("bytes"))).alias("t"))
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    fitting = texts.select("doc_id", "t._tie", F.sum("t.bytes").over(order).alias("_sum")).where(F.col("_sum") <= fit_bytes).drop("_sum")
    rows = rows.join(F.broadcast(fitting.join(chosen, "doc_id")), ["doc_id", "_tie"])
    kind = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("idx", pa.binary()), ("val", pa.binary()), ("stats", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                found, stats = features(part.column("text"), part.column("n_chars"))
                cut = lambda x: [x[a:b].tobytes() for a, b in zip(found.ptr[:-1], found.ptr[1:], strict=True)]  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), pa.array(cut(found.idx), pa.binary()), pa.array(cut(found.val), pa.binary()), pa.array([x.tobytes() for x in stats], pa.binary())], schema=kind)

    got = rows.mapInArrow(trimmed(run), "doc_id long, quality int, idx binary, val binary, stats binary")
    got = got.dropDuplicates(["doc_id", "quality"]).toArrow().sort_by([("doc_id", "ascending"), ("quality", "ascending"), ("stats", "ascending"), ("idx", "ascending")])
    idx = [np.frombuffer(x, np.int32) for x in got.column("idx").to_pylist()]
    val = [np.frombuffer(x, np.float32) for x in got.column("val").to_pylist()]
    stats = np.array([np.frombuffer(x) for x in got.column("stats").to_pylist()]).reshape(-1, len(STATS))
    ptr = np.concatenate([[0], np.cumsum([len(x) for x in idx])]).astype(np.int64)
    empty = [np.zeros(0)]
    model = fit(Rows(ptr, np.concatenate(idx or empty), np.concatenate(val or empty)), stats, got.column("quality").to_numpy().astype(np.float64))
    del got, idx, val
    give_back()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs: doc_id, text, n_chars. Rows: doc_id, score (0 to 1, higher: label 1 likelier)."""
    return score_columns(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("n_chars").cast("long").alias("n_chars")), model).select("doc_id", "score")


def score_columns(docs: DataFrame, model: Model) -> DataFrame:
    """As score, with all columns of docs kept; score replaces a column of that name."""
    docs = docs.drop("score")
    names = docs.columns
    sent = session_of(docs).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                out = sent.value.score(pc.fill_null(part.column("text"), ""), part.column("n_chars"))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.float64())], [*names, "score"])

    return docs.mapInArrow(trimmed(run), T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))
