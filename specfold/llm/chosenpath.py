"""N-gram Jaccard join by chosen paths.

A document is its set of word n-grams (hashed to 64 bits; a text of fewer words is one n-gram).
Documents with equal sets form a class and go on as one. A class's MinHash sketch embeds its set
in WIDTH tokens. In each of several runs the classes are split by one sampled token of the
sketch; classes that share it meet in a bucket, which one task holds and splits further by itself:
buckets of at most `small` classes are compared whole, larger ones are split by tokens that the bucket's
path draws: one, and one time in four a second, 1 / similarity in the mean, and once by size, in overlapping
classes. Before a bucket is split, all its classes are compared with one of them, the pivot: those likely
to be near it are joined to it, and of them those so near that whatever else is linked to them must be near the
pivot too leave with it. So a group of near copies costs its buckets one comparison a member.
Buckets of more than `most` classes are not given to one task: they are compared with their pivot
where they are read, what stays is dealt by its next tokens, and what is larger still at the last level is compared
in pairs of blocks. Runs are repeated until a pair at the threshold is met with the target recall.

The comparisons of sketches only gather candidates: the components of likely pairs. Within each
component all pairs are then verified on the whole sets, in pairs of blocks if it has more than `block`
classes. So a link is never wrong and the links of a row are counted exactly, but only a spanning forest
of them, not all pairs, leaves a task. Counting takes one intersection for each two classes of a component, by
matrix products; rows move once for each block of it.

Words are runs of characters other than white space of the lower-case text; whole texts are read, however
long. Null or empty texts and texts without words are linked to nothing; rows with a null doc_id neither, as no link
could name them. Repeated rows are copies of one another. Of rows of one doc_id the one read first
stands for it in ties. An empty table gives no rows. Further columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specfold.llm.common import group_bounds, hot_join, keep_only, session_of, staged, trimmed, whole_groups, work_dir
from specfold.llm.components import components, forest
from specfold.llm.encode import chunks

WIDTH = 64
#: Estimates from which a class is joined to its pivot, and leaves the bucket.
NEAR, SURE = 0.4, 0.78
#: Estimate from which a pair of a compared bucket is a candidate.
LIKELY = 0.55
LEVELS = 6
#: Sketch tokens that are kept whole, for the first split of as many runs.
MOST_RUNS = 16
#: Bytes of n-gram sets in a block of a component at most.
BLOCK_BYTES = 16_000_000
#: A table of at most so many rows, counted before, is broadcast.
BROADCAST_ROWS = 50_000
_SPACE = np.zeros(256, bool)
_SPACE[[*b" \t\n\r\x0b\x0c"]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(n: int, seed: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of all texts in a row, and where each text's end."""
    low = pc.utf8_lower(texts.cast(pa.large_string()))
    n = len(low)
    bounds = np.frombuffer(low.buffers()[1], np.int64)[low.offset : low.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(low.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]] if n else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    space = _SPACE[raw]
    mark = np.zeros(len(raw) + 1, bool)
    mark[1:-1] = space[1:] != space[:-1]
    mark[bounds] = True
    mark[-1] = True
    at = np.flatnonzero(mark).astype(np.int64)
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw)]).dictionary_encode()
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(x.as_buffer()) for x in coded.dictionary), np.uint64, len(coded.dictionary))
    chosen = ~space[at[:-1]]
    word = hashed[coded.indices.to_numpy()[chosen]]
    doc = np.searchsorted(bounds, at[:-1][chosen], "right") - 1
    count = np.bincount(doc, minlength=n)
    end = np.cumsum(count)
    factor = _odd(words, 1)
    padded = np.concatenate([word, np.zeros(words, np.uint64)])
    gram = np.zeros(len(word), np.uint64)
    left = end[doc] - np.arange(len(word))  # words from here to the text's end
    for i in range(words):
        gram += np.where(left > i, padded[i : len(word) + i] * factor[i], np.uint64(0))
    first = np.concatenate([[0], end[:-1]])[doc] == np.arange(len(word))
    keep = (left >= words) | first
    gram, doc = _mix(gram[keep]), doc[keep]
    order = np.lexsort((gram, doc))
    gram, doc = gram[order], doc[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
    return gram[new], np.cumsum(np.bincount(doc[new], minlength=n))


def sketches_of(grams: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """MinHash, n x WIDTH (uint32); rows without n-grams are all ones."""
    n = len(ends)
    begin = np.concatenate([[0], ends[:-1]]).astype(np.int64) if n else np.zeros(0, np.int64)
    full = np.flatnonzero(ends > begin)
    out = np.full((n, WIDTH), 0xFFFFFFFF, np.uint32)
    if len(full):
        for j, (salt, odd) in enumerate(zip(_odd(WIDTH, 2), _odd(WIDTH, 3), strict=True)):
            out[full, j] = np.minimum.reduceat((((grams ^ salt) * odd) >> np.uint64(32)).astype(np.uint32), begin[full])
    return out


def _sigs(grams: np.ndarray, ends: np.ndarray) -> list[bytes | None]:
    out, begin = [], 0
    for end in ends.tolist():
        out.append(xxhash.xxh3_128_digest(grams[begin:end].tobytes()) if end > begin else None)
        begin = end
    return out


def sketch(docs: DataFrame, words: int) -> DataFrame:
    """docs: doc_id, text. Rows: doc_id, sig (of the n-gram set; null: none), n, sketch (its first MOST_RUNS tokens, 32 bits each), short (the lowest bytes of all)."""
    kind = pa.schema([("doc_id", pa.int64()), ("sig", pa.binary()), ("n", pa.int64()), ("sketch", pa.binary()), ("short", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                grams, ends = shingle_sets(part.column("text"), words)
                rows = sketches_of(grams, ends)
                n = np.diff(np.concatenate([[0], ends]))
                cut = lambda x: pa.array([y.tobytes() if k else None for y, k in zip(x, n, strict=True)], pa.binary())  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_sigs(grams, ends), pa.binary()), pa.array(n, pa.int64()), cut(rows[:, :MOST_RUNS]), cut((rows & 0xFF).astype(np.uint8))], schema=kind)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(trimmed(run), "doc_id long, sig binary, n long, sketch binary, short binary")


def runs_for(similarity: float, recall: float) -> int:
    """Runs after which a pair at the threshold, split apart at most once after its first bucket, is met."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity**2)))


def _token(j: int) -> Column:
    return F.substring("sketch", 4 * j + 1, 4)


def _short_token(j: Column) -> Column:
    return F.call_function("substring", F.col("short"), (j + 1).cast("int"), F.lit(1))


def size_class(n: np.ndarray, similarity: float) -> np.ndarray:
    """Sets of that similarity or more are of one class or of neighbouring ones; a set of class c meets those of c and c + 1."""
    return np.floor(np.log(n) / -math.log(similarity - 1e-9)).astype(np.int64)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDTH)


def likely_pairs(tokens: np.ndarray, leaves: list[np.ndarray], side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one leaf (an array of row numbers) whose sketches agree; with sides, 1 and 2 only with each other."""
    if not leaves:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = np.concatenate(leaves)
    sizes = np.array([len(x) for x in leaves])
    behind = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(rows)) - 1  # rows of the same leaf that follow
    at, step, a, b = np.flatnonzero(behind), 1, [], []
    while len(at):
        for begin in range(0, len(at), 200_000):
            i = at[begin : begin + 200_000]
            x, y = rows[i], rows[i + step]
            good = np.count_nonzero(tokens[x] == tokens[y], axis=1) >= LIKELY * WIDTH
            if side is not None:
                good &= (side[x] == 0) | (side[x] != side[y])
            a.append(x[good])
            b.append(y[good])
        step += 1
        at = at[behind[at] >= step]
    return np.concatenate(a), np.concatenate(b)


def split(tokens: np.ndarray, sizes: np.ndarray, order: np.ndarray, key: int, small: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Chosen paths below one large bucket: pairs with pivots (rows a, b), and the leaves that are compared whole.

    order: the bucket's rows as hashed, which no arrangement of the input changes.
    """
    a, b, leaves = [], [], []
    todo = [(np.argsort(order, kind="stable"), np.uint64(key & 0xFFFFFFFFFFFFFFFF), 0)]
    while todo:
        rows, path, level = todo.pop()
        if len(rows) <= small or level == LEVELS:
            if len(rows) > 1:
                leaves.append(rows)
            continue
        pivot = rows[int(_mix(np.array([path]))[0] % np.uint64(len(rows)))]
        share = np.count_nonzero(tokens[rows] == tokens[pivot], axis=1) / WIDTH
        near = rows[(share >= NEAR) & (rows != pivot)]
        a.append(near)
        b.append(np.full(len(near), pivot))
        rest = rows[share < SURE]
        seeds = _mix(path + np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        draws = [int(seeds[0] % np.uint64(WIDTH))]
        if seeds[1] % np.uint64(4) == 0:
            draws.append(int(seeds[2] % np.uint64(WIDTH)))
        if level == 0:  # sets of unlike size part at once
            rest = np.concatenate([rest, rest])
            met = (sizes[rest] + np.repeat([0, 1], len(rest) // 2)) << 8
        else:
            met = np.zeros(len(rest), np.int64)
        for d in set(draws):
            child = tokens[rest, d].astype(np.int64) + met
            by = np.argsort(child, kind="stable")
            child, ends = child[by], np.flatnonzero(np.diff(child[by], append=-1)) + 1
            for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True) if len(by) else ():
                todo.append((rest[by[begin:end]], _mix(np.array([seeds[3] ^ np.uint64(int(child[begin]) * WIDTH + d)]))[0], level + 1))
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(a or empty), np.concatenate(b or empty), leaves


def _bucketed(rows: DataFrame, small: int, similarity: float) -> DataFrame:
    """rows: key, cid, order, n, short. Likely pairs of each bucket, as few as join what they join: a, b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            tokens, key = _matrix(table.column("short")), table.column("key").to_numpy()
            sizes, order = size_class(table.column("n").to_numpy(), similarity), table.column("order").to_numpy()
            a, b, leaves = [], [], []
            for begin, end in group_bounds(key):
                if end - begin > small:
                    x, y, own = split(tokens[begin:end], sizes[begin:end], order[begin:end], int(key[begin]), small)
                    a.append(begin + x)
                    b.append(begin + y)
                    leaves += [begin + z for z in own]
                elif end - begin > 1:
                    leaves.append(np.arange(begin, end))
            x, y = likely_pairs(tokens, leaves)
            yield _forest_of(table, np.concatenate([x, *a]), np.concatenate([y, *b]))

    return rows.repartition("key").sortWithinPartitions("key").select("key", "cid", "order", "n", "short").mapInArrow(trimmed(run), "a long, b long")


def _forest_of(table: pa.Table, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """A spanning forest of the pairs of rows, by their cid."""
    cid, place = np.unique(table.column("cid").to_numpy(), return_inverse=True)
    root = forest(place[a], place[b], len(cid))
    child = np.flatnonzero(root != np.arange(len(cid)))
    return pa.RecordBatch.from_arrays([pa.array(cid[child]), pa.array(cid[root[child]])], ["a", "b"])


def _in_blocks(rows: DataFrame) -> DataFrame:
    """rows: key, cid, short, side (0: with all others, 1 and 2: only with the other side). Likely pairs of each key, as few as join what they join: a, b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            leaves = [np.arange(begin, end) for begin, end in group_bounds(table.column("key").to_numpy()) if end - begin > 1]
            yield _forest_of(table, *likely_pairs(_matrix(table.column("short")), leaves, table.column("side").to_numpy()))

    return rows.repartition("key").sortWithinPartitions("key").select("key", "cid", "short", "side").mapInArrow(trimmed(run), "a long, b long")


def _pivoted(rows: DataFrame) -> DataFrame:
    """rows: key, cid, order, n, short, size, pivot, pivot_short. Without pivot_short, but with near (the pair is a candidate) and stays (the row is split further)."""
    names = ["key", "cid", "order", "n", "short", "size", "pivot"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share = (_matrix(batch.column("short")) == _matrix(batch.column("pivot_short"))).mean(1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(share >= NEAR), pa.array(share < SURE)], [*names, "near", "stays"])

    return rows.select(*names, "pivot_short").mapInArrow(trimmed(run), "key long, cid long, order long, n long, short binary, size long, pivot long, near boolean, stays boolean")


def pairs_of_blocks(key: Column, place: Column, parts: Column) -> Column:
    """For a row in block `place` of `parts`: the key of each pair of blocks that it stands in, and its side there."""

    def pair(other: Column) -> Column:
        side = F.when(other == place, 0).when(other > place, 1).otherwise(2)
        return F.struct(F.xxhash64(key, F.least(place, other), F.greatest(place, other)).alias("key"), side.alias("side"))

    return F.transform(F.sequence(F.lit(0), parts - 1), pair)


def _met(rows: DataFrame, few: DataFrame, n: int, how: str = "left") -> DataFrame:
    """rows joined by key with a table of n rows: by broadcast if they are few, else as Spark finds best."""
    return rows.join(F.broadcast(few) if n <= BROADCAST_ROWS else few, "key", how)


def candidates(classes: DataFrame, folder: str, runs: int, small: int, most: int, block: int, similarity: float) -> DataFrame:
    """classes: cid, sig, n, sketch, short. Likely pairs: a, b."""
    first = [F.xxhash64(F.lit(r), _token(r)) for r in range(runs)]
    rows = classes.select(F.explode(F.array(*first)).alias("key"), "cid", F.xxhash64("sig").alias("order"), "n", "short")
    found: list[DataFrame] = []
    for level in range(LEVELS + 1):
        # keys of more than `most` rows: one in `most` rows at the highest
        large = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > most), folder, f"large-{level}")
        n_large = large.count()
        if not n_large:
            found.append(_bucketed(rows, small, similarity))
            break
        marked = _met(rows, large, n_large)
        found.append(_bucketed(marked.where("size is null"), small, similarity))
        within = marked.where("size is not null")
        pivots = staged(within.groupBy("key").agg(F.min(F.struct(F.xxhash64("order", F.lit(level)), "cid", "short")).alias("p")).select("key", F.col("p.cid").alias("pivot"), F.col("p.short").alias("pivot_short")), folder, f"pivots-{level}")
        compared = staged(_pivoted(_met(within, pivots, n_large, "inner")), folder, f"pivoted-{level}")
        found.append(compared.where("near and cid <> pivot").select(F.col("cid").alias("a"), F.col("pivot").alias("b")))
        stay = compared.where("stays")
        if level == LEVELS:
            parts = F.ceil(F.col("size") / block).cast("int")
            place = F.pmod("order", parts.cast("long")).cast("int")
            spread = stay.select("cid", "short", F.explode(pairs_of_blocks(F.col("key"), place, parts)).alias("_p"))
            found.append(_in_blocks(spread.select("_p.key", "cid", "short", "_p.side")))
            break
        draw = lambda i: F.pmod(F.xxhash64("key", F.lit(i)), F.lit(WIDTH))
        child = lambda i: F.xxhash64("key", draw(i), _short_token(draw(i)))
        drawn = F.when(F.pmod(F.xxhash64("key", F.lit("second")), F.lit(4)) == 0, F.array(child(1), child(2))).otherwise(F.array(child(1)))
        if level == 0:  # sets of unlike size part at once
            own = F.floor(F.log(F.col("n").cast("double")) / -math.log(similarity - 1e-9)).cast("int")
            drawn = F.flatten(F.transform(drawn, lambda k: F.array(F.xxhash64(k, own), F.xxhash64(k, own + 1))))
        rows = stay.select(F.explode(drawn).alias("key"), "cid", "order", "n", "short")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def shared_grams(grams: np.ndarray, doc: np.ndarray, left: np.ndarray, right: np.ndarray, rare: int = 32) -> np.ndarray:
    """How many n-grams each set of `left` shares with each of `right` (set numbers; the same or disjoint): len(left) x len(right).

    Frequent n-grams count by products of slices of their incidence matrix, rare ones pair by pair.
    """
    _, code, count = np.unique(grams, return_inverse=True, return_counts=True)
    n = int(doc.max(initial=-1)) + 1
    same = left is right
    at_left, at_right = np.full(n, -1), np.full(n, -1)
    at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(code, kind="stable")
    code, doc = code[order], doc[order]
    often = count > (rare if n > 2 * rare else 1)
    use = often[code]
    number = np.cumsum(often) - 1
    c, d = number[code[use]], doc[use]
    total, width = int(often.sum()), 4096 if n > 64 else 65536
    for begin in range(0, total, width):
        i, j = np.searchsorted(c, [begin, begin + width])
        part = np.zeros((n, min(width, total - begin)), np.float32)
        part[d[i:j], c[i:j] - begin] = 1
        out += part[left] @ part[right].T
    code, doc = code[~use], doc[~use]
    for step in range(1, rare):
        pair = np.flatnonzero(code[step:] == code[: max(0, len(code) - step)]) if step < len(code) else np.zeros(0, np.int64)
        if not len(pair):
            break
        x, y = doc[pair], doc[pair + step]
        for x, y in ((x, y), (y, x)):  # noqa: B020
            good = (at_left[x] >= 0) & (at_right[y] >= 0)
            np.add.at(out, (at_left[x[good]], at_right[y[good]]), np.float32(1))
    if same:
        np.fill_diagonal(out, 0)
    return out


def verified(rows: DataFrame, similarity: float) -> DataFrame:
    """rows: key, cid, copies, grams, side. Rows: a, b, n: b null: a has n links to other classes' rows here; else a and b are linked by a path."""
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 32_000_000):
            # a class stands once in a group, though a doc_id may stand in several rows
            keys, cids = table.column("key").to_numpy(), table.column("cid").to_numpy()
            once = np.sort(np.unique(np.stack([keys, cids]), axis=1, return_index=True)[1])
            if len(once) < len(keys):
                table = table.take(pa.array(once))
                keys, cids = keys[once], cids[once]
            copies, side = table.column("copies").to_numpy(), table.column("side").to_numpy()
            raw = table.column("grams").to_pylist()
            out: list[list[np.ndarray]] = [[], [], []]
            for begin, end in group_bounds(keys):
                n = end - begin
                if n < 2:
                    continue
                size = np.array([len(x) // 8 for x in raw[begin:end]])
                grams, doc = np.frombuffer(b"".join(raw[begin:end]), np.uint64), np.repeat(np.arange(n), size)
                cid, weight, halves = cids[begin:end], copies[begin:end], side[begin:end]
                left, right = np.flatnonzero(halves != 2), np.flatnonzero(halves != 1)
                right = left if len(left) == len(right) == n else right
                if not len(left) or not len(right):
                    continue
                shared = shared_grams(grams, doc, left, right)
                degree = np.zeros(n, np.int64)
                x, y = [], []
                for at in range(0, len(left), 512):
                    own, part = left[at : at + 512], shared[at : at + 512]
                    linked = part >= similarity * (size[own][:, None] + size[right][None, :] - part.astype(np.float64)) - 1e-9
                    if right is left:
                        linked[np.arange(len(own)), at + np.arange(len(own))] = False
                    degree[own] += linked @ weight[right]
                    if right is not left:
                        degree[right] += weight[own] @ linked
                    i, j = np.nonzero(linked)
                    root = forest(np.concatenate([*x[-1:], own[i]]), np.concatenate([*y[-1:], right[j]]), n)
                    x, y = [np.flatnonzero(root != np.arange(n))], [root[root != np.arange(n)]]
                met = np.flatnonzero(degree)
                for place, (one, two) in enumerate(((cid[met], cid[x[0]]), (np.full(len(met), -1), cid[y[0]]), (degree[met], np.zeros(len(x[0]), np.int64)))):
                    out[place] += one, two
            a, b, links = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in out)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64(), mask=b < 0), pa.array(links, pa.int64())], schema=kind)

    return rows.repartition("key").sortWithinPartitions("key").select("key", "cid", "copies", "grams", "side").mapInArrow(trimmed(run), "a long, b long, n long")


def _with_grams(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """members: first, sig, ... with grams (the set itself) of the document that stands for the class, once a task."""
    texts = docs.select(F.col("doc_id").cast("long").alias("first"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # of one shape at every size: texts move once, whether or not the members would fit a broadcast
    joined = texts.hint("merge").join(members, "first")
    names = [c for c in joined.columns if c not in ("text", "first", "sig")]
    fields = [joined.schema[c] for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, done = None, set()  # the join has sorted rows by first
        for batch in batches:
            for part in chunks(batch, "text"):
                grams, ends = shingle_sets(part.column("text"), words)
                begin = np.concatenate([[0], ends[:-1]])
                right = []
                for first, own, sig in zip(part.column("first").to_pylist(), _sigs(grams, ends), part.column("sig").to_pylist(), strict=True):
                    if first != last:
                        last, done = first, set()
                    right.append(own == sig and sig not in done)
                    done |= {sig} if right[-1] else set()
                sets = [grams[a:b].tobytes() for a, b in zip(begin.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(sets, pa.binary())], [*names, "grams"]).filter(pa.array(right, pa.bool_()))

    return joined.select("first", "text", "sig", *names).mapInArrow(trimmed(run), T.StructType([*fields, T.StructField("grams", T.BinaryType())]))


def join(docs: DataFrame, similarity: float = 0.8, words: int = 5, recall: float = 0.9995, small: int = 128, most: int = 16_384, block: int = 4_096) -> DataFrame:
    """docs: doc_id, text. A row for each: doc_id, class_id (smallest doc_id with the same n-gram set), n_links (other rows with at least this Jaccard similarity), group_id (smallest doc_id reachable by links), kept (the row stands for its group)."""
    spark = session_of(docs)
    folder = work_dir(spark)
    every = staged(sketch(docs, words).withColumn("row", F.monotonically_increasing_id()), folder, "sketches")
    linkable = every.where("sig is not null and doc_id is not null")
    grouped = linkable.groupBy("sig").agg(F.first("sketch").alias("sketch"), F.first("short").alias("short"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "row")).alias("first"))
    classes = staged(grouped.withColumn("cid", F.monotonically_increasing_id()), folder, "classes")
    likely = candidates(classes.select("cid", "sig", "n", "sketch", "short"), folder, runs_for(similarity, recall), small, most, block, similarity)
    stars = components(likely, f"{folder}/candidates")
    near = stars.select(F.col("u").alias("cid"), F.col("v").alias("root")).union(stars.select("v", "v").distinct())
    near = staged(near.join(classes.select("cid", "sig", "n", "copies", F.col("first.doc_id").alias("first")), "cid"), folder, "near")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).cast("int")
    several = staged(near.groupBy(F.col("root").alias("key")).agg(parts.alias("parts")).where("parts > 1"), folder, "several")
    members = _met(near.withColumnRenamed("root", "key"), several, several.count()).withColumn("parts", F.coalesce("parts", F.lit(1)))
    place = F.pmod(F.xxhash64("sig", F.lit("part")), F.col("parts").cast("long")).cast("int")
    sets = _with_grams(docs, members.select("first", "sig", "cid", "copies", "key", "parts", place.alias("place")), words)
    spread = sets.select("cid", "copies", "grams", F.explode(pairs_of_blocks(F.col("key"), F.col("place"), F.col("parts"))).alias("_p"))
    checked = staged(verified(spread.select("_p.key", "cid", "copies", "grams", "_p.side"), similarity), folder, "verified")
    ends = components(checked.where("b is not null").select("a", "b"), f"{folder}/links")
    degree = checked.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("degree"))
    linked = degree.join(ends.select(F.col("u").alias("cid"), F.col("v").alias("root")), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    linked = staged(linked.join(classes.select("cid", "first"), "cid"), folder, "linked")
    leader = linked.groupBy("root").agg(F.min("first").alias("leader"), F.count(F.lit(1)).alias("members"))
    known = hot_join(linked.select("cid", "degree", "root"), leader, "root", "members", linked.count(), "inner").select("cid", "degree", "leader")
    known = classes.select("cid", "sig", "copies", "first").join(known, "cid", "left").select("sig", "copies", "first", F.coalesce("leader", "first").alias("leader"), (F.col("copies") - 1 + F.coalesce("degree", F.lit(0))).alias("n_links"))
    known = staged(known, folder, "known")
    keep_only(spark, folder, "sketches", "known")
    done = hot_join(linkable.select("doc_id", "row", "sig"), known, "sig", "copies", linkable.count(), "inner")
    out = done.select("doc_id", F.col("first.doc_id").alias("class_id"), "n_links", F.col("leader.doc_id").alias("group_id"), (F.struct("doc_id", "row") == F.col("leader")).alias("kept"))
    alone = every.where("sig is null or doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("group_id"), F.lit(True).alias("kept"))
    return out.unionByName(alone)


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \t\n\r\x0b\x0c]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(md5(g), '' ORDER BY g)) AS sig FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
p AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE both_ >= 0.8 * (x.n + y.n - both_) - 1e-9),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a),
r AS (SELECT a AS doc_id, min(b) AS group_id FROM reach GROUP BY a),
k AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY sig) AS class_id FROM n)
SELECT r.doc_id, coalesce(class_id, r.doc_id) AS class_id, (SELECT count(*) FROM p WHERE p.a = r.doc_id) AS n_links, group_id, r.doc_id = group_id AS kept
FROM r LEFT JOIN k USING (doc_id)
"""
