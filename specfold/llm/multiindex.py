"""Near-duplicate vectors through an inverted multi-index.

Vectors scaled to length one are cut in halves; a codebook for each half, fitted by k-means on a
bounded sample, makes a product grid of cells, and every vector stands in the cell of its nearest
centroids. The multi-sequence traversal visits the cells nearest to a vector in the order of its distance from them. How many it visits
is measured on partners made for sampled vectors at exactly the threshold cosine, the hardest that have to be found, so it does not depend
on the links that the sample happens to hold: as many cells as let the share `recall` of these pairs meet, that is one of the two visits the
cell of the other. No other cap ends the traversal, up to all cells. Of the cells visited, those that cannot hold a link by the bound between two centroids are passed over.

Centroids of each half are put in an order in which neighbours are near one another, and the product grid is tiled by runs of both orders.
The cells of a tile are packed to blocks of bounded size, which are thus compact in both halves, and a visit to a cell is one to its block.
A vector is copied to each block that it visits, and verified there by cosine in double precision against the vectors that stand in it.
A pair whose blocks are both visited by the other is met in the first of them alone, so links are counted once.

Vectors of equal components form a class and go on as one. Links join classes to components; only
spanning forests and a count for each vector leave a task, never all pairs.

Vectors are scaled by their largest component before any product, so that neither very large nor very small ones overflow or
vanish. Vectors of different lengths (numbers of components) have no cosine: each length is a table of its own. Vectors that are null, empty, zero or
hold null or non-finite components link with nothing; rows with a null vec_id neither. Repeated rows are copies of one another.
An empty table gives no rows. Further columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specfold.llm.common import group_bounds, hot_join, keep_only, session_of, staged, trimmed, work_dir
from specfold.llm.components import components, forest

FIT_ROWS = 16_384
#: Sampled vectors for which partners are made, two each.
PROBES = 4_096
#: Bytes of vectors in a block of cells at most, and blocks at least if that makes none smaller than asked for.
BLOCK_BYTES = 16_000_000
#: Blocks that a table is cut into as soon as they hold the vectors asked for.
SPREAD = 1_000
#: Blocks whose visitors of one block are dealt over one more task.
SHARE = 64


def prepared(vectors: DataFrame) -> DataFrame:
    """vectors: vec_id, embedding. Rows: vec_id, sig (null: links with nothing), size, vec (components, 64-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding").cast(pa.large_list(pa.float64()))
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int32)
            begin = column.offsets.to_numpy()[:-1]
            flat = pc.fill_null(column.values, float("nan")).to_numpy(zero_copy_only=False) + 0.0  # no negative zero
            sigs: list[bytes | None] = [None] * batch.num_rows
            vecs: list[bytes | None] = [None] * batch.num_rows
            for n in np.unique(sizes[sizes > 0]).tolist():
                rows = np.flatnonzero(sizes == n)
                x = flat[begin[rows][:, None] + np.arange(n)]
                most = np.abs(x).max(1)
                for row, v in zip(rows[np.isfinite(most) & (most > 0)].tolist(), x[np.isfinite(most) & (most > 0)], strict=True):
                    vecs[row] = v.tobytes()
                    sigs[row] = xxhash.xxh3_128_digest(vecs[row])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(sigs, pa.binary()), pa.array(sizes), pa.array(vecs, pa.binary())], ["vec_id", "sig", "size", "vec"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(trimmed(run), "vec_id long, sig binary, size int, vec binary")


def unit(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The vectors, all of one length, scaled to 1; by their largest component first."""
    raw = column.to_pylist()
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    scale = np.abs(x).max(1, keepdims=True)
    with np.errstate(over="ignore"):
        tiny = scale < 1e-300  # whose quotients would not be exact
        x = np.where(tiny, x * 2.0**900, x) / np.where(tiny, scale * 2.0**900, scale)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = np.argmin(distances(x, centers), 1)
        total = np.zeros_like(centers)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=k)
        centers[count > 0] = total[count > 0] / count[count > 0, None]
    return centers


def distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(1)[None, :])


class Grid:
    """Two codebooks and the product grid of their cells; cell number: first * size of the second + second."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.books = (first, second)
        self.half = first.shape[1]
        self.gaps = [np.sqrt(distances(b, b)) for b in self.books]

    def squares(self, x: np.ndarray) -> list[np.ndarray]:
        return [distances(x[:, : self.half], self.books[0]), distances(x[:, self.half :], self.books[1])]

    def cells(self, squares: list[np.ndarray]) -> np.ndarray:
        return np.argmin(squares[0], 1) * len(self.books[1]) + np.argmin(squares[1], 1)

    def walk(self, squares: list[np.ndarray], most: int) -> np.ndarray:
        """For each row the first `most` cells in the order of the multi-sequence traversal.

        At places i and j of the two orders of centroids, (i + 1) (j + 1) cells come no later; so places where that is more than `most` need no look.
        """
        near = [np.argsort(s, axis=1, kind="stable") for s in squares]
        low = [np.take_along_axis(s, o, 1) for s, o in zip(squares, near, strict=True)]
        i, j = self.corner(most)
        cost = low[0][:, i] + low[1][:, j]
        if cost.shape[1] > most:
            pick = np.argpartition(cost, most - 1, axis=1)[:, :most]
        else:
            pick = np.broadcast_to(np.arange(cost.shape[1]), cost.shape)
        pick = np.take_along_axis(pick, np.argsort(np.take_along_axis(cost, pick, 1), axis=1, kind="stable"), 1)
        return np.take_along_axis(near[0], i[pick], 1) * len(self.books[1]) + np.take_along_axis(near[1], j[pick], 1)

    def corner(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The places that can be among the first `most`."""
        i = np.arange(min(len(self.books[0]), most))
        widths = np.minimum(len(self.books[1]), most // (i + 1))
        return np.repeat(i, widths), np.arange(widths.sum()) - np.repeat(np.cumsum(widths) - widths, widths)

    def rank(self, squares: list[np.ndarray], cells: np.ndarray) -> np.ndarray:
        """How many cells the traversal of each row has visited when it reaches the row's cell in `cells`."""
        a, b = squares
        rows, n = np.arange(len(cells)), len(self.books[1])
        cost = (a[rows, cells // n] + b[rows, cells % n]) * (1 + 1e-12)
        order = np.sort(b, axis=1)
        return np.array([np.searchsorted(order[r], cost[r] - a[r], side="right").sum() for r in rows.tolist()], np.int64)

    def bounds(self, squares: list[np.ndarray]) -> list[np.ndarray]:
        """For each half the squared distance that each row has at least to vectors of each centroid, by the same planes."""
        out = []
        for square, gap in zip(squares, self.gaps, strict=True):
            own = np.argmin(square, 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                low = (square - square[np.arange(len(square)), own][:, None]) / (2 * gap[own])
            low[np.arange(len(square)), own] = 0
            out.append(np.nan_to_num(np.maximum(low, 0), nan=0.0, posinf=0.0) ** 2)
        return out


def fit(classes: DataFrame, total: int, cosine: float, recall: float) -> tuple[Grid, int]:
    """Codebooks from at most FIT_ROWS classes, those with the smallest hash, and the number of cells to visit for the recall."""
    got = classes.orderBy(F.xxhash64("sig"), "sig").limit(FIT_ROWS).select("vec").toArrow()
    x = unit(got.column("vec"))
    half = max(1, x.shape[1] // 2)
    known = x[PROBES:] if len(x) > 2 * PROBES else x  # where there are enough, vectors that the codebooks have not seen are probed
    k = min(1024, len(known), max(4, int(np.sqrt(total / 64))))
    grid = Grid(kmeans(known[:, :half], k), kmeans(_wide(known)[:, half:], k, seed=12))
    return grid, visits(grid, x[:PROBES], cosine, recall, both=False)


def partners(x: np.ndarray, cosine: float, seed: int = 13) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of x beside vectors at exactly that cosine from them: away in any direction, then in the direction from one row to another."""
    rng = np.random.default_rng(seed)
    for way in (rng.normal(size=x.shape), x[rng.permutation(len(x))] - x[rng.permutation(len(x))]):
        way = way - (way * x).sum(1, keepdims=True) * x
        length = np.sqrt((way * way).sum(1))
        some = length > 1e-6
        yield x[some], cosine * x[some] + np.sqrt(1 - cosine * cosine) * way[some] / length[some, None]


def visits(grid: Grid, x: np.ndarray, cosine: float, recall: float, both: bool = True) -> int:
    """How many cells each of two vectors at that cosine visits until both have visited the other's, or one of them has, for the share `recall` of such pairs."""
    need = [np.zeros(0, np.int64)]
    for one, other in partners(x, cosine):
        a, b = grid.squares(_wide(one)), grid.squares(_wide(other))
        need.append((np.maximum if both else np.minimum)(grid.rank(a, grid.cells(b)), grid.rank(b, grid.cells(a))))
    ranks, every = np.concatenate(need), len(grid.books[0]) * len(grid.books[1])
    return min(every, int(np.quantile(ranks, recall, method="higher"))) if len(ranks) else every


def _wide(x: np.ndarray) -> np.ndarray:
    return x if x.shape[1] > 1 else np.concatenate([x, np.zeros((len(x), 1))], 1)


def neighbours(centers: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Order of the centers in which near ones stand together: halved by weight across their longest direction, again and again."""
    if len(centers) < 3:
        return np.arange(len(centers))
    away = centers - centers.mean(0)
    order = np.argsort(away @ np.linalg.svd(away, full_matrices=False)[2][0], kind="stable")
    sums = np.cumsum(weight[order])
    cut = min(max(1, int(np.searchsorted(sums, sums[-1] / 2)) + 1), len(order) - 1) if sums[-1] else len(order) // 2
    return np.concatenate([part[neighbours(centers[part], weight[part])] for part in (order[:cut], order[cut:])])


def tiled(grid: Grid, members: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells in an order in which tiles of near cells stand together, and the tile of each in that order. A tile holds about `most` vectors."""
    table = members.reshape(len(grid.books[0]), -1)
    n = max(1, int(np.ceil(np.sqrt(members.sum() / most))))
    place, tile = [], []
    for book, weight in zip(grid.books, (table.sum(1), table.sum(0)), strict=True):
        order = neighbours(book, weight)
        place.append(np.empty(len(order), np.int64))
        place[-1][order] = np.arange(len(order))
        tile.append(np.empty(len(order), np.int64))
        tile[-1][order] = np.minimum(n - 1, (np.cumsum(weight[order]) - weight[order] / 2) * n // max(1, weight.sum()))
    first, second = np.divmod(np.arange(len(members)), len(grid.books[1]))
    tiles = tile[0][first] * n + tile[1][second]
    cells = np.lexsort((place[1][second], place[0][first], tiles))
    return cells, tiles[cells]


def packed(members: np.ndarray, most: int, tiles: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For the number of vectors of each cell: its first block and its number of blocks. Only a cell of more than `most` vectors has several, all its own.

    tiles: the tile of each cell, in ascending order; a block ends with its tile unless all of the next one finds room in it.
    """
    first, parts = np.zeros(len(members), np.int64), np.ones(len(members), np.int64)
    whole = None if tiles is None else np.bincount(tiles, members)
    now, held, tile = 0, 0, None
    for c in np.flatnonzero(members).tolist():
        m = int(members[c])
        room = m if whole is None or tiles[c] == tile else max(m, int(whole[tiles[c]]))
        tile = None if whole is None else tiles[c]
        if held and held + room > most:
            now, held = now + 1, 0
        first[c], parts[c] = now, -(-m // most)
        held += m
        if parts[c] > 1:
            now, held = now + int(parts[c]), 0
    return first, parts


def links(x: np.ndarray, y: np.ndarray, cosine: float, rows: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of x and y, all of length one, of that cosine, some rows of x at a time. Single precision decides where its error cannot matter."""
    error = (x.shape[1] + 4) * 2.0**-22
    x4, y4 = x.astype(np.float32), y.astype(np.float32)
    for at in range(0, len(x), rows):
        near = x4[at : at + rows] @ y4.T
        linked = near >= cosine + error
        if np.count_nonzero(near >= cosine - error) != np.count_nonzero(linked):
            linked = x[at : at + rows] @ y.T >= cosine
        i, j = np.nonzero(linked)
        yield i + at, j


def found_pairs(classes: DataFrame, grid: Grid, most: int, cosine: float, block: int) -> DataFrame:
    """classes: cid, vec, copies, of which each visits `most` cells. From blocks of at most `block` vectors, verified links: a, b, n: b null: a has n links to rows of other classes there; else a and b are linked by a path."""
    spark = session_of(classes)
    limit = 2 - 2 * cosine + 1e-9
    n_cells = len(grid.books[0]) * len(grid.books[1])
    sent = spark.sparkContext.broadcast(grid)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = np.zeros(n_cells, np.int64)
        for batch in batches:
            members += np.bincount(sent.value.cells(sent.value.squares(_wide(unit(batch.column("vec"))))), minlength=n_cells)
        used = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(members[used], pa.int64())], ["cell", "members"])

    # one row a cell, of which there are at most 1024 x 1024
    sums = classes.select("vec").mapInArrow(trimmed(count), "cell long, members long").groupBy("cell").agg(F.sum("members").alias("m")).toArrow()
    members = np.zeros(n_cells, np.int64)
    members[sums.column("cell").to_numpy()] = sums.column("m").to_numpy()
    cells, tiles = tiled(grid, members, block)
    first, parts = np.zeros(n_cells, np.int64), np.ones(n_cells, np.int64)
    first[cells], parts[cells] = packed(members[cells], block, tiles)
    used = cells[members[cells] > 0]
    n_blocks = int((first + parts)[used].max())
    shares = -(-n_blocks // SHARE)
    shared = spark.sparkContext.broadcast((used, first, parts))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, first, parts = shared.value
        grid = sent.value
        n = len(grid.books[1])
        opens = np.concatenate([[True], first[used][1:] != first[used][:-1]])
        run_of = np.full(len(first), -1, np.int32)  # cells that share a block are one run
        run_of[used] = np.cumsum(opens) - 1
        run_of_block = np.repeat(np.arange(opens.sum()), parts[used][opens])
        step = max(1, 4_000_000 // max(len(grid.corner(most)[0]), n_blocks))
        for batch in batches:
            for begin in range(0, batch.num_rows, step):
                part = batch.slice(begin, step)
                squares = grid.squares(_wide(unit(part.column("vec"))))
                cell = grid.cells(squares)
                number = part.column("cid").to_numpy() % 1_000_003
                home, share = first[cell] + number % parts[cell], number // parts[cell] % shares
                seen = grid.walk(squares, most)
                a, b = grid.bounds(squares)
                can = np.take_along_axis(a, seen // n, 1) + np.take_along_axis(b, seen % n, 1) <= limit
                row, at = np.nonzero(can & (run_of[seen] >= 0))
                reached = np.zeros((part.num_rows, int(opens.sum())), bool)
                reached[row, run_of[seen[row, at]]] = True
                reached[np.arange(part.num_rows), run_of[cell]] = True
                reached = reached[:, run_of_block]
                ways = pa.array([w.tobytes() for w in np.packbits(reached, axis=1)], pa.binary())
                # at home once for each share of the block's visitors, elsewhere as a visitor
                row = np.repeat(np.arange(part.num_rows), shares)
                yield from copies_of(part, row, home[row] * shares + np.tile(np.arange(shares), part.num_rows), home, share, ways)
                reached[np.arange(part.num_rows), home] = False
                row, to = np.nonzero(reached)
                yield from copies_of(part, row, to * shares + share[row], home, share, None)

    def copies_of(part: pa.RecordBatch, row: np.ndarray, key: np.ndarray, home: np.ndarray, share: np.ndarray, ways: pa.Array | None) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(row), 16_384):  # a bounded number leaves at a time
            own = row[at : at + 16_384]
            pick = pa.array(own)
            visitor = pa.array(np.full(len(own), ways is None))
            columns = [pa.array(key[at : at + 16_384]), visitor, part.column("cid").take(pick), part.column("copies").take(pick), part.column("vec").take(pick), pa.array(home[own]), pa.array(share[own]), pa.nulls(len(own), pa.binary()) if ways is None else ways.take(pick)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "visitor", "cid", "copies", "vec", "home", "share", "ways"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key, those at home first; these are held, at most a block of them, and visitors pass by in batches."""
        now, held, at_home = None, [], None
        for batch in batches:
            keys = batch.column("key").to_numpy()
            visitor = batch.column("visitor").to_numpy(zero_copy_only=False)
            for begin, end in group_bounds(keys * 2 + visitor):
                part = batch.slice(begin, end - begin)
                if held and (keys[begin] != now or visitor[begin]):
                    at_home = Home(pa.Table.from_batches(held), now // shares)
                    held = []
                    yield from at_home.among(now % shares, cosine)
                if keys[begin] != now:
                    at_home = None
                now = int(keys[begin])
                if not visitor[begin]:
                    held.append(part)
                elif at_home is not None:  # a part of a cell may have no vector
                    yield from at_home.visited(part, cosine)
        if held:
            yield from Home(pa.Table.from_batches(held), now // shares).among(now % shares, cosine)

    dealt = classes.select("cid", "copies", "vec").mapInArrow(trimmed(deal), "key long, visitor boolean, cid long, copies long, vec binary, home long, share long, ways binary")
    return dealt.repartition(min(n_blocks * shares, 8_192), "key").sortWithinPartitions("key", "visitor").mapInArrow(trimmed(verify), "a long, b long, n long")


class Home:
    """The vectors of one block, and what they are linked with."""

    def __init__(self, rows: pa.Table, block: int):
        self.block = block
        self.x = unit(rows.column("vec"))
        self.cid, self.copies, self.share = (rows.column(c).to_numpy() for c in ("cid", "copies", "share"))
        raw = rows.column("ways").to_pylist()
        self.ways = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)

    def among(self, share: int, cosine: float) -> Iterator[pa.RecordBatch]:
        """Links of this share of the vectors with all of the block; those of the others are counted with their own share."""
        mine = np.flatnonzero(self.share == share)
        pairs = ((mine[i], j) for i, j in links(self.x[mine], self.x, cosine))
        yield from _found(((i[i != j], j[i != j]) for i, j in pairs), self.cid, self.copies, both=False)

    def visited(self, part: pa.RecordBatch, cosine: float) -> Iterator[pa.RecordBatch]:
        """Links of visitors, but for those that are met in the visitor's own block, which comes before."""
        n, home = len(self.x), part.column("home").to_numpy()

        def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for i, j in links(unit(part.column("vec")), self.x, cosine):
                at = home[i]
                first = (at > self.block) | (self.ways[j, at >> 3] >> (7 - (at & 7)) & 1 == 0)
                yield i[first] + n, j[first]

        yield from _found(pairs(), np.concatenate([self.cid, part.column("cid").to_numpy()]), np.concatenate([self.copies, part.column("copies").to_numpy()]), both=True)


def _found(pairs: Iterator[tuple[np.ndarray, np.ndarray]], cid: np.ndarray, copies: np.ndarray, both: bool) -> Iterator[pa.RecordBatch]:
    """Counts of links, of the first of each pair or of both, and a spanning forest of them."""
    a, b, degree = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(cid), np.int64)
    for i, j in pairs:
        if not len(i):
            continue
        np.add.at(degree, i, copies[j])
        if both:
            np.add.at(degree, j, copies[i])
        root = forest(np.concatenate([a, i]), np.concatenate([b, j]), len(cid))
        a = np.flatnonzero(root != np.arange(len(root)))
        b = root[a]
    met = np.flatnonzero(degree)
    if len(met):
        columns = (np.concatenate([cid[met], cid[a]]), np.concatenate([np.full(len(met), -1), cid[b]]), np.concatenate([degree[met], np.zeros(len(a), np.int64)]))
        yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1], mask=columns[1] < 0), pa.array(columns[2])], ["a", "b", "n"])


def linked(classes: DataFrame, total: int, size: int, cosine: float, recall: float, block: int) -> DataFrame:
    """classes: cid, sig, vec, copies of `total` vectors of `size` components. As found_pairs."""
    together = max(block, min(BLOCK_BYTES // (8 * size), total // SPREAD))
    return found_pairs(classes, *fit(classes, total, cosine, recall), cosine, together)


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, recall: float = 0.995, block: int = 1024) -> DataFrame:
    """vectors: vec_id, embedding. A row for each: vec_id, n_links, component_id, kept. recall: share of pairs at exactly that cosine to be found; nearer ones are found more surely."""
    spark = session_of(vectors)
    folder = work_dir(spark)
    every = staged(prepared(vectors), folder, "vectors")
    usable = F.col("sig").isNotNull() & F.col("vec_id").isNotNull()
    linkable = every.where(usable)
    alone = every.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    grouped = linkable.groupBy("sig", "size").agg(F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    classes = staged(grouped.withColumn("cid", F.monotonically_increasing_id()), folder, "classes")
    # lengths that occur, with the number of their classes; of one class there is nothing to compare
    sizes = [(r["size"], r["count"]) for r in classes.groupBy("size").count().where("count > 1").orderBy("size").collect()]
    for i, (size, total) in enumerate(sizes):
        own = linked(classes.where(F.col("size") == size), total, size, cosine, recall, block)
        own.write.mode("append" if i else "overwrite").parquet(f"{folder}/links")
    if sizes:
        found = spark.read.schema("a long, b long, n long").parquet(f"{folder}/links")
    else:
        found = spark.createDataFrame([], "a long, b long, n long")
    ends = components(found.where("b is not null").select("a", "b"), f"{folder}/ends")
    degree = found.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("degree"))
    joined = degree.join(ends.select(F.col("u").alias("cid"), F.col("v").alias("root")), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    joined = staged(joined.join(classes.select("cid", "first"), "cid"), folder, "joined")
    leader = joined.groupBy("root").agg(F.min("first").alias("leader"), F.count(F.lit(1)).alias("members"))
    known = hot_join(joined.select("cid", "degree", "root"), leader, "root", "members", joined.count(), "inner").select("cid", "degree", "leader")
    known = classes.select("cid", "sig", "copies", "first").join(known, "cid", "left")
    known = known.select("sig", "copies", F.coalesce("leader", "first").alias("component_id"), (F.col("copies") - 1 + F.coalesce("degree", F.lit(0))).alias("n_links"))
    known = staged(known, folder, "known")
    keep_only(spark, folder, "vectors", "known")
    done = hot_join(linkable.select("vec_id", "sig"), known, "sig", "copies", linkable.count(), "inner")
    return done.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")).unionByName(alone)


ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b
      ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
r AS (
  WITH RECURSIVE reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a)
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT r.vec_id, (SELECT count(*) FROM p WHERE p.a = r.vec_id) AS n_links, component_id,
       r.vec_id = component_id AS kept
FROM r
"""
