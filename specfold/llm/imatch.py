"""I-Match document fingerprints over randomised lexicon subsets.

Terms are runs of letters, digits, underscores and non-ASCII characters of the lower-case text.
The lexicon holds the terms found in at least `low` and at most `high` of all documents, a band
of inverse document frequency counted over the whole table; it has at most (distinct terms of a
mean document) / low entries however large the table, so it is gathered and broadcast.

REPLICAS families of LEVELS nested subsets of the lexicon are drawn by hash: the first of a family is the whole
lexicon, each further one keeps half of the terms of the one before. For each subset a document's distinct band
terms in it are sorted, by their own hash, and the sequence is hashed to 16 bits (0: none in it). All
documents meet the same subsets. The dense ones agree where no band term differs, as in plain
I-Match; the sparse ones agree also where some do, as often as no differing term is in them. A fingerprint is the hashes of
the families in a row, four hexadecimal digits each; the first subsets are equal and stand once. Two fingerprints' likeness is the share of
equal hashes among those not 0 on both sides, each weighted by one over the share of the lexicon that its subset keeps, so that
it falls with the number of differing terms and not at the first of them; 0 if all are 0. Equal texts have equal fingerprints of likeness 1.

A document without a band term uses all its terms, one without terms its whole text (null: empty)
as one term. Terms of more than 64 bytes are named by their MD5. Repeated rows have equal fingerprints; for the
edited text, rows of equal doc_id stand by text hash, then as read, null doc_ids first. Long texts are used whole. An empty table gives no rows.
Further columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specfold.llm.common import session_of, trimmed
from specfold.llm.encode import chunks

REPLICAS = 8
LEVELS = 11
#: Hashes of a fingerprint: the whole lexicon, and the other levels of each family.
SUBSETS = 1 + REPLICAS * (LEVELS - 1)
#: One over the share of the lexicon that a subset keeps.
WEIGHTS = np.array([1, *[1 << level for _ in range(REPLICAS) for level in range(1, LEVELS)]])
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = True
_LONG = 64
_FLUSH = 400_000


def chunk_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct runs of the texts (bytes); and the (document, run) pairs of those that are terms, ascending."""
    low = pc.utf8_lower(texts.cast(pa.large_string()))
    n = len(low)
    none = np.zeros(0, np.int64)
    bounds = np.frombuffer(low.buffers()[1], np.int64)[low.offset : low.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(low.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]] if n else np.zeros(0, np.uint8)
    if not len(raw):
        return pa.array([], pa.large_binary()), none, none
    bounds = bounds - bounds[0]
    word = _WORD[raw]
    mark = np.zeros(len(raw) + 1, bool)
    mark[1:-1] = word[1:] != word[:-1]
    mark[bounds] = True
    mark[-1] = True
    at = np.flatnonzero(mark).astype(np.int64)
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw)]).dictionary_encode()
    chosen = word[at[:-1]]
    doc = np.searchsorted(bounds, at[:-1][chosen], "right") - 1
    pairs = np.unique(doc << 32 | coded.indices.to_numpy()[chosen])
    return coded.dictionary, pairs >> 32, pairs & 0xFFFFFFFF


def names_of(runs: pa.Array) -> pa.Array:
    """The terms' names: long ones are named by a hash."""
    long = np.flatnonzero(pc.binary_length(runs).to_numpy() > _LONG)
    if not len(long):
        return runs
    names = runs.to_pylist()
    for i in long.tolist():
        names[i] = b"#" + hashlib.md5(names[i]).hexdigest().encode()
    return pa.array(names, pa.large_binary())


def frequencies(docs: DataFrame) -> DataFrame:
    """term, n: in how many of all rows each term is found. Tasks add up before they send."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        emit = lambda: pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])
        for batch in batches:
            for part in chunks(batch, "text"):
                runs, _, term = chunk_terms(part.column("text"))
                found = np.bincount(term, minlength=len(runs))
                used = np.flatnonzero(found)
                for name, n in zip(names_of(runs.take(pa.array(used))).cast(pa.large_string()).to_pylist(), found[used].tolist(), strict=True):
                    counts[name] = counts.get(name, 0) + n
                if len(counts) > _FLUSH:
                    yield emit()
                    counts.clear()
        if counts:
            yield emit()

    texts = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.mapInArrow(trimmed(run), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


class Lexicon:
    """Terms of the band, each with a key and, for each family, the last level that keeps it."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.names: pa.Array | None = None

    def ready(self) -> Lexicon:
        if self.names is None:
            names = [t.encode() for t in self.terms]
            self.names = pa.array(names, pa.large_binary())
            self.keys, self.levels = keys_of(names), levels_of(names)
        return self

    def number(self, names: pa.Array) -> np.ndarray:
        """Places of the names in the lexicon, -1 if they are not in it."""
        return pc.fill_null(pc.index_in(names, self.names), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def keys_of(terms: list[bytes]) -> np.ndarray:
    """60 bits of a term's MD5."""
    return np.fromiter((int.from_bytes(hashlib.md5(t).digest()[:8], "big") >> 4 for t in terms), np.uint64, len(terms))


def levels_of(terms: list[bytes]) -> np.ndarray:
    """Terms x REPLICAS: the last level that keeps a term, by the leading zeros of 16 bits for each family."""
    raw = b"".join(hashlib.md5(b"subsets:" + t).digest()[: 2 * REPLICAS] for t in terms)
    drawn = np.frombuffer(raw, ">u2").reshape(-1, REPLICAS).astype(np.float64)
    return np.minimum(LEVELS - 1, 15 - np.floor(np.log2(np.maximum(drawn, 1)))).astype(np.uint8)


def fingerprints(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """Hashes (n x SUBSETS, uint16)."""
    n = len(texts)
    runs, doc, term = chunk_terms(texts)
    names = names_of(runs)
    number = lexicon.number(names)
    inside = number[term] >= 0
    banded = np.bincount(doc[inside], minlength=n) > 0
    use = inside | ~banded[doc]
    doc, term = doc[use], term[use]
    # keys and levels of the distinct terms that are used
    used, term = np.unique(term, return_inverse=True)
    at = number[used]
    known = at >= 0
    keys, levels = np.zeros(len(used), np.uint64), np.zeros((len(used), REPLICAS), np.uint8)
    keys[known], levels[known] = lexicon.keys[at[known]], lexicon.levels[at[known]]
    other = names.take(pa.array(used[~known])).to_pylist()
    keys[~known], levels[~known] = keys_of(other), levels_of(other)
    bare = np.flatnonzero(~np.isin(np.arange(n), doc))
    if len(bare):  # no terms at all: the whole text is one
        whole = names_of(pa.array([texts[int(i)].as_py().encode() for i in bare], pa.large_binary())).to_pylist()
        term, doc = np.concatenate([term, len(used) + np.arange(len(bare))]), np.concatenate([doc, bare])
        keys, levels = np.concatenate([keys, keys_of(whole)]), np.concatenate([levels, levels_of(whole)])
    by_key = np.argsort(keys, kind="stable")
    place = np.empty(len(keys), np.int64)
    place[by_key] = np.arange(len(keys))
    order = np.lexsort((place[term], doc))  # each document's distinct terms, sorted
    doc, keys, levels = doc[order], keys[term[order]], levels[term[order]]
    out = np.zeros((n, SUBSETS), np.uint16)
    out[:, 0] = _hashed(doc, keys, n)
    for replica in range(REPLICAS):
        d, k, v = doc, keys, levels[:, replica]
        for level in range(1, LEVELS):
            keep = v >= level
            d, k, v = d[keep], k[keep], v[keep]
            out[:, replica * (LEVELS - 1) + level] = _hashed(d, k, n)
    return out


def _hashed(doc: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """A hash of each document's sequence of keys (rows stand by document): the sum of key * (2 * place + 1) in 64 bits, to 16 bits but 0; 0 without keys."""
    count = np.bincount(doc, minlength=n)
    begin = np.cumsum(count) - count
    place = (np.arange(len(doc)) - begin[doc]).astype(np.uint64)
    full = np.flatnonzero(count)
    out = np.zeros(n, np.uint16)
    if len(full):
        total = np.add.reduceat(keys * (place * np.uint64(2) + np.uint64(1)), begin[full])
        out[full] = ((total >> np.uint64(24)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
    return out


def texts_of(hashes: np.ndarray) -> list[str]:
    big = np.ascontiguousarray(hashes.astype(">u2"))
    return [row.tobytes().hex() for row in big]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row."""
    some = ((a > 0) | (b > 0)) @ WEIGHTS
    return ((a == b) & (a > 0)) @ WEIGHTS / np.maximum(some, 1)


def lexicon_of(docs: DataFrame, low: float = 0.0005, high: float = 0.2) -> Lexicon:
    total = docs.count()
    band = frequencies(docs).where((F.col("n") >= max(2.0, low * total)) & (F.col("n") <= high * total))
    return Lexicon(sorted(band.select("term").toArrow().column("term").to_pylist()))


def _part(columns: list[Column], cuts: list[tuple[int, int, int]]) -> Column:
    """How many cut points are at or below the key (doc_id, tie, row; a null doc_id is the least number)."""
    points = np.array(cuts, np.int64).reshape(-1, 3)
    first = points[:, 0]

    @F.pandas_udf("int")
    def place(doc_id: pd.Series, tie: pd.Series, row: pd.Series) -> pd.Series:
        key = doc_id.to_numpy()
        low, high = np.searchsorted(first, key, "left"), np.searchsorted(first, key, "right")
        out = high.astype(np.int32)
        # a doc_id that is a cut point itself, with many rows perhaps: by what follows
        for i in np.flatnonzero(high > low).tolist():
            own = points[low[i] : high[i], 1:].tolist()
            out[i] = low[i] + bisect_right(own, [int(tie.iat[i]), int(row.iat[i])])
        return pd.Series(out)

    return place(*columns) if cuts else F.lit(0)


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, text, _key, _tie, _row, _part, _ahead: dealt evenly to parts by doc_id, text hash and place of reading, each part followed by the text of the first row of the next (_ahead; after the last part: of the first).

    Cut points, one a part, come from a pass over those keys alone, so rows of one doc_id are split too; texts move once.
    """
    spark = session_of(docs)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumns({"_key": F.coalesce("doc_id", F.lit(-(1 << 63))), "_tie": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    key = ["_key", "_tie", "_row"]
    sorted_ = rows.select(*key).repartitionByRange(parts, *key)
    # one row a part
    heads = sorted(tuple(h) for h in sorted_.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(*key)).alias("h")).select("h.*").collect())
    dealt = rows.withColumns({"_part": _part([F.col(c) for c in key], heads[1:]), "_ahead": F.lit(False)})
    if not heads:
        return dealt, parts
    # by value, so that it does not matter which of equal rows is read first in this pass
    first = spark.createDataFrame(sorted({h[:2] for h in heads}), "_key long, _tie long")
    texts = rows.join(F.broadcast(first), ["_key", "_tie"]).groupBy("_key", "_tie").agg(F.first("text").alias("text"))
    after = spark.createDataFrame([(*h[:2], (i - 1) % len(heads)) for i, h in enumerate(heads)], "_key long, _tie long, _part int")
    ahead = texts.join(F.broadcast(after), ["_key", "_tie"]).select(F.lit(None).cast("long").alias("doc_id"), "text", "_key", "_tie", F.lit(0).cast("long").alias("_row"), "_part", F.lit(True).alias("_ahead"))
    return dealt.unionByName(ahead), parts


def fingerprint_edits(docs: DataFrame, low: float = 0.0005, high: float = 0.2) -> DataFrame:
    """docs: doc_id, text. Rows: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has in place of its last quarter of code points (rounded down) the first as
    many of the next document by doc_id (null first, equal ones by text hash; after the last: the first).
    """
    sent = session_of(docs).sparkContext.broadcast(lexicon_of(docs, low, high))
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def finish(rows: list[tuple], lexicon: Lexicon) -> pa.RecordBatch:
        """rows: doc_id, text, next text."""
        edited = [t[: len(t) - len(t) // 4] + after[: len(t) // 4] for _, t, after in rows]
        own = fingerprints(pa.array([t for _, t, _ in rows] + [rows[-1][2]], pa.large_string()), lexicon)
        new = fingerprints(pa.array(edited, pa.large_string()), lexicon)
        columns = [[d for d, _, _ in rows], [len(t) for _, t, _ in rows], [hashlib.sha256(x.encode()).hexdigest() for x in edited], texts_of(own[:-1]), texts_of(new), likeness(own[:-1], new), likeness(own[:-1], own[1:])]
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = sent.value.ready()
        held: list[tuple] = []  # texts in a row, the last still without its next
        size = 0
        for batch in batches:
            for doc, text, ahead in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "_ahead")), strict=True):
                if held and (ahead or size > 2_000_000):
                    rows = [(*a, b[1]) for a, b in zip(held, [*held[1:], (doc, text)], strict=True)]
                    yield finish(rows, lexicon)
                    held, size = [], 0
                if not ahead:
                    held.append((doc, text))
                    size += len(text)

    dealt, parts = with_next(docs)
    # by ranges of the part's number, so that each task gets one part
    ordered = dealt.repartitionByRange(parts, "_part").sortWithinPartitions("_part", "_ahead", "_key", "_tie", "_row")
    return ordered.select("doc_id", "text", "_ahead").mapInArrow(trimmed(run), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, len(coalesce(text, '')) AS n FROM documents),
e AS (SELECT *, left(t, n - n // 4) || left(coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)), n // 4) AS x,
        coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS after FROM d),
a AS (SELECT doc_id, 0 AS side, t FROM e UNION ALL SELECT doc_id, 1, x FROM e),
w AS (SELECT doc_id, side, unnest(list_distinct(regexp_extract_all(lower(t), '[0-9A-Za-z_\x{{80}}-\x{{10FFFF}}]+'))) AS w FROM a),
m AS (SELECT doc_id, side, CASE WHEN strlen(w) > 64 THEN '#' || md5(w) ELSE w END AS w FROM w),
l AS (SELECT w FROM m WHERE side = 0 GROUP BY w HAVING count(*) >= greatest(2, 0.0005 * (SELECT count(*) FROM d)) AND count(*) <= 0.2 * (SELECT count(*) FROM d)),
b AS (SELECT m.*, l.w IS NOT NULL AS inside FROM m LEFT JOIN l USING (w)),
u AS (SELECT doc_id, side, w FROM (SELECT *, bool_or(inside) OVER (PARTITION BY doc_id, side) AS banded FROM b) WHERE inside OR NOT banded
      UNION ALL SELECT doc_id, side, CASE WHEN strlen(t) > 64 THEN '#' || md5(t) ELSE t END FROM a WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.doc_id = a.doc_id AND w.side = a.side)),
h AS (SELECT w, CAST(('0x' || substr(md5(w), 1, 15)) AS BIGINT) AS k, md5('subsets:' || w) AS z FROM (SELECT DISTINCT w FROM u)),
v AS (SELECT w, k, r, CASE WHEN x = 0 THEN 15 ELSE 15 - CAST(floor(log2(x)) AS BIGINT) END AS top
      FROM (SELECT w, k, r, CAST(('0x' || substr(z, 1 + 4 * r, 4)) AS BIGINT) AS x FROM h, range({REPLICAS}) t(r))),
s AS (SELECT doc_id, side, CASE WHEN g = 0 THEN 0 ELSE r * {LEVELS - 1} + g END AS s, k,
             row_number() OVER (PARTITION BY doc_id, side, r, g ORDER BY k) - 1 AS i
      FROM u JOIN v USING (w), range({LEVELS}) q(g) WHERE g <= top AND (g > 0 OR r = 0)),
p AS (SELECT doc_id, side, s, CAST(sum(CAST(k AS HUGEINT) * (2 * i + 1)) % 18446744073709551616 AS HUGEINT) AS y FROM s GROUP BY ALL),
f AS (SELECT doc_id, side, s, CAST((y // 16777216) % 65535 + 1 AS BIGINT) AS y FROM p),
c AS (SELECT a.doc_id, a.side, q.s, coalesce(f.y, 0) AS y FROM a CROSS JOIN range({SUBSETS}) q(s) LEFT JOIN f ON f.doc_id = a.doc_id AND f.side = a.side AND f.s = q.s),
t AS (SELECT doc_id, side, string_agg(printf('%04x', y), '' ORDER BY s) AS f FROM c GROUP BY ALL),
k AS (SELECT e.doc_id,
        coalesce(sum(q) FILTER (WHERE o.y = n.y AND o.y > 0), 0) / greatest(1, coalesce(sum(q) FILTER (WHERE o.y > 0 OR n.y > 0), 0)) AS near_edited,
        coalesce(sum(q) FILTER (WHERE o.y = z.y AND o.y > 0), 0) / greatest(1, coalesce(sum(q) FILTER (WHERE o.y > 0 OR z.y > 0), 0)) AS near_next
      FROM (SELECT s, CASE WHEN s = 0 THEN 1 ELSE 1 << CAST(1 + (s - 1) % {LEVELS - 1} AS INTEGER) END AS q FROM range({SUBSETS}) t(s)) q JOIN e ON true JOIN c o ON o.doc_id = e.doc_id AND o.side = 0 AND o.s = q.s JOIN c n ON n.doc_id = e.doc_id AND n.side = 1 AND n.s = o.s
      JOIN c z ON z.doc_id = e.after AND z.side = 0 AND z.s = o.s GROUP BY e.doc_id)
SELECT e.doc_id, n AS n_chars, sha256(x) AS edited_sha256, o.f AS fingerprint, w.f AS edited_fingerprint, near_edited, near_next
FROM e JOIN t o ON o.doc_id = e.doc_id AND o.side = 0 JOIN t w ON w.doc_id = e.doc_id AND w.side = 1 JOIN k ON k.doc_id = e.doc_id
"""
