"""Secret scan through a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: strings that every
match must hold, split into overlapping triples of lower-case bytes. Texts are indexed in segments
of some megabytes inside the task that reads them: trigram -> ascending list of the segment's
documents, kept for the trigrams that any rule asks for. A rule's postings are intersected and
united as its query says, and its expression runs over the candidates only; a rule without
mandatory trigrams scans every text. No shuffle, memory bounded by a segment, whole texts.

Null or empty text: no spans. Repeated rows are scanned each, a null doc_id stays null, an empty
table gives no rows, further columns are not read. Offsets are code points, ends exclusive; spans
stand by start, then by the rule's place in the list. Matches of one rule are leftmost and do not
overlap; those of different rules may.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as sre, _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specfold.llm.common import trimmed
from specfold.llm.encode import chunks


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Of the matches those stay whose group has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
)

#: Sets of strings larger than this are not extended further.
MOST_STRINGS = 64

#: A query is None (every text), a trigram, ("and", queries) or ("or", queries).
Query = None | bytes | tuple


def _both(kind: str, queries: list[Query]) -> Query:
    if kind == "and":
        queries = [q for q in queries if q is not None]
    elif any(q is None for q in queries):
        return None
    queries = list(dict.fromkeys(queries))
    return None if not queries else queries[0] if len(queries) == 1 else (kind, tuple(queries))


def _of_string(s: str) -> Query:
    raw = "".join(c.lower() if c.isascii() else c for c in s).encode()
    return _both("and", [raw[i : i + 3] for i in range(len(raw) - 2)])


def _walk(items, any_case: bool) -> tuple[set[str] | None, Query]:
    """All strings that the items match, if those are few, else None; and a query that any match fulfils."""
    strings, exact, queries = {""}, True, []

    def flush() -> None:
        nonlocal strings, exact
        queries.append(_both("or", [_of_string(s) for s in sorted(strings)]))
        strings, exact = {""}, False

    def append(more: set[str]) -> None:
        nonlocal strings
        if len(strings) * len(more) > MOST_STRINGS:
            flush()
        strings = {a + b for a in strings for b in more} if len(more) <= MOST_STRINGS else strings

    for op, arg in items:
        if op is sre.LITERAL:
            append({chr(arg).lower()} if chr(arg).isascii() else {chr(arg)})
        elif op is sre.IN:
            found: set[str] | None = set()
            for kind, value in arg:
                if kind is sre.LITERAL and chr(value).isascii():
                    found.add(chr(value).lower())
                elif kind is sre.RANGE and value[1] < 128 and value[1] - value[0] < 8:
                    found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
                else:
                    found = None
                    break
            if found and len(found) <= 8:
                append(found)
            else:
                flush()
        elif op is sre.SUBPATTERN:
            own, query = _walk(arg[3], any_case)
            if own is not None:
                append(own)
            else:
                flush()
                queries.append(query)
        elif op is sre.BRANCH:
            each = [_walk(x, any_case) for x in arg[1]]
            if all(own is not None for own, _ in each) and sum(len(own) for own, _ in each) <= MOST_STRINGS:
                append(set().union(*(own for own, _ in each)))
            else:
                flush()
                queries.append(_both("or", [q for _, q in each]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = arg
            own, query = _walk(inner, any_case)
            if own is not None and (low, high) == (0, 1):
                append(own | {""})
            elif low == 0:
                flush()
            elif own is not None and low == high == 1:
                append(own)
            elif own is not None:
                append(own)
                flush()
            else:
                flush()
                queries.append(query)
        elif op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            continue
        else:
            flush()
    query = _both("and", [*queries, _both("or", [_of_string(s) for s in sorted(strings)])])
    return (strings if exact else None), query


def query_of(rule: Rule) -> Query:
    """The Boolean trigram query that every text with a match fulfils; None: no trigram is mandatory."""
    return _walk(_parser.parse(rule.pattern), rule.any_case)[1]


def _trigrams(query: Query) -> set[bytes]:
    return set() if query is None else {query} if isinstance(query, bytes) else set().union(*map(_trigrams, query[1]))


_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


class Index:
    """Postings of a segment for given trigrams."""

    def __init__(self, trigrams: list[bytes]):
        self.number = {t: i + 1 for i, t in enumerate(trigrams)}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, i in self.number.items():
            self.table[int.from_bytes(t, "big")] = i

    def fill(self, raw: np.ndarray, bounds: np.ndarray) -> None:
        """raw: the segment's bytes; bounds: where each document begins, and the end."""
        self.documents = len(bounds) - 1
        self.postings = dict.fromkeys(self.number, np.zeros(0, np.int64))
        if len(raw) < 3:
            return
        low = _LOWER[raw]
        found = self.table[(low[:-2] << 16) | (low[1:-1] << 8) | low[2:]]
        at = np.flatnonzero(found)
        doc = np.searchsorted(bounds, at, "right") - 1
        inside = at + 3 <= bounds[doc + 1]
        pairs = np.unique(found[at[inside]].astype(np.int64) << 40 | doc[inside])
        for t, i in self.number.items():
            a, b = np.searchsorted(pairs, [i << 40, (i + 1) << 40])
            self.postings[t] = pairs[a:b] & ((1 << 40) - 1)

    def candidates(self, query: Query) -> np.ndarray:
        if query is None:
            return np.arange(self.documents)
        if isinstance(query, bytes):
            return self.postings[query]
        kind, parts = query
        lists = sorted((self.candidates(p) for p in parts), key=len)
        out = lists[0]
        for x in lists[1:]:
            out = np.intersect1d(out, x, assume_unique=True) if kind == "and" else np.union1d(out, x)
        return out


def spans_of(rule: Rule, pattern: re.Pattern, text: str) -> list[tuple[int, int]]:
    return [m.span() for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """docs: doc_id, text. Rows: doc_id, spans (array of kind, start, end)."""
    kind = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [query_of(r) for r in rules]
        patterns = [r.compiled() for r in rules]
        index = Index(sorted(set().union(*map(_trigrams, queries))))
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = part.column("text").cast(pa.large_string())
                bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
                index.fill(np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0])
                found: list[list] = [[] for _ in range(len(texts))]
                whole = texts.to_pylist()
                for n, (rule, pattern, query) in enumerate(zip(rules, patterns, queries, strict=True)):
                    for i in index.candidates(query).tolist():
                        for start, end in spans_of(rule, pattern, whole[i]):
                            found[i].append((start, n, end))
                rows = [[{"kind": rules[n].kind, "start": start, "end": end} for start, n, end in sorted(x)] for x in found]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, kind.field("spans").type)], schema=kind)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(trimmed(run), "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def _found(rule: Rule, place: int) -> str:
    """SQL of one rule's matches: a row each, with its place among the rules and its span. Pieces between matches give the starts."""
    pattern = (("(?i)" if rule.any_case else "") + rule.pattern).replace("'", "''")
    part = f"regexp_extract(x, '{pattern}', {rule.group})"
    run = "OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, b - len(x) AS a, b FROM (
      SELECT doc_id, x, CAST(sum(len(y) + len(x)) {run} AS BIGINT) AS b FROM (
        SELECT doc_id, unnest(m) AS x, unnest(s[1:len(m)]) AS y, unnest(range(len(m))) AS i
        FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_split_to_array(t, '{pattern}') AS s FROM d))) WHERE len({part}) >= {rule.least}"""


_SPANS = " UNION ALL ".join(_found(r, i) for i, r in enumerate(BASE + MORE))
_TEXT = "coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place){0}, '')"
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ({_SPANS})
SELECT d.doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
       sha256({_TEXT.format(f" FILTER (WHERE place < {len(BASE)})")}) AS base_sha256, {_TEXT.format("")} AS spans
FROM d LEFT JOIN f ON d.doc_id = f.doc_id GROUP BY d.doc_id
"""
