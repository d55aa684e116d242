"""Cost-balanced packing of tokenized documents into fixed-length training sequences.

The cost of a piece of L tokens is linear * L + quadratic * L * L (projections and attention
inside the piece). Within a packing group, whole sequences are cut off long documents; the
rests, in descending length, go to the sequence with the lowest cost that has room left, and are
cut where that room ends. A group's sequences hold exactly its tokens: all are full but for a
tail that is dealt to sequences whose lengths are powers of two, so nothing is padded.

A group is a run of documents of one input partition with about group_tokens tokens in rests.
Packing is a single pass over the table without a shuffle: memory is bounded by a group, a lost
task repeats alone, and no key can be hot. A document longer than a sequence leaves whole sequences at once and
only its rest is held. Splitting of files decides the groups, so results
repeat for the same files and spark.sql.files settings.

Null or empty text: the document is its end id alone. Repeated rows are packed each. A null
doc_id stays null. An empty table gives no rows. Further columns of the input are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specfold.llm.common import trimmed
from specfold.llm.encode import ENCODE_BYTES, chunks, encoder

SCHEMA = "doc_id long, start long, length long, tokens binary, doc_tokens long, sequence_id long, offset long, cost double"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("tokens", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("cost", pa.float64())])


def assign(rests: list[tuple[int, int, int]], seq_len: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """rests: (document, start, tokens). Returns pieces (document, start, tokens, sequence, offset), sequences counted from 0."""
    rests = sorted(rests, key=lambda r: (-r[2], r[0]))
    total = sum(r[2] for r in rests)
    whole, tail = divmod(total, seq_len)
    out = []
    open_ = [(0.0, s, 0) for s in range(whole)]  # cost, sequence, tokens used
    left = total - tail
    at = 0
    while at < len(rests) and left:
        doc, start, n = rests[at]
        at += 1
        while n and left:
            cost, seq, used = heapq.heappop(open_)
            take = min(n, seq_len - used)
            out.append((doc, start, take, seq, used))
            start, n, left, used = start + take, n - take, left - take, used + take
            if used < seq_len:
                heapq.heappush(open_, (cost + linear * take + quadratic * take * take, seq, used))
        if n:
            rests[at - 1 : at] = [(doc, start, n)]
            at -= 1
    sizes = [1 << b for b in range(tail.bit_length())[::-1] if tail >> b & 1]
    seq, used = whole, 0
    for doc, start, n in rests[at:]:
        while n:
            size = sizes[seq - whole]
            take = min(n, size - used)
            out.append((doc, start, take, seq, used))
            start, n, used = start + take, n - take, used + take
            if used == size:
                seq, used = seq + 1, 0
    return out


def pack(docs: DataFrame, tokenizer: str, seq_len: int = 1024, end_id: int = 0, linear: float = 1.0, quadratic: float = 1.0 / 4096, group_tokens: int = 1 << 20) -> DataFrame:
    """Every token of every document in one piece of one sequence of at most seq_len tokens.

    docs: doc_id, text. Rows: the piece's document, its first token's place in it, its tokens
    (little-endian unsigned 32-bit), the document's tokens, the sequence, the place there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        sequence = TaskContext.get().partitionId() << 36
        held: list[tuple] = []  # rests of the group's documents: doc_id, ids, place of their first, ids of the document
        pending = 0
        rows: list[tuple] = []

        def emit() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)
            rows.clear()
            return out

        def add(doc, ids, first, total, start, n, seq, offset):
            rows.append((doc, start, n, ids[start - first : start - first + n].tobytes(), total, seq, offset, linear * n + quadratic * n * n))

        def close() -> None:
            nonlocal sequence, pending
            most = -1
            for i, start, n, seq, offset in assign([(i, first, len(ids)) for i, (_, ids, first, _) in enumerate(held)], seq_len, linear, quadratic):
                add(*held[i], start, n, sequence + seq, offset)
                most = max(most, seq)
            sequence += most + 1
            held.clear()
            pending = 0

        for batch in batches:
            for part in chunks(batch, "text", ENCODE_BYTES):
                ids, ends = coder.encode(part.column("text"))
                flat, begin = ids.astype("<u4"), 0
                for doc, end in zip(part.column("doc_id").to_pylist(), ends.tolist(), strict=True):
                    own = np.append(flat[begin:end], np.uint32(end_id))
                    begin = end
                    whole = len(own) // seq_len * seq_len
                    for start in range(0, whole, seq_len):
                        add(doc, own, 0, len(own), start, seq_len, sequence, 0)
                        sequence += 1
                        if len(rows) >= 4096:
                            yield emit()
                    if len(own) > whole:  # fewer ids than a sequence has, copied so that the rest of the document is let go
                        held.append((doc, own[whole:].copy(), whole, len(own)))
                        pending += len(own) - whole
                    if pending >= group_tokens:
                        close()
                    if len(rows) >= 4096:
                        yield emit()
        close()
        if rows:
            yield emit()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(trimmed(run), SCHEMA)
