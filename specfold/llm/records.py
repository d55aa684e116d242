"""Token ids as length-delimited binary records in checksummed files, with a separate offset index.

A file holds frames and one closing line-end byte. A frame is: length (unsigned 64-bit), masked
CRC-32 of those 8 bytes, payload, masked CRC-32 of the payload; numbers are little-endian. The
first frame describes the file: magic, bytes an id (2 or 4), part, file in the part, record and
token number in the part of its first record. Each further frame is one document: whether it has
a doc_id, the doc_id, the ids. Files of about file_bytes hold documents in ascending doc_id order
(null first; rows of equal doc_id by their text's hash), parts follow one another in that order.

Spark's text writer puts the files: it takes bytes as they are, commits tasks as a whole and
reaches every file system that Spark does; executors keep nothing locally. The index, one row a
record with its file and byte offset, is built from the files themselves.

Null or empty text: the end id alone. Repeated rows are written each. An empty table gives an
empty folder and no rows. Further columns of the input are not read. A frame whose checksum is
wrong fails the read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specfold.llm.common import session_of, trimmed
from specfold.llm.encode import ENCODE_BYTES, chunks, encoder

MAGIC = b"SFREC1"
_HEAD, _LEN, _CRC = "<6sBIIQQ", "<QI", "<I"
INDEX = "path string, doc_id long, part int, file int, record long, at long, bytes long, start_in_part long, n_tokens long"
_INDEX = pa.schema([("path", pa.string()), ("doc_id", pa.int64()), ("part", pa.int32()), ("file", pa.int32()), ("record", pa.int64()), ("at", pa.int64()), ("bytes", pa.int64()), ("start_in_part", pa.int64()), ("n_tokens", pa.int64())])


def masked(data: bytes | memoryview) -> int:
    """CRC-32, rotated and shifted by a constant, so that data which holds its own checksums stays well mixed."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = len(payload).to_bytes(8, "little")
    return b"".join((size, struct.pack(_CRC, masked(size)), payload, struct.pack(_CRC, masked(payload))))


def frames(data: memoryview) -> Iterator[tuple[int, memoryview]]:
    """(offset, payload) of each frame of a file."""
    at, end = 0, len(data) - 1
    if end < 0 or data[end] != 0x0A:
        raise ValueError("a record file is cut short")
    while at < end:
        if at + 16 > end:
            raise ValueError(f"a frame is cut short at byte {at}")
        size, check = struct.unpack_from(_LEN, data, at)
        if masked(data[at : at + 8]) != check:
            raise ValueError(f"wrong checksum of a length at byte {at}")
        if at + 16 + size > end:
            raise ValueError(f"a frame is cut short at byte {at}")
        payload = data[at + 12 : at + 12 + size]
        if masked(payload) != struct.unpack_from(_CRC, data, at + 12 + size)[0]:
            raise ValueError(f"wrong checksum of a record at byte {at}")
        yield at, payload
        at += 16 + size


def frame_at(data: memoryview, at: int, size: int) -> memoryview:
    """The payload of the frame of `size` bytes at an offset."""
    n, check = struct.unpack_from(_LEN, data, at)
    payload = data[at + 12 : at + 12 + n]
    if n + 16 != size or masked(data[at : at + 8]) != check or masked(payload) != struct.unpack_from(_CRC, data, at + 12 + n)[0]:
        raise ValueError(f"no sound record of {size} bytes at byte {at}")
    return payload


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, file_bytes: int = 4 << 20) -> None:
    """docs: doc_id, text. Writes files below folder/data and the index below folder/index."""
    spark = session_of(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        width = 2 if coder.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        kind = np.dtype(f"<u{width}")
        part, file, record, token = TaskContext.get().partitionId(), 0, 0, 0
        held: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal file, size
            data = b"".join(held)
            held.clear()
            file, size = file + 1, 0
            # bytes, not text: the writer puts them as they are
            return pa.RecordBatch.from_arrays([pa.StringArray.from_buffers(1, pa.py_buffer(np.array([0, len(data)], np.int32)), pa.py_buffer(data))], ["value"])

        for batch in batches:
            for some in chunks(batch, "text", ENCODE_BYTES):
                ids, ends = coder.encode(some.column("text"))
                flat, begin = ids.astype(kind), 0
                for doc, end in zip(some.column("doc_id").to_pylist(), ends.tolist(), strict=True):
                    if not held:
                        held.append(frame(struct.pack(_HEAD, MAGIC, width, part, file, record, token)))
                    held.append(frame(struct.pack("<Bq", doc is not None, doc or 0) + np.append(flat[begin:end], kind.type(end_id)).tobytes()))
                    size += len(held[-1])
                    record, token, begin = record + 1, token + end - begin + 1, end
                    if size >= file_bytes:
                        yield close()
        if held:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("_tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")
    ordered.mapInArrow(trimmed(run), "value string").write.mode("overwrite").option("maxRecordsPerFile", 1).text(f"{folder}/data")
    _scan(spark, folder, False).write.mode("overwrite").parquet(f"{folder}/index")


def _scan(spark: SparkSession, folder: str, with_ids: bool) -> DataFrame:
    kind = _INDEX.append(pa.field("tokens", pa.binary())) if with_ids else _INDEX

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = memoryview(batch.column("content")[i].as_buffer())
                path = batch.column("path")[i].as_py()
                all_ = frames(data)
                magic, width, part, file, record, token = struct.unpack(_HEAD, next(all_)[1])
                if magic != MAGIC:
                    raise ValueError("not a record file")
                rows = []
                for at, payload in all_:
                    known, doc = struct.unpack_from("<Bq", payload)
                    n = (len(payload) - 9) // width
                    rows.append((path, doc if known else None, part, file, record, at, len(payload) + 16, token, n, *([np.frombuffer(payload[9:], f"<u{width}").astype("<u4").tobytes()] if with_ids else [])))
                    record, token = record + 1, token + n
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)

    return _files(spark, folder).select(_base(F.col("path")).alias("path"), "content").mapInArrow(trimmed(run), INDEX + (", tokens binary" if with_ids else ""))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/data")


def _base(path: Column) -> Column:
    """A file's name without its folder."""
    return F.substring_index(path, "/", -1)


def index(spark: SparkSession, folder: str) -> DataFrame:
    """One row a record: path (its file's name), doc_id, part, file, record and start_in_part (its number and its first token's, in the part), at and bytes (of its frame in the file), n_tokens, start (tokens of all records before it)."""
    own = spark.read.schema(INDEX).parquet(f"{folder}/index")
    return own.join(F.broadcast(_bases(own)), "part").withColumn("start", F.col("_base") + F.col("start_in_part")).drop("_base")


def _bases(own: DataFrame) -> DataFrame:
    """Tokens before each part: as many rows as the writing job had tasks."""
    sums = own.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    return sums.select("part", (F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_base"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All records with their ids (tokens: little-endian unsigned 32-bit) and index columns; every checksum is verified."""
    bases = _bases(spark.read.schema(INDEX).parquet(f"{folder}/index"))
    return _scan(spark, folder, True).join(F.broadcast(bases), "part").withColumn("start", F.col("_base") + F.col("start_in_part")).drop("_base")


def read_at(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """The records that `wanted`, rows of the index, points at: its columns, and tokens (little-endian unsigned 32-bit).

    Of each file with such records the wanted frames alone are cut out, by their offsets, and verified; the
    other frames are not looked at. The offsets of a file, as many as it has records, meet its bytes in one row.
    """
    rest = [c for c in wanted.columns if c not in ("path", "at", "bytes")]
    listed = wanted.groupBy("path").agg(F.collect_list(F.struct("at", "bytes", *rest)).alias("wanted"))
    files = _files(spark, folder).select(_base(F.col("path")).alias("path"), "content")
    kinds = [wanted.schema[c] for c in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = memoryview(batch.column("content")[i].as_buffer())
                magic, width = struct.unpack(_HEAD, next(frames(data))[1])[:2]
                if magic != MAGIC:
                    raise ValueError("not a record file")
                own = batch.column("wanted")[i].values
                tokens = [np.frombuffer(frame_at(data, at, n)[9:], f"<u{width}").astype("<u4").tobytes() for at, n in zip(own.field("at").to_pylist(), own.field("bytes").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(own.field(c) for c in rest), pa.array(tokens, pa.binary())], [*rest, "tokens"])

    return listed.join(files, "path").select("content", "wanted").mapInArrow(trimmed(run), T.StructType([*kinds, T.StructField("tokens", T.BinaryType())]))


def read_shuffled(spark: SparkSession, folder: str, seed: int, share: float = 1.0) -> DataFrame:
    """Records in an order that seed decides, or the first share of that order, read by the index: (key, doc_id, tokens)."""
    order = index(spark, folder).select("path", "at", "bytes", "doc_id", F.xxhash64(F.lit(seed), "part", "record").alias("key"))
    if share < 1:
        order = order.where(F.col("key") < int(-(1 << 63) + share * (1 << 64)))
    return read_at(spark, folder, order).select("key", "doc_id", "tokens").orderBy("key")
