"""FITS binary tables as a Spark data source, and writers for tables and maps.

    fits.register(spark)
    spark.read.format("fits").option("path", "/data/*.fits").load()
    rows.write.format("fits").mode("overwrite").save("/data/out")

Paths are those of a file system that every executor mounts. Rows have a fixed length in a file, so a file is read
in ranges of rows by many tasks, and of each row only the columns that are asked for are read. Comparisons with single values are
tried before a row's other columns are read; tables that lack such a column are not opened. With the extremes that write_index keeps of each range of rows, neither are ranges
that cannot hold a match, nor any file in order to plan the read:

    fits.write_index(spark, "/data/*.fits", "/data/index")
    fits.load(spark, "/data/*.fits", "/data/index", mission_id="2016-02-11_GR_F277", scan=(100, 200))
Columns are named in lower case; row_id = file number * 2^40 + row, hdu and file are added.
"""

from __future__ import annotations

import glob
import json
import math
import os
import re
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage

from specfold.errors import FitsError

BLOCK = 2880
#: FITS letter of a column: NumPy type, Spark type, bytes.
KINDS = {"E": (">f4", T.FloatType(), 4), "D": (">f8", T.DoubleType(), 8), "J": (">i4", T.IntegerType(), 4), "I": (">i2", T.ShortType(), 2), "K": (">i8", T.LongType(), 8), "B": ("u1", T.ShortType(), 1), "A": ("S", T.StringType(), 1)}
ROWS = 4096
#: Bytes of a range of rows, the work of a task.
RANGE_BYTES = 64 << 20


@dataclass(frozen=True)
class Column:
    name: str
    letter: str
    repeat: int
    offset: int

    def spark_type(self) -> T.DataType:
        kind = KINDS[self.letter][1]
        return kind if self.letter == "A" or self.repeat == 1 else T.ArrayType(kind)


@dataclass(frozen=True)
class Table:
    """Where a table's rows are in its file, and the header's values."""

    path: str
    hdu: int
    start: int
    row_bytes: int
    n_rows: int
    columns: tuple[Column, ...]
    header: tuple[tuple[str, object], ...]


def _value(text: str) -> object:
    text = text.strip()
    if text.startswith("'"):
        return re.sub("''", "'", text[1 : text.rindex("'")]).rstrip()
    text = text.split("/")[0].strip()
    if text in ("T", "F"):
        return text == "T"
    try:
        return int(text)
    except ValueError:
        try:
            return float(text.replace("D", "E"))
        except ValueError:
            return text


def read_header(f) -> dict[str, object] | None:
    """The next header of an open file, None at its end."""
    out: dict[str, object] = {}
    while True:
        block = f.read(BLOCK)
        if not block and not out:
            return None
        if len(block) < BLOCK:
            raise FitsError("a header is cut short")
        for i in range(0, BLOCK, 80):
            card = block[i : i + 80].decode("ascii", "replace")
            name = card[:8].strip()
            if name == "END":
                return out
            if card[8:10] == "= ":
                out[name] = _value(card[10:])


def tables_of(path: str) -> list[Table]:
    """All binary tables of a file, from its headers alone."""
    out, hdu = [], 0
    if not os.path.exists(path):
        raise FitsError(f"no such file: {path}")
    with open(path, "rb") as f:
        while (h := read_header(f)) is not None:
            size = abs(int(h.get("BITPIX", 8))) // 8
            for i in range(1, int(h.get("NAXIS", 0)) + 1):
                size *= int(h[f"NAXIS{i}"])
            size = (size if int(h.get("NAXIS", 0)) else 0) + int(h.get("PCOUNT", 0) or 0)
            start = f.tell()
            if h.get("XTENSION") == "BINTABLE":
                columns, offset = [], 0
                for i in range(1, int(h["TFIELDS"]) + 1):
                    m = re.fullmatch(r"(\d*)([A-Z])(\([0-9,]*\))?.*", str(h[f"TFORM{i}"]))
                    if not m or m[2] not in KINDS:
                        raise FitsError(f"column format {h[f'TFORM{i}']} is not supported")
                    repeat = int(m[1] or 1)
                    columns.append(Column(str(h[f"TTYPE{i}"]).lower(), m[2], repeat, offset))
                    offset += repeat * KINDS[m[2]][2]
                out.append(Table(path, hdu, start, int(h["NAXIS1"]), int(h["NAXIS2"]), tuple(columns), tuple(h.items())))
            f.seek(start + -(-size // BLOCK) * BLOCK)
            hdu += 1
    return out


def paths_of(option: str) -> list[str]:
    out = []
    for part in option.split(","):
        part = part.strip()
        part = os.path.join(part, "*.fits") if os.path.isdir(part) else part
        out += sorted(glob.glob(part)) if glob.has_magic(part) else [part]
    return out


def read_manifest(spark: SparkSession, path: str) -> list[str]:
    """Paths of a list with one a line; # begins a comment."""
    rows = spark.read.text(path).toLocalIterator()
    return [line for r in rows if (line := r["value"].split("#")[0].strip())]


@dataclass
class Range(InputPartition):
    table: Table
    number: int
    first: int
    last: int


@dataclass(frozen=True)
class Test:
    """A comparison of a column with values: of "=", "<", "<=", ">" and ">=" with one, "in" with any, "set" with none."""

    column: str
    how: str
    values: tuple = ()

    def may_hold(self, low: float | str, high: float | str) -> bool:
        """Whether a value from low to high can pass."""
        if self.how == "set":
            return True
        if self.how in ("=", "in"):
            return any(low <= v <= high for v in self.values)
        (v,) = self.values
        return {"<": low < v, "<=": low <= v, ">": high > v, ">=": high >= v}[self.how]

    def passing(self, x: np.ndarray) -> np.ndarray:
        """Rows that may pass. NaN is above all numbers and equal to itself, so its rows are left to Spark."""
        if self.how == "set":
            return np.ones(len(x), bool)
        if self.how in ("=", "in"):
            ok = np.isin(x, np.array(self.values))
        else:
            (v,) = self.values
            ok = {"<": np.less, "<=": np.less_equal, ">": np.greater, ">=": np.greater_equal}[self.how](x, v)
        return ok | np.isnan(x) if x.dtype.kind == "f" else ok


_HOW = {EqualTo: "=", EqualNullSafe: "=", LessThan: "<", LessThanOrEqual: "<=", GreaterThan: ">", GreaterThanOrEqual: ">="}


def test_of(f: Filter, kinds: dict[str, T.DataType]) -> Test | None:
    """A filter that ranges and rows can be tried by, or None."""
    name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    kind = kinds.get(name)
    if kind is None or isinstance(kind, T.ArrayType):
        return None
    if isinstance(f, IsNotNull):
        return Test(name, "set")
    values = tuple(f.value) if isinstance(f, In) else (f.value,) if type(f) in _HOW else ()
    want = (str,) if isinstance(kind, T.StringType) else (int, float)
    # whole numbers beyond 2^53 and NaN are not compared here
    if not values or not all(isinstance(v, want) and not isinstance(v, bool) and (want == (str,) or abs(v) <= 2**53) for v in values):
        return None
    return Test(name, "in" if isinstance(f, In) else _HOW[type(f)], values)


class FitsReader(DataSourceReader):
    """known: by table (path, hdu) its ranges with the extremes of their columns, where an index holds them."""

    def __init__(self, tables: list[Table], schema: T.StructType, known: dict[tuple[str, int], list[tuple[int, int, dict]]] | None = None):
        self.tables, self.schema, self.known = tables, schema, known or {}
        self.tests: list[Test] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """All filters are left to Spark as well, so what is tried here need not be exact, only never too strict."""
        kinds = {c.name: c.spark_type() for t in self.tables for c in t.columns}
        for c in (c for t in self.tables for c in t.columns if c.repeat != 1 and c.letter != "A"):
            kinds.pop(c.name, None)  # an array in one table
        self.tests = [t for f in filters if (t := test_of(f, kinds)) is not None]
        return filters

    def partitions(self) -> Sequence[Range]:
        out = []
        for n, t in enumerate(self.tables):
            own = {c.name for c in t.columns}
            if any(test.column not in own for test in self.tests):
                continue  # null in every row
            for first, last, extremes in self.known.get((t.path, t.hdu)) or [(a, b, {}) for a, b in ranges_of(t)]:
                if all(test.may_hold(*extremes[test.column]) for test in self.tests if test.column in extremes):
                    out.append(Range(t, n, first, last))
        return out or [Range(self.tables[0], 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        t = partition.table
        own = {c.name: c for c in t.columns}
        for first in range(partition.first, partition.last, ROWS):
            block = mapped(t, first, min(ROWS, partition.last - first))
            rows = np.arange(len(block))
            for test in self.tests:
                rows = rows[test.passing(values_of(block, own[test.column], rows))]
            if not len(rows):
                continue
            n, columns = len(rows), []
            for f in self.schema.fields:
                if f.name == "row_id":
                    columns.append(pa.array((partition.number << 40) + first + rows, pa.int64()))
                elif f.name == "hdu":
                    columns.append(pa.array([t.hdu] * n, pa.int32()))
                elif f.name == "file":
                    columns.append(pa.array([t.path] * n, pa.string()))
                elif f.name not in own:
                    columns.append(pa.nulls(n, _arrow(f.dataType)))
                else:
                    columns.append(_decoded(block, own[f.name], rows, isinstance(f.dataType, T.ArrayType)))
            yield pa.RecordBatch.from_arrays(columns, [x.name for x in self.schema.fields])


def ranges_of(t: Table) -> list[tuple[int, int]]:
    step = max(1, RANGE_BYTES // max(1, t.row_bytes))
    return [(a, min(t.n_rows, a + step)) for a in range(0, t.n_rows, step)]


def mapped(t: Table, first: int, n: int) -> np.ndarray:
    """The bytes of n rows, of which only those that are looked at are read from the file."""
    start = t.start + first * t.row_bytes
    if os.path.getsize(t.path) < start + n * t.row_bytes:
        raise FitsError(f"{t.path} is cut short")
    if not n * t.row_bytes:
        return np.zeros((n, t.row_bytes), np.uint8)
    return np.memmap(t.path, np.uint8, "r", start, (n, t.row_bytes))


def values_of(block: np.ndarray, c: Column, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
    """A column of one value a row: texts as they are read, or numbers."""
    kind, _, size = KINDS[c.letter]
    if c.letter == "A":
        return np.array(_decoded(block, c, rows).to_pylist(), dtype=str)
    values = np.ascontiguousarray(block[:, c.offset : c.offset + size][rows]).view(kind)[:, 0]
    return values.astype(values.dtype.newbyteorder("="))


def extremes_of(t: Table, first: int, last: int, columns: Sequence[str] | None = None) -> dict[str, list]:
    """Least and greatest value of each column of single values; with a NaN, which is above all numbers, the greatest is infinite."""
    out: dict[str, list] = {}
    for c in t.columns:
        if (c.repeat != 1 and c.letter != "A") or (columns is not None and c.name not in columns):
            continue
        low = high = None
        for a in range(first, last, ROWS):
            x = values_of(mapped(t, a, min(ROWS, last - a)), c)
            missing = bool(x.dtype.kind == "f" and np.isnan(x).any())
            x = x[~np.isnan(x)] if missing else x
            few = [] if not len(x) else [x.min(), x.max()] if x.dtype.kind != "U" else [min(x.tolist()), max(x.tolist())]
            few += [math.inf] if missing else []
            if few:
                low = min(few) if low is None else min(low, *few)
                high = max(few) if high is None else max(high, *few)
        if low is not None:
            out[c.name] = [v if isinstance(v, str) else float(v) for v in (low, high)]
    return out


INDEX = "file string, bytes long, changed long, hdu int, layout string, first long, last long, extremes string"


def write_index(spark: SparkSession, path: str, index: str, columns: Sequence[str] | None = None) -> None:
    """Keeps the layout of all tables of path and, for each range of rows, the extremes of its columns of single values (or of those named), as Parquet in a folder.

    Files are read by the executors, of their rows only these columns. A file that changed since is planned and read as if it were not in the index.
    """
    only = None if columns is None else [c.lower() for c in columns]

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("file").to_pylist():
                found = [(p, *_state(p), t.hdu, json.dumps(asdict(t)), a, b) for t in tables_of(p) for a, b in ranges_of(t) or [(0, 0)]]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["file", "bytes", "changed", "hdu", "layout", "first", "last"])

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [json.dumps(extremes_of(table_of(layout), a, b, only)) for layout, a, b in zip(*(batch.column(c).to_pylist() for c in ("layout", "first", "last")), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.string())], [*batch.schema.names, "extremes"])

    files = paths_of(path)
    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, min(len(files), 256)))
    found = listed.mapInArrow(tables, INDEX.rsplit(",", 1)[0])
    found.repartition(256, "file", "hdu", "first").mapInArrow(extremes, INDEX).coalesce(8).write.mode("overwrite").parquet(index)


def _state(path: str) -> tuple[int, int]:
    at = os.stat(path)
    return at.st_size, at.st_mtime_ns


def table_of(layout: str) -> Table:
    d = json.loads(layout)
    return Table(d["path"], d["hdu"], d["start"], d["row_bytes"], d["n_rows"], tuple(Column(**c) for c in d["columns"]), tuple((k, v) for k, v in d["header"]))


def read_index(index: str) -> dict[str, tuple[tuple[int, int], dict[int, Table], dict[int, list[tuple[int, int, dict]]]]]:
    """By file: its size and time, its tables, and their ranges."""
    out: dict = {}
    for r in pq.read_table(index).to_pylist():
        _, tables, ranges = out.setdefault(r["file"], ((r["bytes"], r["changed"]), {}, {}))
        if r["hdu"] not in tables:
            tables[r["hdu"]] = table_of(r["layout"])
        ranges.setdefault(r["hdu"], []).append((r["first"], r["last"], json.loads(r["extremes"])))
    for _, _, ranges in out.values():
        for own in ranges.values():
            own.sort(key=lambda x: x[0])
    return out


def load_list(spark: SparkSession, listed: str, index: str | None = None, must: str = "spectrum", **wanted: object) -> DataFrame:
    """The rows of all tables in the files that a list names, one a line, in its order; paths that are not absolute are beside the list. As load."""
    files = [os.path.join(os.path.dirname(listed), p) for p in read_manifest(spark, listed)]
    if not files:
        raise FitsError(f"{listed} names no file")
    return load(spark, ",".join(files), index, must, **wanted)


def load(spark: SparkSession, path: str, index: str | None = None, must: str = "spectrum", **wanted: object) -> DataFrame:
    """The rows of path with the wanted values: one, a list of them, or a pair (from, to), both included and either of them None for no limit."""
    reader = register(spark).read.format("fits").option("path", path).option("with", must)
    out = (reader.option("index", index) if index else reader).load()
    for name, value in wanted.items():
        if isinstance(value, tuple):
            low, high = value
            out = out.where(F.col(name) >= low) if low is not None else out
            out = out.where(F.col(name) <= high) if high is not None else out
        else:
            out = out.where(F.col(name).isin(value) if isinstance(value, list) else F.col(name) == value)
    return out


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _decoded(block: np.ndarray, c: Column, rows: np.ndarray | slice = slice(None), listed: bool = False) -> pa.Array:
    kind, spark, size = KINDS[c.letter]
    part = np.ascontiguousarray(block[:, c.offset : c.offset + c.repeat * size][rows])
    if c.letter == "A":
        return pa.array([bytes(r).split(b"\0")[0].decode("latin-1").strip() for r in part], pa.string())
    values = part.view(kind)
    values = values.astype(values.dtype.newbyteorder("=")) if c.letter != "B" else values.astype(np.int16)
    arrow = pa.from_numpy_dtype(values.dtype)
    if c.repeat == 1 and not listed:
        return pa.array(values[:, 0], arrow)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * c.repeat), pa.array(values.ravel(), arrow))


class FitsSource(DataSource):
    """Options: path (files, folders or patterns, comma-separated); with (a column that a table must have; default spectrum, empty: any); index (what write_index wrote)."""

    @classmethod
    def name(cls) -> str:
        return "fits"

    def _tables(self) -> list[Table]:
        must = self.options.get("with", "spectrum").lower()
        known = self._index()
        every = ((known[p][1][h] for h in sorted(known[p][1])) if p in known else tables_of(p) for p in paths_of(self.options["path"]))
        found = [t for own in every for t in own if not must or must in {c.name for c in t.columns}]
        if not found:
            raise FitsError(f"no table with a {must or 'column'} in {self.options['path']}")
        return found

    def _index(self) -> dict:
        """Of files that are as they were."""
        index = self.options.get("index")
        return {p: v for p, v in read_index(index).items() if os.path.exists(p) and _state(p) == v[0]} if index else {}

    def schema(self) -> T.StructType:
        fields: dict[str, T.StructField] = {}
        for t in self._tables():
            for c in t.columns:
                if c.name not in fields or c.repeat != 1:  # an array in one table is an array in all
                    fields[c.name] = T.StructField(c.name, c.spark_type())
        return T.StructType([*fields.values(), T.StructField("row_id", T.LongType()), T.StructField("hdu", T.IntegerType()), T.StructField("file", T.StringType())])

    def reader(self, schema: T.StructType) -> FitsReader:
        known = {(p, h): ranges for p, (_, _, own) in self._index().items() for h, ranges in own.items()}
        return FitsReader(self._tables(), schema, known)

    def writer(self, schema: T.StructType, overwrite: bool) -> FitsWriter:
        return FitsWriter(self.options["path"], schema, overwrite)


def register(spark: SparkSession) -> SparkSession:
    from specfold.shipping import ship

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FitsSource)
    return ship(spark)


def card(name: str, value: object) -> bytes:
    if isinstance(value, bool):
        text = f"{'T' if value else 'F':>20}"
    elif isinstance(value, (int, np.integer)):
        text = f"{int(value):>20}"
    elif isinstance(value, (float, np.floating)):
        text = f"{float(value)!r:>20}".upper()
    else:
        text = "'" + str(value).replace("'", "''").ljust(8) + "'"
    return f"{name:<8}= {text}"[:80].ljust(80).encode("ascii", "replace")


def header_bytes(values: dict[str, object]) -> bytes:
    raw = b"".join(card(k, v) for k, v in values.items()) + b"END".ljust(80)
    return raw + b" " * (-len(raw) % BLOCK)


def table_bytes(table: pa.Table, keywords: dict[str, object] | None = None) -> bytes:
    """A binary table HDU of an Arrow table with numbers, texts and arrays of one length."""
    forms, parts = {}, []
    for i, (name, column) in enumerate(zip(table.column_names, table.columns, strict=True), 1):
        kind = column.type
        if pa.types.is_list(kind) or pa.types.is_large_list(kind):
            rows = column.to_pylist()
            n = max((len(r) for r in rows if r is not None), default=0)
            if any(r is not None and len(r) != n for r in rows):
                raise FitsError(f"arrays of {name} differ in length")
            letter = "D" if pa.types.is_float64(kind.value_type) else "E" if pa.types.is_floating(kind.value_type) else "K"
            block = np.array([[np.nan if letter in "DE" and v is None else v for v in r] if r is not None else [np.nan if letter in "DE" else 0] * n for r in rows], KINDS[letter][0]).reshape(len(rows), n)
        elif pa.types.is_string(kind):
            texts = [(v or "").encode("latin-1", "replace") for v in column.to_pylist()]
            n, letter = max(1, max(map(len, texts), default=1)), "A"
            block = np.array([t.ljust(n) for t in texts], f"S{n}").reshape(len(texts), 1)
        else:
            letter = "D" if pa.types.is_float64(kind) else "E" if pa.types.is_floating(kind) else "J" if kind in (pa.int32(),) else "I" if kind in (pa.int16(), pa.int8(), pa.bool_()) else "K"
            n = 1
            block = np.array([(np.nan if letter in "DE" else 0) if v is None else v for v in column.to_pylist()], KINDS[letter][0]).reshape(-1, 1)
        forms |= {f"TTYPE{i}": name.upper(), f"TFORM{i}": f"{n}{letter}"}
        parts.append(np.ascontiguousarray(block).view(np.uint8).reshape(table.num_rows, -1) if table.num_rows else np.zeros((0, n * KINDS[letter][2]), np.uint8))
    body = np.concatenate(parts, 1) if parts else np.zeros((0, 0), np.uint8)
    head = {"XTENSION": "BINTABLE", "BITPIX": 8, "NAXIS": 2, "NAXIS1": body.shape[1], "NAXIS2": table.num_rows, "PCOUNT": 0, "GCOUNT": 1, "TFIELDS": len(parts)}
    raw = body.tobytes()
    return header_bytes(head | forms | (keywords or {})) + raw + b"\0" * (-len(raw) % BLOCK)


PRIMARY = {"SIMPLE": True, "BITPIX": 8, "NAXIS": 0, "EXTEND": True}


@dataclass
class Written(WriterCommitMessage):
    temporary: str
    final: str


class FitsWriter(DataSourceWriter):
    """One file a task, under a name of its own until the job commits."""

    def __init__(self, path: str, schema: T.StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite
        os.makedirs(path, exist_ok=True)

    def write(self, rows: Iterator) -> Written:
        from pyspark import TaskContext

        kinds = pa.schema([(f.name, _arrow(f.dataType)) for f in self.schema.fields])
        table = pa.Table.from_pylist([r.asDict(recursive=True) for r in rows], schema=kinds)
        temporary = os.path.join(self.path, f".{uuid.uuid4().hex}.tmp")
        with open(temporary, "wb") as f:
            f.write(header_bytes(PRIMARY))
            f.write(table_bytes(table))
        return Written(temporary, os.path.join(self.path, f"part-{TaskContext.get().partitionId():05}.fits"))

    def commit(self, messages: list[Written | None]) -> None:
        kept = {m.final for m in messages if m}
        if self.overwrite:
            for old in glob.glob(os.path.join(self.path, "*.fits")):
                if old not in kept:
                    os.remove(old)
        for m in messages:
            if m:
                os.replace(m.temporary, m.final)

    def abort(self, messages: list[Written | None]) -> None:
        for m in messages:
            if m and os.path.exists(m.temporary):
                os.remove(m.temporary)


def header_index(spark: SparkSession, path: str) -> DataFrame:
    """One row a header value of the tables in path: file, hdu, key, value. Only headers are read."""
    files = paths_of(path)
    if not files:
        return spark.createDataFrame([], "file string, hdu int, key string, value string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(t.path, t.hdu, k, str(v)) for p in batch.column("file").to_pylist() for t in tables_of(p) for k, v in t.header]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.int32(), pa.string(), pa.string()))], ["file", "hdu", "key", "value"])

    return spark.createDataFrame([(f,) for f in files], "file string").repartition(min(len(files), 256)).mapInArrow(run, "file string, hdu int, key string, value string")


def write_map(map_: DataFrame, frame, path: str, value: str = "value", keywords: dict[str, object] | None = None) -> None:
    """A map of frame.nx x frame.ny pixels as an image; the frame bounds what reaches the driver."""
    image = np.full((frame.ny, frame.nx), np.nan, ">f4")
    for batch in map_.select("y", "x", value).toArrow().to_batches():
        y, x, v = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        image[y, x] = v
    raw = image.tobytes()
    head = {"SIMPLE": True, "BITPIX": -32, "NAXIS": 2, "NAXIS1": frame.nx, "NAXIS2": frame.ny} | {k: v for k, v in frame.keywords().items() if not k.startswith("NAXIS")} | (keywords or {})
    with open(path, "wb") as f:
        f.write(header_bytes(head) + raw + b"\0" * (-len(raw) % BLOCK))


def write_cube(cube: DataFrame, frame, path: str, channels: int, velocity: float, deltav: float, keywords: dict[str, object] | None = None, block_bytes: int = 16 << 20) -> None:
    """A cube as an image of channels, with the velocity axis as a table behind it, then the pixels' coverage and weight as images if the cube has them.

    Executors turn spectra into planes: a task gets some channels of some rows of the image, at most about block_bytes of it, and writes them where they
    stand in the file, which repeated tasks do with the same bytes. Pixels that the cube lacks are NaN. The file takes its name when it is whole.
    Only coverage and weight, a number a pixel, reach the driver.
    """
    head = {"SIMPLE": True, "BITPIX": -32, "NAXIS": 3, "NAXIS1": frame.nx, "NAXIS2": frame.ny, "NAXIS3": channels} | {k: v for k, v in frame.keywords().items() if not k.startswith("NAXIS")} | {"CTYPE3": "VELO-LSR", "CRVAL3": velocity, "CDELT3": deltav, "CRPIX3": 1.0} | (keywords or {})
    start = header_bytes(head)
    size = 4 * channels * frame.ny * frame.nx
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(temporary, "wb") as f:
        f.write(start)
        f.truncate(len(start) + size + -size % BLOCK)
    try:
        if size:
            _write_planes(cube, temporary, len(start), channels, frame.ny, frame.nx, block_bytes)
        axis = pa.table({"channel": pa.array(np.arange(channels), pa.int32()), "velocity": pa.array(velocity + np.arange(channels) * deltav)})
        with open(temporary, "ab") as f:
            f.write(table_bytes(axis, {"EXTNAME": "SPECTRUM"}))
            for c in ("coverage", "weight"):
                if c not in cube.columns:
                    continue
                image = np.full((frame.ny, frame.nx), np.nan, ">f4")
                for batch in cube.select("y", "x", c).toArrow().to_batches():
                    y, x, v = (part.to_numpy(zero_copy_only=False) for part in batch.columns)
                    image[y, x] = v
                raw = image.tobytes()
                extra = {"XTENSION": "IMAGE", "BITPIX": -32, "NAXIS": 2, "NAXIS1": frame.nx, "NAXIS2": frame.ny, "PCOUNT": 0, "GCOUNT": 1, "EXTNAME": c.upper()}
                f.write(header_bytes(extra | {k: v for k, v in frame.keywords().items() if not k.startswith("NAXIS")}) + raw + b"\0" * (-len(raw) % BLOCK))
        os.replace(temporary, path)
    finally:
        if os.path.exists(temporary):
            os.remove(temporary)


def _write_planes(cube: DataFrame, path: str, start: int, channels: int, ny: int, nx: int, block_bytes: int) -> None:
    """The image of channels x ny x nx numbers that begins at that byte of a file of its whole length."""
    deep = max(1, min(channels, 64, block_bytes // (4 * nx)))  # channels and rows of a block
    high = max(1, min(ny, block_bytes // (4 * nx * deep)))
    n_deep, n_high = -(-channels // deep), -(-ny // high)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spectra = batch.column("s").cast(pa.large_list(pa.float64()))
            y, x = batch.column("y").to_numpy(zero_copy_only=False), batch.column("x").to_numpy(zero_copy_only=False)
            if spectra.null_count or (np.diff(spectra.offsets.to_numpy()) != channels).any():
                raise FitsError(f"the cube has spectra that do not have {channels} channels")
            if len(y) and (min(y.min(), x.min()) < 0 or y.max() >= ny or x.max() >= nx):
                raise FitsError("the cube has pixels outside its frame")
            values = spectra.flatten().to_numpy(zero_copy_only=False).reshape(-1, channels).astype(">f4")
            for c in range(n_deep):
                part = values[:, c * deep : (c + 1) * deep]
                yield pa.RecordBatch.from_arrays([pa.array(c * n_high + y // high, pa.int64()), pa.array(y, pa.int32()), pa.array(x, pa.int32()), pa.array([v.tobytes() for v in part], pa.binary())], ["key", "y", "x", "v"])

    def write(table: pa.Table) -> pa.Table:
        key = table.column("key")[0].as_py()
        c, row = key // n_high * deep, key % n_high * high
        n, rows = min(deep, channels - c), min(high, ny - row)
        image = np.full((n, rows, nx), np.nan, ">f4")
        known = table.filter(table.column("v").is_valid())
        if known.num_rows:
            values = np.frombuffer(b"".join(known.column("v").to_pylist()), ">f4").reshape(-1, n)
            image[:, known.column("y").to_numpy() - row, known.column("x").to_numpy()] = values.T
        with open(path, "r+b") as f:
            for i, plane in enumerate(image):
                f.seek(start + 4 * nx * ((c + i) * ny + row))
                f.write(plane.tobytes())
            f.flush()
            os.fsync(f.fileno())
        return pa.table({"blocks": pa.array([1], pa.int64())})

    kind = "key long, y int, x int, v binary"
    dealt = cube.select(F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.col("spectrum").cast("array<double>").alias("s")).mapInArrow(deal, kind)
    every = cube.sparkSession.range(n_deep * n_high).select(F.col("id").alias("key"), F.lit(None).cast("int").alias("y"), F.lit(None).cast("int").alias("x"), F.lit(None).cast("binary").alias("v"))
    done = dealt.unionByName(every).groupBy("key").applyInArrow(write, "blocks long").agg(F.sum("blocks")).first()[0]
    if done != n_deep * n_high:
        raise FitsError(f"{done} of {n_deep * n_high} blocks were written")
