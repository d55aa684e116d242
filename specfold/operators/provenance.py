"""Combining and splitting tables, manifests, per-mission overrides, provenance strings, dates and names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specfold.errors import NoDataError, SchemaError


def combine(parts: Iterable[DataFrame], links: Iterable[str] = ("tsys_id", "tau_id"), row_id: str = "row_id") -> DataFrame:
    """Union of tables with equal column sets, with the table's number as hdu. Row ids and links become row_id * tables + hdu and so stay unique and right."""
    parts = list(parts)
    if not parts:
        raise NoDataError("nothing to combine")
    names = set(parts[0].columns)
    for i, p in enumerate(parts):
        if set(p.columns) != names:
            raise SchemaError(f"table {i} differs in the columns {sorted(names ^ set(p.columns))}")
    out = None
    for i, p in enumerate(parts):
        moved = p.withColumns({c: F.col(c) * len(parts) + i for c in (row_id, *links)}).withColumn("hdu", F.lit(i))
        out = moved if out is None else out.unionByName(moved)
    return out


def manifest(rows: DataFrame, keys: Iterable[str], never: str, object_column: str = "object") -> DataFrame:
    """One row a chunk: how many rows it has, and whether any is not of the class `never`."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col(object_column) != never).alias("science"))


def chunked_links(rows: DataFrame, keys: Iterable[str], links: Iterable[str] = ("tsys_id", "tau_id"), row_id: str = "row_id") -> DataFrame:
    """Links that leave their row's chunk (its keys) become null."""
    keys = list(keys)
    for link in links:
        there = rows.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(row_id).alias("_there"))
        same = [F.col(link) == F.col("_there"), *[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]]
        rows = rows.join(there, same, "left").withColumn(link, F.col("_there")).drop("_there", *[f"_{k}" for k in keys])
    return rows


def write_split(rows: DataFrame, path: str, keys: Iterable[str], links: Iterable[str] = ()) -> None:
    """A folder for each chunk; links among its rows stay, others become null."""
    keys = list(keys)
    rows = chunked_links(rows, keys, links) if links else rows
    rows.write.mode("overwrite").partitionBy(*keys).parquet(path)


def with_overrides(rows: DataFrame, overrides: DataFrame, defaults: Mapping[str, object], mission: str = "mission_id", most_broadcast: int = 100_000) -> DataFrame:
    """Adds a column for each default, with the mission's own value where it has one."""
    own = overrides.select(F.col(mission), *[F.col(c).alias(f"_own_{c}") for c in defaults if c in overrides.columns])
    small = F.broadcast(own) if own.limit(most_broadcast + 1).count() <= most_broadcast else own
    out = rows.join(small, mission, "left")
    for c, value in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(f"_own_{c}"), F.lit(value)) if c in overrides.columns else F.lit(value))
    return out.drop(*[f"_own_{c}" for c in defaults])


def provenance(values: Mapping[str, Column], skip: Column | None = None) -> Column:
    """Space-separated name=value pairs; null is written none; skip=1 is added where it holds."""
    parts = [F.concat(F.lit(f"{k}="), F.coalesce(v.cast("string"), F.lit("none"))) for k, v in values.items()]
    out = F.concat_ws(" ", *parts)
    return out if skip is None else F.concat(out, F.when(skip, F.lit(" skip=1")).otherwise(""))


def provenance_value(text: Column | str, name: str) -> Column:
    found = F.regexp_extract(text, rf"(?:^| ){name}=(\S+)", 1)
    return F.when((found != "") & (found != "none"), found)


def parse_telescop(name: str) -> list[Column]:
    """receiver, polarization and pixel from names such as LFAV_PX03_S: three letters, H or V, pixel."""
    pattern = r"^([A-Z]{3})([HV])_PX(\d+)"
    part = lambda i: F.regexp_extract(name, pattern, i)
    return [F.when(part(1) != "", part(1)).alias("receiver"), F.when(part(2) != "", part(2)).alias("polarization"), F.when(part(3) != "", part(3).cast("int")).alias("pixel")]


def repaired_date(text: str) -> Column:
    """Dates with unpadded months or days; null if it is none."""
    part = lambda i: F.regexp_extract(text, r"^(\d{4})-(\d{1,2})-(\d{1,2})", i)
    padded = F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0"))
    return F.try_to_date(padded, "yyyy-MM-dd") if hasattr(F, "try_to_date") else F.to_date(F.try_to_timestamp(padded, F.lit("yyyy-MM-dd")))


def instant(day: Column, seconds: Column) -> Column:
    """Seconds since 1970 of seconds after a day's begin."""
    return F.datediff(day, F.lit("1970-01-01").cast("date")) * 86400.0 + seconds


def flight_date(mission: str) -> Column:
    """The day in names that begin with one."""
    return repaired_date(mission)


def closest_names(names: DataFrame, wanted: str, column: str, most: int = 3) -> DataFrame:
    """The nearest names by edit distance, for messages."""
    return names.select(column).distinct().withColumn("distance", F.levenshtein(column, F.lit(wanted))).orderBy("distance", column).limit(most)


def sexagesimal(degrees: Column, hours: bool) -> Column:
    """hh:mm:ss.ss of a right ascension, or +dd:mm:ss.s of a declination."""
    x = F.pmod(degrees, F.lit(360.0)) / 15 if hours else F.abs(degrees)
    unit = 100 if hours else 10
    ticks = F.rint(x * 3600 * unit).cast("long")
    if hours:
        ticks = ticks % (24 * 3600 * unit)
    whole = F.floor(ticks / (3600 * unit))
    minutes = F.floor(ticks / (60 * unit)) % 60
    seconds = (ticks % (60 * unit)) / unit
    if hours:
        return F.format_string("%02d:%02d:%05.2f", whole, minutes, seconds)
    return F.format_string("%s%02d:%02d:%04.1f", F.when(degrees < 0, "-").otherwise("+"), whole, minutes, seconds)
