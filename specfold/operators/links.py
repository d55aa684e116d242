"""Joins: science rows with calibration, observation pairs, models by fallback, cycles over files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from specfold.errors import PairingError
from specfold.work import work_folder, written


def link_calibration(science: DataFrame, calibration: DataFrame, by: Iterable[str] = ("mission_id", "scan"), name: str = "cal_id", blocks: int | None = None, folder: str | None = None) -> DataFrame:
    """science: row_id, subscan, t and the keys; calibration: the same. Adds the linked calibration row's id, or null.

    Of the calibration rows with equal keys, the one taken in the subscan before comes first
    (smallest id), else the nearest in time (smallest id on ties); without times the smallest id.
    Nearest rows come from one pass up and one down the time order of each group, not from pairs:
    each science row sees the last calibration before it and the first after it. Rows are range-sorted by group and time into blocks
    (as many as the shuffle makes, or `blocks`), so that a group of any size spreads over tasks; the last and first calibration of
    each block are handed on to the blocks that follow and go before.
    """
    keys = list(by)
    cal = calibration.select(*keys, F.col("row_id").alias("_cal"), F.col("subscan").alias("_sub"), F.col("t").alias("_t"))
    before = cal.groupBy(*keys, (F.col("_sub") + 1).alias("subscan")).agg(F.min("_cal").alias("_before"))
    lowest = cal.groupBy(*keys).agg(F.min("_cal").alias("_lowest"))
    timed = cal.where(F.col("_t").isNotNull()).groupBy(*keys, F.col("_t").alias("t")).agg(F.min("_cal").alias("_cal"))
    wanted = science.where(F.col("t").isNotNull()).select(*keys, "t", "row_id")
    marks = timed.select(*keys, "t", F.lit(None).cast(wanted.schema["row_id"].dataType).alias("row_id"), F.struct("t", F.col("_cal").alias("id")).alias("_at"))
    line = wanted.withColumn("_at", F.lit(None).cast(marks.schema["_at"].dataType)).unionByName(marks)
    at = [*keys, "t", "row_id"]
    ranged = line.repartitionByRange(blocks, *at) if blocks else line.repartitionByRange(*at)
    line = written(ranged.withColumn("_block", F.spark_partition_id()), f"{folder or work_folder(science.sparkSession)}/line")
    ends = line.groupBy(*keys, "_block").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    carried = lambda end, order: end.over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    hand = ends.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_block").alias("_b"), carried(F.max("_last"), F.col("_block").asc()).alias("_from"), carried(F.min("_first"), F.col("_block").desc()).alias("_to"))
    seen = lambda order: F.last("_at", ignorenulls=True).over(Window.partitionBy(*keys, "_block").orderBy(order, F.col("row_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    sides = line.withColumn("_up", seen(F.col("t").asc())).withColumn("_down", seen(F.col("t").desc())).where(F.col("row_id").isNotNull())
    sides = sides.join(hand, [*[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col("_block") == F.col("_b")])
    sides = sides.select("row_id", "t", F.coalesce("_up", "_from").alias("_up"), F.coalesce("_down", "_to").alias("_down"))
    gap = lambda side: F.struct(F.abs(F.col("t") - F.col(f"{side}.t")).alias("gap"), F.col(f"{side}.id").alias("id"))
    nearest = F.when(F.col("_up").isNull(), F.col("_down.id")).when(F.col("_down").isNull(), F.col("_up.id")).otherwise(F.least(gap("_up"), gap("_down"))["id"])
    out = science.join(before, [*keys, "subscan"], "left").join(sides.select("row_id", nearest.alias("_nearest")), "row_id", "left").join(lowest, keys, "left")
    return out.withColumn(name, F.coalesce("_before", "_nearest", "_lowest")).drop("_before", "_nearest", "_lowest")


def check_unique(rows: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Raises if a key has more than one row."""
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise PairingError(f"more than one row has the key {twice[0].asDict()}")
    return rows


def pair_rows(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> DataFrame:
    keys = list(keys)
    return left.select(*keys, F.col("row_id").alias("left_id")).join(right.select(*keys, F.col("row_id").alias("right_id")), keys)


def unpaired(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keys and ids of left's rows that have no partner."""
    keys = list(keys)
    return left.select(*keys, "row_id").join(right.select(*keys), keys, "left_anti")


def ranked(rows: DataFrame, within: Iterable[str] = (), block: int = 1 << 16) -> DataFrame:
    """Adds place, counted from 1 in the order of the unique row_id inside each group.

    Blocks of row_id are counted first, so that a group's rows are spread over tasks; only one
    number a block is summed up in order.
    """
    keys = list(within)
    blocked = rows.withColumn("_block", F.floor(F.col("row_id") / block))
    counts = blocked.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    starts = counts.select(*keys, "_block", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy("row_id"))
    return blocked.join(starts, [*keys, "_block"]).withColumn("place", F.col("_before") + inside).drop("_block", "_before")


def pair_positional(left: DataFrame, right: DataFrame, within: Iterable[str] = ()) -> DataFrame:
    """The i-th row of left with the i-th of right, by row_id, inside each group."""
    keys = list(within)
    a = ranked(left.select(*keys, "row_id"), keys).withColumnRenamed("row_id", "left_id")
    b = ranked(right.select(*keys, "row_id"), keys).withColumnRenamed("row_id", "right_id")
    return a.join(b, [*keys, "place"])


def match_models(rows: DataFrame, models: DataFrame, prefix: int = 4) -> DataFrame:
    """rows: mission_id, telescop; models: model_id, mission_id, telescop. Adds model_id: of the exact telescope, else of its first `prefix` characters, else of the mission (smallest id)."""
    exact = models.groupBy("mission_id", "telescop").agg(F.min("model_id").alias("_exact"))
    short = exact.select("mission_id", F.col("telescop").alias("_short"), F.col("_exact").alias("_of_short"))
    whole = models.groupBy("mission_id").agg(F.min("model_id").alias("_of_mission"))
    out = rows.join(exact, ["mission_id", "telescop"], "left").withColumn("_short", F.substring("telescop", 1, prefix))
    out = out.join(short, ["mission_id", "_short"], "left").join(whole, "mission_id", "left")
    return out.withColumn("model_id", F.coalesce("_exact", "_of_short", "_of_mission")).drop("_exact", "_of_short", "_of_mission", "_short")


def common_cycles(rows: DataFrame, n_files: int) -> DataFrame:
    """rows: file, scan, subscan. Cycles that all files have."""
    return rows.groupBy("scan", "subscan").agg(F.count_distinct("file").alias("n")).where(F.col("n") == n_files).select("scan", "subscan")


def cycle_winners(rows: DataFrame, n_files: int) -> DataFrame:
    """rows: file, scan, subscan, value. For each common cycle the file of the least value (smallest name on ties), that value, and how many files share it."""
    least = rows.groupBy("scan", "subscan").agg(F.count_distinct("file").alias("n"), F.min(F.struct("value", "file")).alias("best")).where(F.col("n") == n_files)
    ties = rows.join(least.select("scan", "subscan", F.col("best.value").alias("least"), F.col("best.file").alias("winner")), ["scan", "subscan"]).where(F.col("value") == F.col("least"))
    return ties.groupBy("scan", "subscan", "winner", "least").agg(F.count_distinct("file").alias("n_tied"))


def cycle_values(rows: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """rows: scan, subscan, value. Mean of each cycle, and whether its values differ."""
    return rows.groupBy("scan", "subscan").agg(F.avg("value").alias("mean_value"), (F.max("value") - F.min("value") > tolerance).alias("mixed"))
