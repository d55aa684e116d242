"""Row-local stages on streams of spectra: filters, reduction, correction with fitted models.

All of these need only the row itself and small tables, so that they run alike on a stream; links,
averages, fits and grids need all rows and stay in batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from specfold.functions import kernels as K
from specfold.operators import filters
from specfold.operators.kernel_ops import map_arrays


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def reduced_stream(rows: DataFrame, spec: filters.FilterSpec, order: int = 1, window: tuple[int, int] | None = None, smooth: int = 1, spectrum: str = "spectrum") -> DataFrame:
    """Rows that pass the filters, with a clipped baseline subtracted and smoothed."""
    if spec.tau_id:
        raise ValueError("opacity filters follow links and need all rows")
    clean = filters.with_reject_reason(rows, spec).where("reject_reason is null").drop("reject_reason")
    return map_arrays(clean, spectrum, lambda y: K.smooth(K.baseline(y, order, window), smooth), {spectrum: "array<double>"})


def counts_by_window(rows: DataFrame, time: str, late: str = "10 minutes", width: str = "1 hour", key: str = "object") -> DataFrame:
    """Rows of each class in windows of time; windows close when the watermark passes them."""
    return rows.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n"))


def start(rows: DataFrame, path: str, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Appends to Parquet once per row, or hands each batch on; checkpoint is in a shared folder."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(each).start() if each else writer.outputMode("append").format("parquet").start(path)


