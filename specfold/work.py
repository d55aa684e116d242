"""Work tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir, deleted when the application ends; a local one only in a local session that names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="specfold-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/specfold-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(at)
    store.deleteOnExit(at)
    return path


def written(df: DataFrame, path: str) -> DataFrame:
    """df as a table that is written once and read from then on."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
