"""The classifier with few labels, and rows that no label can name."""

import numpy as np
from pyspark.sql import functions as F

from specfold.llm import fm, queries

SF = "/root/testdata/sf0.01"


def test_few_labels(spark):
    """Some three hundred labelled rows are enough for the threshold, not only for the order."""
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = queries.op8_quality(spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95


def test_rows_without_id_are_not_held_out(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "doc_id long").withColumn("h", fm.held_out())
    assert [r["h"] for r in df.orderBy(F.col("doc_id").asc_nulls_first()).collect()][0] is False and df.where("h is null").count() == 0
