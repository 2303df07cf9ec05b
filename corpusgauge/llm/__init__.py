"""Operators of a training-data pipeline over tables of documents and pages."""

from __future__ import annotations

from pyspark.sql import SparkSession

BATCH_BYTES = str(16 << 20)


def bound_batches(spark: SparkSession) -> None:
    """Send rows to Python workers in batches of at most 16 MB (one row at least)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
