"""Payment requests: one JSON body per line in a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Bodies as text, so that an unreadable one is kept and rejected with a reason."""
    return spark.read.text(path)


def stream_requests(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
