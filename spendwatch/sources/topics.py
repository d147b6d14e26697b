"""Topic records: a parquet landing folder, or Kafka where its connector is on the class path.

Both give the envelope columns (topic, partition, offset, record_ts, key, value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from spendwatch import schemas

# Records per poll of the original consumer scale with its few threads; a micro-batch takes files.
DEFAULT_FILES_PER_BATCH = 1000


def read_topic(spark: SparkSession, path: str, schema: StructType = schemas.ENVELOPE) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stream_topic(spark: SparkSession, path: str, schema: StructType = schemas.ENVELOPE,
                 files_per_batch: int = DEFAULT_FILES_PER_BATCH) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _kafka_options(servers: str, topics: list[str], isolation: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "kafka.isolation.level": isolation,
    }


def _envelope(raw: DataFrame) -> DataFrame:
    return raw.select(
        "topic", "partition", "offset", F.col("timestamp").alias("record_ts"),
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def read_kafka(spark: SparkSession, servers: str, topics: list[str],
               isolation: str = "read_committed") -> DataFrame:
    """Batch read of committed records from the earliest offset. Needs the Kafka connector, which
    the test image lacks: not covered by the tests."""
    return _envelope(spark.read.format("kafka").options(**_kafka_options(servers, topics, isolation)).load())


def stream_kafka(spark: SparkSession, servers: str, topics: list[str],
                 isolation: str = "read_committed", offsets_per_batch: int | None = None) -> DataFrame:
    """Stream of committed records. Needs the Kafka connector: not covered by the tests."""
    reader = spark.readStream.format("kafka").options(**_kafka_options(servers, topics, isolation))
    if offsets_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_batch)
    return _envelope(reader.load())
