"""Topic writers for parquet landing folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from spendwatch import settings
from spendwatch.functions.hashing import key_partition


def initiated_records(payments: DataFrame, topic: str, value: Column, offset: Column | str = "offset",
                      record_ts: Column | str = "record_ts") -> DataFrame:
    """Payments with an assigned partition -> whole records (the envelope) keyed by user."""
    offset, record_ts = (F.col(c) if isinstance(c, str) else c for c in (offset, record_ts))
    return payments.select(
        F.lit(topic).alias("topic"), "partition", offset.alias("offset"), record_ts.alias("record_ts"),
        F.col("user_id").alias("key"), value.alias("value"))


def write_by_partition(records: DataFrame, path: str) -> None:
    """Write records under topic / partition folders.

    Partition 0 takes every high-value record; rebalancing clusters by partition but lets AQE split
    a partition that is too large for one task.
    """
    clustered = records.hint("rebalance", F.col("topic"), F.col("partition"))
    clustered.write.mode("append").partitionBy("topic", "partition").parquet(path)


def relay_records(outbox: DataFrame, at: Column, partitions: int = settings.PARTITIONS) -> DataFrame:
    """Outbox rows -> records for the topic each row names, without offsets yet, in the order of their creation.

    `operators.numbering` numbers them; created_at and id order the records of a partition.
    """
    keyless = F.pmod(F.xxhash64("id"), F.lit(partitions)).cast("int")
    return outbox.select(
        "id", F.col("kafka_topic").alias("topic"),
        F.coalesce(key_partition(F.col("kafka_key"), partitions, "kafka"), keyless).alias("partition"),
        at.alias("record_ts"), F.col("kafka_key").alias("key"), F.col("payload").alias("value"), "created_at")


def alert_records(alerts: DataFrame, topic: str = settings.TOPIC_ALERTS) -> DataFrame:
    """Alerts -> records keyed by user."""
    return alerts.select(
        F.lit(topic).alias("topic"), F.col("user_id").alias("key"), F.to_json(F.struct(*alerts.columns)).alias("value"))


def write_kafka(records: DataFrame, servers: str) -> None:
    """Send records to the topics they name. Needs the Kafka connector, which the test image lacks: not
    covered by the tests. Delivery is at least once; `operators.dedup` removes the copies downstream."""
    records.select("topic", "key", "value").write.format("kafka").option(
        "kafka.bootstrap.servers", servers).save()


def append_stream(df: DataFrame, path: str, checkpoint: str, name: str,
                  trigger: dict[str, object] | None = None) -> StreamingQuery:
    """Exactly-once file sink; by default it drains what is available, then stops."""
    return (
        df.writeStream.queryName(name).outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
