"""Topic sizes, consumer lag and delivery audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spendwatch import settings
from spendwatch.operators import ordered


def topic_counts(log: DataFrame) -> DataFrame:
    """Records and end offset per topic partition, with the topic's total (partition null).

    The totals come from the per-partition rows, so the log is read and shuffled once.
    """
    per_partition = log.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), (F.max("offset") + 1).alias("end_offset"))
    levels = F.explode(F.array(F.col("partition"), F.lit(None).cast("int"))).alias("_level")
    return (
        per_partition.select("topic", levels, "records", "end_offset")
        .groupBy("topic", F.col("_level").alias("partition"))
        .agg(F.sum("records").alias("records"), F.max("end_offset").alias("_end"))
        .withColumn("end_offset", F.when(F.col("partition").isNotNull(), F.col("_end")))
        .drop("_end")
    )


def consumer_lag(log: DataFrame, commits: DataFrame) -> DataFrame:
    """End offset minus committed offset per group and partition.

    `commits` has group_id, topic, partition, committed_offset; a partition a group never committed
    counts in full. Both sides are one row per partition before they meet.
    """
    ends = log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    # One aggregation gives both the groups of a topic and their commits: a map holds an entry per partition of the topic.
    entry = F.when(F.col("partition").isNotNull(), F.struct("partition", "_committed"))
    committed = (
        commits.groupBy("group_id", "topic", "partition").agg(F.max("committed_offset").alias("_committed"))
        .groupBy("group_id", "topic").agg(F.map_from_entries(F.collect_list(entry)).alias("_by_partition"))
    )
    return (
        committed.join(ends, "topic")
        .withColumn("committed_offset", F.coalesce(F.col("_by_partition")[F.col("partition")], F.lit(0)))
        .withColumn("lag", F.col("end_offset") - F.col("committed_offset"))
        .select("group_id", "topic", "partition", "end_offset", "committed_offset", "lag")
    )


def delivery_audit(accepted: DataFrame, delivered: DataFrame, key: str = "payment_id") -> DataFrame:
    """Accepted payments that were lost or delivered more than once, and deliveries nobody accepted."""
    sides = (
        accepted.select(key, F.lit(1).alias("_accepted"), F.lit(0).alias("_delivered"))
        .unionByName(delivered.select(key, F.lit(0).alias("_accepted"), F.lit(1).alias("_delivered")))
    )
    issue = (
        F.when(F.col("accepted") == 0, "not_accepted")
        .when(F.col("delivered") == 0, "lost")
        .when(F.col("delivered") > F.col("accepted"), "duplicated")
    )
    return (
        sides.groupBy(key)
        .agg(F.sum("_accepted").alias("accepted"), F.sum("_delivered").alias("delivered"))
        .withColumn("issue", issue)
        .where(F.col("issue").isNotNull())
    )


def offset_gaps(log: DataFrame, block_offsets: int = settings.BLOCK_OFFSETS) -> DataFrame:
    """Runs of missing offsets per topic partition."""
    keys = ["topic", "partition"]
    rows = ordered.running(
        log.select(*keys, "offset"), keys, "offset", "_before", how="max", ties=(), exclusive=True,
        block_offsets=block_offsets)
    return rows.where(F.col("offset") > F.col("_before") + 1).select(
        *keys, (F.col("_before") + 1).alias("first_missing"), (F.col("offset") - 1).alias("last_missing"),
        (F.col("offset") - F.col("_before") - 1).alias("missing"))


def order_inversions(df: DataFrame, key: str = "user_id", ts: str = "record_ts",
                     block_offsets: int = settings.BLOCK_OFFSETS) -> DataFrame:
    """Records that arrive after a newer record of the same key."""
    rows = ordered.running(df, [key], ts, "newest_before", how="max", exclusive=True,
                           block_offsets=block_offsets)
    return rows.where(F.col(ts) < F.col("newest_before"))
