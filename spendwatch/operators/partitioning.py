"""Value-aware partition assignment and the audits around it."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from spendwatch import settings
from spendwatch.functions.hashing import key_partition
from spendwatch.operators.windows import with_window_end, with_window_start

HIGH_VALUE_PARTITION = 0


def is_high_value(amount: Column, high: str = settings.HIGH_VALUE) -> Column:
    """Strictly above the limit; an unknown amount is not high value."""
    return F.coalesce(amount > F.lit(Decimal(high)), F.lit(False))


def assign_partition(
    df: DataFrame,
    key: str = "user_id",
    amount: str = "amount",
    partitions: int = settings.PARTITIONS,
    high: str = settings.HIGH_VALUE,
    mode: str = "coded",
    into: str = "partition",
    spread: str = "payment_id",
) -> DataFrame:
    """Add the topic partition: 0 for high-value rows, the key's hash otherwise.

    A row without a key is spread by the hash of `spread`, so a re-run assigns it the same partition.
    """
    hashed = key_partition(F.col(key), partitions, mode)
    unkeyed = F.pmod(F.xxhash64(spread), F.lit(partitions)).cast("int")
    by_key = F.when(F.col(key).isNull(), unkeyed).otherwise(hashed)
    routed = F.when(is_high_value(F.col(amount), high), F.lit(HIGH_VALUE_PARTITION)).otherwise(by_key)
    return df.withColumn(into, routed)


def partition_skew(df: DataFrame, high: str = settings.HIGH_VALUE, partition: str = "partition") -> DataFrame:
    """Records, high-value records and amount per partition."""
    high_value = is_high_value(F.col("amount"), high)
    return df.groupBy(partition).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(high_value).alias("high_value_records"),
        F.sum("amount").alias("amount"),
    )


def partition_split_audit(
    df: DataFrame,
    threshold: str = settings.RISK_THRESHOLD,
    ts: str = "record_ts",
    size: str = settings.WINDOW,
) -> DataFrame:
    """Windows whose verdict changes when each partition sums a user's payments on its own."""
    limit = F.lit(Decimal(threshold))
    partial = (
        with_window_start(df.dropna(subset=["user_id"]), ts, size)
        .groupBy("user_id", "window_start", "partition")
        .agg(F.sum("amount").alias("_partial"))
    )
    windows = (
        partial.groupBy("user_id", "window_start")
        .agg(
            F.sum("_partial").alias("total"),
            F.max("_partial").alias("largest_partial"),
            F.count(F.lit(1)).alias("partitions"),
        )
        .withColumn("user_alert", F.col("total") > limit)
        .withColumn("split_alert", F.col("largest_partial") > limit)
        .where(F.col("user_alert") != F.col("split_alert"))
    )
    return with_window_end(windows, size)
