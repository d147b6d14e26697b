"""Late records: the grace rule per record, topic and partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spendwatch import settings
from spendwatch.functions.times import interval
from spendwatch.operators import ordered


def _keys(df: DataFrame) -> list[str]:
    return ["topic", "partition"] if "topic" in df.columns else ["partition"]


def stream_time(df: DataFrame, ts: str = "record_ts", block_offsets: int = settings.BLOCK_OFFSETS,
                carry: DataFrame | None = None) -> DataFrame:
    """Add the newest event time seen on the record's topic and partition up to and including the record.

    `carry` holds, per topic and partition, the `newest` time of all records before these (`newest_times`).
    """
    keys = _keys(df)
    timed = ordered.running(df, keys, ts, "stream_time", how="max", ties=(), block_offsets=block_offsets)
    if carry is None:
        return timed
    # One row per partition of a topic: Spark's own size check decides how it meets the records.
    before = carry.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("newest").alias("_newest"))
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(key) == F.col(f"_k_{key}"))
    return timed.join(before, same, "left").withColumn(
        "stream_time", F.greatest("stream_time", "_newest")).select(*df.columns, "stream_time")


def newest_times(df: DataFrame, carry: DataFrame | None = None, ts: str = "record_ts") -> DataFrame:
    """(topic, partition, newest) after these records, for every partition seen so far."""
    keys = _keys(df)
    own = df.dropna(subset=keys).groupBy(*keys).agg(F.max(ts).alias("newest"))
    if carry is None:
        return own
    return carry.select(*keys, "newest").unionByName(own).groupBy(*keys).agg(F.max("newest").alias("newest"))


def flag_late(df: DataFrame, ts: str = "record_ts", size: str = settings.WINDOW,
              grace: str = settings.GRACE, block_offsets: int = settings.BLOCK_OFFSETS,
              carry: DataFrame | None = None) -> DataFrame:
    """Add `late`: the record's window had already closed when the record arrived."""
    end = F.window(ts, size)["end"]
    timed = stream_time(df, ts, block_offsets, carry).withColumn("_end", end)
    return timed.withColumn("late", F.col("_end") <= F.col("stream_time") - interval(grace)).drop("_end")


def late_drop(df: DataFrame, ts: str = "record_ts", size: str = settings.WINDOW,
              grace: str = settings.GRACE, block_offsets: int = settings.BLOCK_OFFSETS) -> DataFrame:
    return flag_late(df, ts, size, grace, block_offsets).where(~F.col("late")).select(*df.columns)
