"""Table upkeep: latest value per key, time retention, size retention."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from spendwatch import settings
from spendwatch.functions.maps import comparable, restored
from spendwatch.functions.times import interval
from spendwatch.operators.ordered import offset_block


def _last_records(df: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    rest = [c for c in df.columns if c != key and c not in order]
    return (
        df.groupBy(key)
        .agg(F.max(F.struct(*order, *comparable(df, rest))).alias("_last"))
        .select(*[F.col(key) if c == key else restored(df, "_last", c) for c in df.columns])
    )


def latest_by_key(df: DataFrame, key: str, value: str,
                  order: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """Current value of each key; a key whose last record is a tombstone (null) is gone."""
    return _last_records(df.select(key, value, *order), key, order).where(F.col(value).isNotNull())


def compact(df: DataFrame, key: str, value: str, as_of: Column, ts: str = "record_ts",
            order: tuple[str, ...] = ("partition", "offset"),
            tombstone_retention: str = settings.TOMBSTONE_RETENTION) -> DataFrame:
    """Compacted log: the last record of each key, tombstones kept while they are recent enough."""
    recent = F.col(ts) > as_of - interval(tombstone_retention)
    return _last_records(df, key, order).where(F.col(value).isNotNull() | recent)


def retain_time(df: DataFrame, as_of: Column, ts: str = "record_ts",
                max_age: str = settings.EVENT_RETENTION) -> DataFrame:
    """Rows no older than `max_age`. With a literal `as_of` the bound reaches the parquet scan."""
    return df.where(F.col(ts) >= as_of - interval(max_age))


def retain_bytes(
    df: DataFrame,
    size: str,
    max_bytes: int = settings.RETENTION_BYTES,
    partition: tuple[str, ...] = ("topic", "partition"),
    position: str = "offset",
    block_offsets: int = settings.BLOCK_OFFSETS,
) -> DataFrame:
    """Newest rows of each partition whose sizes add up to at most `max_bytes`; rows of one offset stay or go together.

    Two searches find the first offset a partition keeps, and a filter on it does the rest, so kept rows are never shuffled.
    Block totals, combined map side, give the block in which the limit falls; only that block's offsets and sizes are
    ordered, at most `block_offsets` of them a partition. The cuts are one row per partition of a topic, which bounds what is
    broadcast: name as `partition` only columns of which that is true. Rows without a partition value are a partition too.
    """
    keys = list(partition)
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    sized = df.select(*keys, F.col(position).alias("_position"), F.coalesce(F.col(size), F.lit(0)).alias("_size"),
                      offset_block(position, block_offsets).alias("_block"))
    edges = (
        sized.groupBy(*keys, "_block").agg(F.sum("_size").alias("_bytes"))
        .withColumn("_newer", F.coalesce(F.sum("_bytes").over(newest_first), F.lit(0)))
        .where((F.col("_newer") <= max_bytes) & (F.col("_newer") + F.col("_bytes") > max_bytes))
        .select(*keys, "_block", "_newer")
    )
    # The limit falls into the newest block that passes it; a partition without such a block keeps everything.
    inside = Window.partitionBy(*keys).orderBy(F.desc("_position")).rangeBetween(Window.unboundedPreceding, 0)
    cuts = (
        _matched(sized, edges, [*keys, "_block"], "inner")
        .withColumn("_over", F.col("_newer") + F.sum("_size").over(inside) > max_bytes)
        .groupBy(*keys).agg(F.max(F.when(F.col("_over"), F.col("_position"))).alias("_cut"))
    )
    return _matched(df, cuts, keys, "left").where(
        F.col("_cut").isNull() | (F.col(position) > F.col("_cut"))).select(*df.columns)


def _matched(rows: DataFrame, few: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Rows with the other columns of `few`, one row per partition of a topic, null keys matching each other."""
    named = few.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in few.columns if c not in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return rows.join(F.broadcast(named), same, how)
