"""Dense offsets for new records of many topic partitions, without a running number over all rows of one.

Records are sorted by ranges over the cluster and written once, so that a record's range and its place in it are fixed.
Offsets then follow from counts: one row per topic partition and range is added up after the partition's end offset,
and every record takes its range's start plus its place. A partition that takes most records is many ranges.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from spendwatch.session import shared_folder

KEYS = ("topic", "partition")
_PLACE_BITS = 33  # of a generated row number; the bits above are the task's


def staged_in_order(records: DataFrame, order: tuple[str, ...], keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The records with `_range` and `_place`, written to the shared folder; `order` is total inside a partition."""
    path = f"{shared_folder(records.sparkSession)}/staged/{uuid.uuid4().hex}"
    row = F.monotonically_increasing_id()
    ordered = records.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    ordered.withColumn("_row", row).withColumns({
        "_range": F.shiftright("_row", _PLACE_BITS), "_place": F.col("_row").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)),
    }).drop("_row").write.parquet(path)
    return records.sparkSession.read.parquet(path)


def _same(keys: list[str]) -> Column:
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    return same


def _counts(staged: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return staged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))


def dense_offsets(staged: DataFrame, ends: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Staged records with `offset`: the numbers after each partition's `end_offset` in `ends`, in order, without gaps.

    A partition that `ends` does not have starts at 0.
    """
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    known = ends.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "end_offset")
    starts = (
        _counts(staged, keys)
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .join(known, _same(list(keys)), "left")
        .select(*[F.col(k).alias(f"_k_{k}") for k in (*keys, "_range")],
                (F.coalesce("end_offset", F.lit(0)) + F.col("_before") - F.col("_first")).alias("_shift"))
    )
    kept = [c for c in staged.columns if c not in ("_range", "_place")]
    return (
        staged.join(starts, _same([*keys, "_range"]))
        .withColumn("offset", F.col("_place") + F.col("_shift")).select(*kept, "offset")
    )


def next_ends(staged: DataFrame, ends: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(keys, end_offset) after the staged records, for every partition known so far."""
    new = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("end_offset"))
    return ends.select(*keys, "end_offset").unionByName(new).groupBy(*keys).agg(F.sum("end_offset").alias("end_offset"))
