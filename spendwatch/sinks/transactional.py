"""All-or-nothing writes to several tables.

Each try of a batch writes every table to a folder of its own, `batch_id=<id>/try_id=<name>`; one marker then names the
batch and the try that count. A batch whose marker exists is done: a replay of it writes nothing. A try that dies before
the marker is never visible to `sources.tables.read_table`. Readers that skip the marker see partial batches.

A calendar table is laid out by columns of its own first, such as an hour, and by batch and try below them, so that a
reader who knows the hours it needs opens no other (`sources.tables.read_calendar`).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from spendwatch import schemas

COMMITS = "commits"
# Batch that creates the empty tables, before any stream batch (those count from 0).
CREATE = -1


def create_tables(spark: SparkSession, root: str, tables: dict[str, StructType],
                  layout: dict[str, list[str]] | None = None, calendar: dict[str, list[str]] | None = None) -> None:
    """Make empty committed tables, so that the first batch can read them."""
    empty = {name: spark.createDataFrame([], schema) for name, schema in tables.items()}
    write_batch(spark, root, CREATE, empty, layout, calendar)


def committed_try(spark: SparkSession, root: str, batch_id: int) -> str | None:
    """The try of a batch that counts; only the batch's own marker is opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{COMMITS}/batch_id={batch_id}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    rows = spark.read.schema(schemas.COMMITS).parquet(path.toString()).select("try_id").take(1)
    return rows[0].try_id if rows else None


def is_committed(spark: SparkSession, root: str, batch_id: int) -> bool:
    return committed_try(spark, root, batch_id) is not None


def write_batch(spark: SparkSession, root: str, batch_id: int, tables: dict[str, DataFrame],
                layout: dict[str, list[str]] | None = None, calendar: dict[str, list[str]] | None = None) -> None:
    """Write and commit a batch; `layout` names the columns by which a table gets folders, `calendar` those that come
    before batch and try."""
    if is_committed(spark, root, batch_id):
        return
    try_id = uuid.uuid4().hex
    for name, rows in tables.items():
        if name in (calendar or {}):
            folders = calendar[name]
            # One file for each folder, unless a folder is too large for one task.
            rows.hint("rebalance", *[F.col(c) for c in folders]).withColumns(
                {"batch_id": F.lit(batch_id), "try_id": F.lit(try_id)}).write.mode("append").partitionBy(
                    *folders, "batch_id", "try_id").parquet(f"{root}/{name}")
            continue
        rows.write.partitionBy(*(layout or {}).get(name, ())).parquet(
            f"{root}/{name}/batch_id={batch_id}/try_id={try_id}")
    mark_committed(spark, root, batch_id, try_id)


def mark_committed(spark: SparkSession, root: str, batch_id: int, try_id: str) -> None:
    marker = spark.range(0, 1, numPartitions=1).select(
        F.lit(try_id).alias("try_id"), F.current_timestamp().alias("committed_at"))
    marker.write.mode("overwrite").parquet(f"{root}/{COMMITS}/batch_id={batch_id}")
