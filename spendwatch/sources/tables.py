"""Relational tables: parquet, committed batches, or a database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from spendwatch import schemas
from spendwatch.operators.commits import read_committed
from spendwatch.operators.evolution import evolved_union
from spendwatch.sinks.transactional import COMMITS, committed_try, is_committed


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              bounds: tuple[str, str] | None = None, partitions: int = 1) -> DataFrame:
    """Table over JDBC; filters such as status = 'PENDING' are pushed to the database.
    Needs the database's driver: not covered by the tests."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=str(partitions))
    return reader.load()


_WRITTEN = [StructField("batch_id", LongType(), True), StructField("try_id", StringType(), True)]


def read_table(spark: SparkSession, root: str, name: str, schema: StructType) -> DataFrame:
    """Committed rows of a table written by `sinks.transactional`."""
    rows = spark.read.schema(StructType([*schema.fields, *_WRITTEN])).parquet(f"{root}/{name}")
    committed = read_committed(rows, read_commits(spark, root), ["batch_id", "try_id"])
    return committed.select(*schema.fieldNames(), "batch_id")


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.COMMITS).parquet(f"{root}/{COMMITS}").select("batch_id", "try_id", "committed_at")


def last_committed(spark: SparkSession, root: str, before: int) -> int | None:
    """The highest committed batch below `before`. Consecutive batches cost one look-up, however many there are."""
    if is_committed(spark, root, before - 1):
        return before - 1
    numbers = sorted((n for n in _batches(spark, root) if n < before - 1), reverse=True)
    return next((n for n in numbers if is_committed(spark, root, n)), None)


def committed_after(spark: SparkSession, root: str, after: int) -> list[tuple[int, str]]:
    """(batch, try) of the committed batches above `after`; only their markers are opened."""
    numbers = [n for n in _batches(spark, root) if n > after]
    if not numbers:
        return []
    rows = spark.read.schema(schemas.COMMITS).option("basePath", f"{root}/{COMMITS}").parquet(
        *[f"{root}/{COMMITS}/batch_id={n}" for n in sorted(numbers)])
    return sorted((r.batch_id, r.try_id) for r in rows.select("batch_id", "try_id").collect())


def read_batches(spark: SparkSession, root: str, name: str, schema: StructType,
                 batches: list[tuple[int, str]]) -> DataFrame:
    """Rows that these committed (batch, try) wrote to a table; no other folder is listed or opened."""
    if not batches:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(
        *[f"{root}/{name}/batch_id={n}/try_id={t}" for n, t in batches])
    return rows.select(*schema.fieldNames())


def read_snapshot(spark: SparkSession, root: str, name: str, schema: StructType, batch_id: int | None) -> DataFrame:
    """A table that every batch writes whole, as one committed batch left it."""
    tried = committed_try(spark, root, batch_id) if batch_id is not None else None
    return read_batches(spark, root, name, schema, [(batch_id, tried)] if tried else [])


def read_calendar(spark: SparkSession, root: str, name: str, schema: StructType, column: str, low: int,
                  high: int) -> DataFrame:
    """Rows of a calendar table whose folder `column` lies in low..high, with batch_id and try_id.

    Only these folders are listed and opened. `schema` holds the table's columns and its folders'.
    """
    whole = StructType([*schema.fields, *_WRITTEN])
    if not (paths := _folders(spark, f"{root}/{name}", column, low, high)):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", f"{root}/{name}").parquet(*paths)


# Folders looked up one by one; a longer span is listed by name.
_LOOKUPS = 100


def _folders(spark: SparkSession, base: str, column: str, low: int, high: int) -> list[str]:
    parent = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = parent.getFileSystem(spark._jsc.hadoopConfiguration())
    if high - low < _LOOKUPS:
        paths = [f"{base}/{column}={n}" for n in range(low, high + 1)]
        return [p for p in paths if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p))]
    if not files.exists(parent):
        return []
    names = [f.getPath().getName() for f in files.listStatus(parent)]
    own = [n for n in names if n.startswith(f"{column}=")]
    return [f"{base}/{n}" for n in sorted(own) if low <= int(n.removeprefix(f"{column}=")) <= high]


def _batches(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all batches that have a marker folder, by name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{COMMITS}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [f.getPath().getName() for f in files.listStatus(path)]
    return [int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")]


def read_versions(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """Parquet written under several schema versions, as one table with defaults filled."""
    return evolved_union([spark.read.option("mergeSchema", "true").parquet(*paths)], schema)
