"""Isolate records that cannot be decoded, so that one bad record never stops the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from spendwatch.functions.once import with_once

_BROKEN = "_broken"


def parse_json(df: DataFrame, schema: StructType, value: str = "value",
               required: tuple[str, ...] = ()) -> DataFrame:
    """Add `record` and `poison_reason` (null for a readable record)."""
    probe = StructType([*schema.fields, StructField(_BROKEN, StringType(), True)])
    parsed = F.from_json(
        F.col(value), probe, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    reason = F.when(F.col(value).isNull(), "empty").when(
        F.col("_parsed").isNull() | F.col(f"_parsed.{_BROKEN}").isNotNull(), "undecodable")
    for field in required:
        reason = reason.when(F.col(f"_parsed.{field}").isNull(), f"missing:{field}")
    record = F.struct(*[F.col(f"_parsed.{f}").alias(f) for f in schema.fieldNames()])
    return (
        with_once(df, "_parsed", parsed)
        .withColumn("poison_reason", reason)
        .withColumn("record", F.when(F.col("poison_reason").isNull(), record))
        .drop("_parsed")
    )


def split_poison(df: DataFrame, schema: StructType, value: str = "value",
                 required: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(readable rows with the record's fields, unreadable rows with their reason)."""
    parsed = parse_json(df, schema, value, required)
    good = parsed.where("poison_reason IS NULL").select(*df.columns, "record.*")
    bad = parsed.where("poison_reason IS NOT NULL").drop("record")
    return good, bad
