"""Read several schema versions as one table, filling declared defaults."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from spendwatch import settings

# Declared defaults of the event schemas; any other field defaults to null.
DEFAULTS = {
    "currency": settings.DEFAULT_CURRENCY,
    "risk_score": settings.DEFAULT_RISK_SCORE,
    "risk_level": settings.DEFAULT_RISK_LEVEL,
}


def _filled(df: DataFrame, field: StructField) -> Column:
    value = F.col(field.name) if field.name in df.columns else F.lit(None)
    if field.name in DEFAULTS:
        value = F.coalesce(value, F.lit(DEFAULTS[field.name]))
    return value.cast(field.dataType).alias(field.name)


def conform(df: DataFrame, schema: StructType, keep: list[str] = ()) -> DataFrame:
    """Project onto a table shape: absent columns appear, unknown ones go, defaults fill nulls."""
    return df.select(*keep, *[_filled(df, field) for field in schema.fields])


def evolved_union(versions: list[DataFrame], schema: StructType, keep: list[str] = ()) -> DataFrame:
    """Rows of several schema versions as one table of the given shape."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), versions)
    return conform(union, schema, keep)
