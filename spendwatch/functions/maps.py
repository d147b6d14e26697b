"""Structs that hold maps cannot be compared; their entries can."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _is_map(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() == "map"


def comparable(df: DataFrame, columns: list[str]) -> list[Column]:
    """Columns to put into a struct for min or max."""
    return [F.map_entries(c).alias(c) if _is_map(df, c) else F.col(c) for c in columns]


def restored(df: DataFrame, struct: str, column: str) -> Column:
    """The column as it was, from the struct of `comparable` columns."""
    field = F.col(f"{struct}.{column}")
    return (F.map_from_entries(field) if _is_map(df, column) else field).alias(column)
