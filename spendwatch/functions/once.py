"""Evaluate an expensive expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression runs once, however many later filters and columns use it.

    With a plain projection Catalyst copies the expression into each filter it pushes down, so a
    JSON body would be parsed again for every condition. Filters on the output of a generator stay
    above it; filters on the other columns still reach the scan.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
