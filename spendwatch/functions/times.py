"""Epoch milliseconds, instants and duration literals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def to_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def interval(text: str) -> Column:
    """'30 seconds' -> interval column."""
    return F.expr(f"INTERVAL {text}")
