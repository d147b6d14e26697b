"""Visibility of multi-table writes: a batch counts once its commit marker exists."""

from __future__ import annotations

from pyspark.sql import DataFrame


def read_committed(df: DataFrame, commits: DataFrame, batch: str | list[str] = "batch_id") -> DataFrame:
    """Rows of committed batches only. Commit rows are one per batch, so Spark's own size check
    decides whether the semi join broadcasts them."""
    keys = [batch] if isinstance(batch, str) else batch
    return df.join(commits.select(*keys), keys, "left_semi")
