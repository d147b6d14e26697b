"""High-risk alerts from windowed spend."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from spendwatch import settings
from spendwatch.functions.amounts import to_cents
from spendwatch.functions.risk import risk_level


def risk_alerts(spend: DataFrame, threshold: str = settings.RISK_THRESHOLD) -> DataFrame:
    """One graded alert per window whose total is strictly above the threshold."""
    limit = Decimal(threshold)
    return (
        spend.where(F.col("total") > F.lit(limit))
        .withColumn("total_amount", to_cents(F.col("total")))
        .withColumn("risk_level", risk_level(F.col("total"), limit))
        .drop("total")
    )


def risk_summary(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("alerts"), F.sum("total_amount").alias("total_amount"))
