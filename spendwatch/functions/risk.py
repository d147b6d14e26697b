"""Risk grading of a window total."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Multiples of the threshold at which a level starts, inclusive.
LEVEL_STARTS = [("CRITICAL", Decimal("2.0")), ("HIGH", Decimal("1.5"))]
LOWEST_LEVEL = "MEDIUM"


def risk_level(total: Column, threshold: Decimal | str) -> Column:
    """Level of a total already known to exceed the threshold."""
    level = F.lit(LOWEST_LEVEL)
    for name, multiple in reversed(LEVEL_STARTS):
        level = F.when(total >= F.lit(Decimal(threshold) * multiple), name).otherwise(level)
    return level
