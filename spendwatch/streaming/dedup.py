"""Drop repeated deliveries in a stream.

`first_deliveries` keeps each key in the state store for `ttl` of processing time from its first
acceptance, which is what a key with an expiry in a cache does. `dedup_within_watermark` is the
event-time form. Both look a key up locally in its state partition, so the cost of a micro-batch does
not grow with the number of keys remembered.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StructField, StructType

from spendwatch import settings

# No leading underscore: the processor would see such a column under another name.
_RELEASE = "is_release"
_ORDER = ["record_ts", "partition", "offset"]


class FirstDelivery(StatefulProcessor):
    """Emit the earliest delivery of a key that is not held; a release row frees the key first."""

    def __init__(self, ttl_millis: int):
        self.ttl_millis = ttl_millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState(
            "held", StructType([StructField("held", BooleanType(), True)]), self.ttl_millis)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first, released = None, False
        for batch in rows:
            released = released or bool(batch[_RELEASE].any())
            fresh = batch[~batch[_RELEASE]].drop(columns=[_RELEASE])
            if len(fresh):
                earliest = fresh.sort_values(_ORDER).head(1)
                if first is not None:
                    earliest = pd.concat([first, earliest]).sort_values(_ORDER).head(1)
                first = earliest
        if released:
            self.held.clear()
        if first is not None and not self.held.exists():
            self.held.update((True,))
            yield first

    def close(self) -> None:
        pass


def _collapse(key: str):
    def collapse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.sort_values(_ORDER).drop_duplicates(key)
    return collapse


def first_deliveries(payments: DataFrame, key: str = "payment_id", ttl_seconds: int = 24 * 3600,
                     releases: DataFrame | None = None) -> DataFrame:
    """Stream of first deliveries. `releases` is a stream of keys whose processing finally failed.

    All rows of a micro-batch share its processing time, so at most one delivery per key is accepted
    and copies may be collapsed before the shuffle: a key that makes up a third of the rows reaches
    its state partition as a few rows per task.
    """
    schema = payments.schema
    rows = payments.mapInPandas(_collapse(key), schema).withColumn(_RELEASE, F.lit(False))
    if releases is not None:
        freed = releases.select(key, F.lit(True).alias(_RELEASE))
        rows = rows.unionByName(freed, allowMissingColumns=True)
    return rows.groupBy(key).transformWithStateInPandas(
        FirstDelivery(ttl_seconds * 1000), schema, "Append", "ProcessingTime")


def dedup_within_watermark(payments: DataFrame, key: str = "payment_id", ts: str = "record_ts",
                           ttl: str = settings.DEDUP_TTL) -> DataFrame:
    """Event-time form: duplicates within `ttl` of the first delivery are dropped."""
    return payments.withWatermark(ts, ttl).dropDuplicatesWithinWatermark([key])
