"""Land both encodings of the initiated event into one typed table.

Binary records carry the amount as unscaled bytes and the time as epoch millis; logical types are
never trusted, both are converted here. JSON records come from the outbox relay and lack the
payment method and the metadata, which become null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spendwatch import schemas
from spendwatch.functions.amounts import decode_amount
from spendwatch.functions.once import with_once
from spendwatch.functions.times import from_millis
from spendwatch.operators.evolution import conform
from spendwatch.operators.quarantine import parse_json

_ENVELOPE = ["topic", "partition", "offset", "record_ts"]
_REQUIRED = ("payment_id", "user_id", "merchant_id", "amount", "initiated_ts")


def _poison(reason: Column) -> Column:
    for column in _REQUIRED:
        reason = reason.when(F.col(column).isNull(), f"missing:{column}")
    return reason


def land_binary(df: DataFrame) -> DataFrame:
    """Columns payment_id, user_id, merchant_id, currency, payment_method, amount_bytes,
    initiated_millis, metadata -> typed payment plus `poison_reason`."""
    bad_amount = F.col("amount").isNull() & F.col("amount_bytes").isNotNull()
    typed = (
        with_once(df, "amount", decode_amount(F.col("amount_bytes")))
        .withColumn("initiated_ts", from_millis(F.col("initiated_millis")))
        .withColumn("poison_reason", _poison(F.when(bad_amount, "amount:undecodable")))
    )
    return _typed(typed, df)


def land_json(df: DataFrame, value: str = "value") -> DataFrame:
    """Relay JSON in `value` -> typed payment plus `poison_reason`."""
    record = F.col("record")
    typed = (
        parse_json(df, schemas.EVENT_JSON, value)
        .withColumn("payment_id", record["paymentId"])
        .withColumn("user_id", record["userId"])
        .withColumn("merchant_id", record["merchantId"])
        .withColumn("amount", record["amount"])
        .withColumn("currency", record["currency"])
        .withColumn("initiated_ts", from_millis(record["initiatedTimestamp"]))
    )
    undecodable = F.when(F.col("poison_reason").isNotNull(), F.col("poison_reason"))
    return _typed(typed.withColumn("poison_reason", _poison(undecodable)), df)


def _typed(typed: DataFrame, source: DataFrame) -> DataFrame:
    envelope = [c for c in _ENVELOPE if c in source.columns]
    return conform(typed, schemas.PAYMENTS_INITIATED, keep=[*envelope, "poison_reason"])


def typed_landing(binary: DataFrame, json: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed payments of both encodings, quarantined records with their reason)."""
    landed = land_binary(binary).unionByName(land_json(json), allowMissingColumns=True)
    return (
        landed.where("poison_reason IS NULL").drop("poison_reason"),
        landed.where("poison_reason IS NOT NULL"),
    )
