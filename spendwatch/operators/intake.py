"""Payment requests: read the JSON body, check it, split accepted from rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spendwatch import schemas, settings
from spendwatch.functions.once import with_once
from spendwatch.operators.quarantine import parse_json

_BODY_COLUMNS = {
    "userId": "user_id", "merchantId": "merchant_id", "amount": "amount", "currency": "currency",
    "paymentMethod": "payment_method",
}


def parse_intake(df: DataFrame, body: str = "value") -> DataFrame:
    """JSON bodies -> request columns plus `unreadable`; the other columns stay."""
    parsed = parse_json(df, schemas.INTAKE_BODY, body)
    fields = [F.col(f"record.{source}").alias(name) for source, name in _BODY_COLUMNS.items()]
    return parsed.select(*df.columns, *fields, F.col("poison_reason").isNotNull().alias("unreadable"))


def _text_reasons(column: str, label: str) -> list[Column]:
    value = F.col(column)
    blank = value.isNull() | ~value.rlike(r"\S")
    return [
        F.when(blank, F.lit(f"{label}:blank")),
        F.when(F.char_length(value) > settings.MAX_LENGTHS[column], F.lit(f"{label}:too_long")),
    ]


def reject_reasons(df: DataFrame) -> Column:
    """Array of the rules a request breaks, empty for a good one."""
    reasons = [
        *_text_reasons("user_id", "userId"),
        *_text_reasons("merchant_id", "merchantId"),
        F.when(F.col("amount").isNull(), F.lit("amount:missing")),
        F.when(F.col("amount") <= 0, F.lit("amount:not_positive")),
        *_text_reasons("currency", "currency"),
    ]
    for column, label, allowed in (
        ("payment_method", "paymentMethod", settings.PAYMENT_METHODS),
        ("status", "status", settings.PAYMENT_STATUSES),
        ("risk_level", "riskLevel", settings.RISK_LEVELS),
    ):
        if column in df.columns:
            if column in settings.MAX_LENGTHS:
                reasons.append(F.when(
                    F.char_length(column) > settings.MAX_LENGTHS[column], F.lit(f"{label}:too_long")))
            reasons.append(F.when(~F.col(column).isin(allowed), F.lit(f"{label}:unknown")))
    checked = F.array_compact(F.array(*reasons))
    if "unreadable" in df.columns:
        return F.when(F.col("unreadable"), F.array(F.lit("body:unreadable"))).otherwise(checked)
    return checked


def check_payments(df: DataFrame) -> DataFrame:
    """Add `reject_reasons` and `accepted` in one pass over the rows."""
    return (
        with_once(df, "reject_reasons", reject_reasons(df))
        .withColumn("accepted", F.size("reject_reasons") == 0)
    )


def validate_payments(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = check_payments(df)
    return (
        checked.where("accepted").drop("accepted", "reject_reasons"),
        checked.where("NOT accepted").drop("accepted"),
    )
