"""Table shapes. Every reader takes one of these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
_S, _TS, _L, _I = T.StringType(), T.TimestampType(), T.LongType(), T.IntegerType()


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# One record of a topic as landed: the columns of Spark's Kafka source plus the event time.
ENVELOPE = _table(
    ("topic", _S), ("partition", _I), ("offset", _L), ("record_ts", _TS), ("key", _S), ("value", _S),
)

PAYMENTS_INITIATED = _table(
    ("payment_id", _S), ("user_id", _S), ("merchant_id", _S), ("amount", MONEY), ("currency", _S),
    ("payment_method", _S), ("initiated_ts", _TS), ("metadata", T.MapType(_S, _S)),
)

PAYMENTS_PROCESSED = _table(
    ("payment_id", _S), ("user_id", _S), ("amount", MONEY), ("currency", _S), ("status", _S),
    ("risk_score", T.DoubleType()), ("processed_ts", _TS), ("failure_reason", _S),
)

# A window total is a sum and may outgrow the width of one amount.
ALERTS = _table(
    ("user_id", _S), ("total_amount", T.DecimalType(28, 2)), ("window_start", _TS), ("window_end", _TS),
    ("alert_generated_ts", _TS), ("risk_level", _S), ("payments", _L),
)

# The payments behind alerts: one row per alert and block of offsets, ids in order (operators/windows.py).
ALERT_PAYMENT_IDS = _table(
    ("user_id", _S), ("window_start", _TS), ("block", _L),
    ("ids", T.ArrayType(_table(("record_ts", _TS), ("partition", _I), ("offset", _L), ("payment_id", _S)))),
)

PAYMENTS = _table(
    ("id", _S), ("user_id", _S), ("merchant_id", _S), ("amount", MONEY), ("currency", _S),
    ("status", _S), ("created_at", _TS),
)

OUTBOX = _table(
    ("id", _S), ("aggregate_type", _S), ("aggregate_id", _S), ("event_type", _S), ("payload", _S),
    ("kafka_topic", _S), ("kafka_key", _S), ("status", _S), ("created_at", _TS), ("published_at", _TS),
)

PROCESSED_MESSAGES = _table(("message_key", _S), ("topic", _S), ("processed_at", _TS))

BALANCES = _table(("user_id", _S), ("balance", MONEY))

ATTEMPTS = _table(
    ("payment_id", _S), ("attempt", _I), ("failed_at", _TS), ("error_class", _S),
    ("exception_message", _S), ("original_topic", _S), ("original_partition", _I), ("original_offset", _L),
    ("original_key", _S), ("payload", _S),
)

DEAD_LETTER = _table(
    ("payment_id", _S), ("original_topic", _S), ("attempts", _I), ("error_class", _S),
    ("exception_message", _S), ("failed_at", _TS), ("original_partition", _I), ("original_offset", _L),
    ("original_key", _S), ("payload", _S),
)

COMMITS = _table(("batch_id", _L), ("try_id", _S), ("committed_at", _TS))

FIELD_CATALOG = _table(
    ("subject", _S), ("version", _I), ("field", _S), ("type", _S), ("has_default", T.BooleanType()),
    ("symbols", T.ArrayType(_S)), ("enum_default", _S),
)

# Body of a payment request, names as the callers send them.
INTAKE_BODY = _table(
    ("userId", _S), ("merchantId", _S), ("amount", MONEY), ("currency", _S), ("paymentMethod", _S),
)

# JSON event sent by the outbox relay: it carries neither the payment method nor the metadata.
EVENT_JSON = _table(
    ("paymentId", _S), ("userId", _S), ("merchantId", _S), ("amount", MONEY), ("currency", _S),
    ("initiatedTimestamp", _L),
)
