"""Streams that land topic records and payment requests into committed tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from spendwatch.operators.intake import check_payments, parse_intake
from spendwatch.operators.outbox import outbox_rows, payment_rows
from spendwatch.operators.quarantine import split_poison
from spendwatch.sinks.transactional import write_batch
from spendwatch.streaming.triggers import AVAILABLE_NOW, Trigger


def start_quarantine_split(records: DataFrame, schema: StructType, root: str, checkpoint: str,
                           required: tuple[str, ...] = (), trigger: Trigger = AVAILABLE_NOW) -> StreamingQuery:
    """Readable records to `records`, unreadable ones to `quarantine`; neither stops the stream."""

    def split(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good, bad = split_poison(batch, schema, required=required)
            write_batch(batch.sparkSession, root, batch_id, {"records": good, "quarantine": bad})
        finally:
            batch.unpersist()

    return (
        records.writeStream.queryName("quarantine_split").foreachBatch(split)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def accept_requests(requests: DataFrame, root: str, batch_id: int, key: str, accepted_at: Column) -> None:
    """One batch of request bodies: `payments` and `outbox` rows together, plus `rejected`."""
    # Parsed once for all three tables; `accepted_at` must be one instant, not an expression that each table evaluates.
    checked = check_payments(parse_intake(requests)).withColumn("_at", accepted_at).persist()
    try:
        payments = payment_rows(checked.where("accepted"), key, "_at")
        rejected = checked.where("NOT accepted").select(*requests.columns, "reject_reasons")
        write_batch(requests.sparkSession, root, batch_id, {
            "payments": payments, "outbox": outbox_rows(payments), "rejected": rejected})
    finally:
        checked.unpersist()


def _now() -> Column:
    return F.lit(dt.datetime.now(dt.timezone.utc))


def start_intake(requests: DataFrame, root: str, checkpoint: str, key: str = "request_id",
                 trigger: Trigger = AVAILABLE_NOW) -> StreamingQuery:
    """Requests (JSON in `value`, a request key in `key`) to payments and outbox, atomically."""
    return (
        requests.writeStream.queryName("intake")
        .foreachBatch(lambda batch, batch_id: accept_requests(batch, root, batch_id, key, _now()))
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
