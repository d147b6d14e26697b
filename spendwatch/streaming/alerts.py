"""Windowed alerts and early signals as streams.

Spark drops late rows per micro-batch by the watermark of the batch before, over all partitions, so
on one partition it never drops earlier than the exact per-record rule of `operators.late`. The
watermark delay has to cover the time skew between partitions. A closed window is emitted once, and
only after newer data has moved the watermark past its end plus the grace.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from spendwatch import schemas, settings
from spendwatch.operators.alerts import risk_alerts
from spendwatch.operators.ordered import offset_block
from spendwatch.operators.windows import id_list, payment_id_blocks, spend_of_blocks
from spendwatch.sinks.topics import alert_records
from spendwatch.sinks.transactional import write_batch
from spendwatch.streaming.triggers import AVAILABLE_NOW, Trigger


def window_spend_stream(payments: DataFrame, ts: str = "record_ts", size: str = settings.WINDOW,
                        grace: str = settings.GRACE, slide: str | None = None) -> DataFrame:
    """Total and count per user and window; append mode emits each window once, when it closes,
    update mode emits it after every micro-batch that touched it."""
    return (
        payments.dropna(subset=["user_id"]).withWatermark(ts, grace)
        .groupBy(F.window(ts, size, slide).alias("_w"), "user_id")
        .agg(F.sum("amount").alias("total"), F.count(F.lit(1)).alias("payments"))
        .select("user_id", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                "total", "payments")
    )


def spend_blocks_stream(payments: DataFrame, ts: str = "record_ts", size: str = settings.WINDOW,
                        grace: str = settings.GRACE, slide: str | None = None, dedup: bool = False,
                        block_offsets: int = settings.ID_BLOCK_OFFSETS) -> DataFrame:
    """The rows of `operators.windows.spend_blocks` as a stream; late rows go by the watermark.

    The block spreads a hot user over the state partitions and bounds the id list of one state row. `dedup` counts each
    payment id once, as far back as the watermark reaches.
    """
    rows = payments.dropna(subset=["user_id"]).withWatermark(ts, grace)
    if dedup:
        rows = rows.dropDuplicatesWithinWatermark(["payment_id"])
    return (
        rows.groupBy(F.window(ts, size, slide).alias("_w"), "user_id",
                     offset_block("offset", block_offsets).alias("block"))
        .agg(F.sum("amount").alias("block_total"), F.count(F.lit(1)).alias("block_payments"), id_list(ts).alias("ids"))
        .select("user_id", F.col("_w.start").alias("window_start"), "block", "block_total", "block_payments", "ids")
    )


def alerts_from_blocks(blocks: DataFrame, threshold: str = settings.RISK_THRESHOLD,
                       size: str = settings.WINDOW) -> tuple[DataFrame, DataFrame]:
    """Alerts of the windows a micro-batch closed, one row each, and their id table.

    All blocks of a window close in the same micro-batch, because they share the window's end.
    """
    alerts = risk_alerts(spend_of_blocks(blocks, size), threshold).withColumn(
        "alert_generated_ts", F.lit(dt.datetime.now(dt.timezone.utc)))
    return (alerts.select(*[F.col(f.name).cast(f.dataType) for f in schemas.ALERTS.fields]),
            payment_id_blocks(alerts, blocks))


def start_alerts(payments: DataFrame, root: str, checkpoint: str,
                 threshold: str = settings.RISK_THRESHOLD, ts: str = "record_ts",
                 size: str = settings.WINDOW, grace: str = settings.GRACE, slide: str | None = None,
                 dedup: bool = False, block_offsets: int = settings.ID_BLOCK_OFFSETS,
                 trigger: Trigger = AVAILABLE_NOW) -> StreamingQuery:
    """Stream of graded alerts into the committed tables `alerts`, `alert_payment_ids` and, as records keyed by user, the
    alert topic."""

    def emit(blocks: DataFrame, batch_id: int) -> None:
        blocks.persist()
        try:
            alerts, ids = alerts_from_blocks(blocks, threshold, size)
            write_batch(blocks.sparkSession, root, batch_id, {
                "alerts": alerts, "alert_payment_ids": ids, settings.TOPIC_ALERTS: alert_records(alerts)})
        finally:
            blocks.unpersist()

    return (
        spend_blocks_stream(payments, ts, size, grace, slide, dedup, block_offsets)
        .writeStream.queryName("alerts").outputMode("append").foreachBatch(emit)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def start_early_signals(payments: DataFrame, root: str, checkpoint: str,
                        threshold: str = settings.RISK_THRESHOLD, ts: str = "record_ts",
                        size: str = settings.WINDOW, grace: str = settings.GRACE,
                        trigger: Trigger = AVAILABLE_NOW) -> StreamingQuery:
    """Running totals of open windows after each micro-batch into the committed table `early_signals`."""

    def emit(changed: DataFrame, batch_id: int) -> None:
        limit = F.lit(threshold).cast("decimal(18,2)")
        signals = changed.withColumn("over_threshold", F.col("total") > limit)
        write_batch(changed.sparkSession, root, batch_id, {"early_signals": signals})

    return (
        window_spend_stream(payments, ts, size, grace)
        .writeStream.queryName("early_signals").outputMode("update").foreachBatch(emit)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
