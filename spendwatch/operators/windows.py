"""Spend per user and event-time window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spendwatch import settings
from spendwatch.functions.times import interval
from spendwatch.operators import late, ordered
from spendwatch.operators.dedup import idempotent_first

GROUP = ["user_id", "window_start"]


def with_window_start(df: DataFrame, ts: str = "record_ts", size: str = settings.WINDOW,
                      slide: str | None = None) -> DataFrame:
    """Add the start of the epoch-aligned [start, end) window; a slide multiplies rows by size / slide.

    The end follows from the start, so it is added after aggregation and never shuffled.
    """
    return df.withColumn("_w", F.window(ts, size, slide)).withColumn("window_start", F.col("_w.start")).drop("_w")


def with_window_end(df: DataFrame, size: str) -> DataFrame:
    return df.withColumn("window_end", F.col("window_start") + interval(size))


def window_spend(
    payments: DataFrame,
    ts: str = "record_ts",
    size: str = settings.WINDOW,
    grace: str | None = None,
    slide: str | None = None,
    drop_late: bool = False,
    closed_only: bool = False,
    dedup: bool = False,
) -> DataFrame:
    """Total and payment count per user and window.

    The sum combines map side, so a user holding most of the rows costs one row per task and window.
    Payments without a user are left out, as keyed aggregation of a stream does.
    `drop_late` applies the per-record grace rule first, `closed_only` keeps windows the newest record
    has closed, `dedup` counts each payment once.
    """
    sums = (
        counted_rows(payments, ts, size, grace, slide, drop_late, dedup)
        .groupBy(*GROUP)
        .agg(F.sum("amount").alias("total"), F.count(F.lit(1)).alias("payments"))
    )
    spend = with_window_end(sums, size).select(*GROUP, "window_end", "total", "payments")
    return closed_windows(spend, payments, ts, grace) if closed_only else spend


def counted_rows(payments: DataFrame, ts: str, size: str, grace: str | None, slide: str | None, drop_late: bool,
                 dedup: bool) -> DataFrame:
    """The payments that windows count, with their window starts. Sums and id lists both start from these rows."""
    rows = idempotent_first(payments, "payment_id").drop("deliveries") if dedup else payments
    if drop_late:
        rows = late.late_drop(rows, ts, size, grace or settings.GRACE)
    return with_window_start(rows.dropna(subset=["user_id"]), ts, size, slide)


def closed_windows(spend: DataFrame, payments: DataFrame, ts: str = "record_ts", grace: str | None = None) -> DataFrame:
    newest = payments.agg(F.max(ts)).scalar()
    return spend.where(F.col("window_end") + interval(grace or settings.GRACE) <= newest)


def id_list(ts: str = "record_ts") -> Column:
    """Aggregate: the payments of a group in the order of time, partition and offset."""
    return F.sort_array(F.collect_list(F.struct(F.col(ts).alias("record_ts"), "partition", "offset", "payment_id")))


def spend_blocks(
    payments: DataFrame,
    ts: str = "record_ts",
    size: str = settings.WINDOW,
    grace: str | None = None,
    slide: str | None = None,
    drop_late: bool = False,
    dedup: bool = False,
    block_offsets: int = settings.ID_BLOCK_OFFSETS,
) -> DataFrame:
    """Total, count and payment ids per user, window and block of offsets, in one aggregation.

    A block spreads a hot user's window over tasks and bounds the list of a row: at most `block_offsets` ids
    for each topic partition. Blocks always exist; how many a window has changes no other column.
    """
    rows = counted_rows(payments, ts, size, grace, slide, drop_late, dedup)
    return rows.groupBy(*GROUP, ordered.offset_block("offset", block_offsets).alias("block")).agg(
        F.sum("amount").alias("block_total"), F.count(F.lit(1)).alias("block_payments"), id_list(ts).alias("ids"))


def spend_of_blocks(blocks: DataFrame, size: str = settings.WINDOW) -> DataFrame:
    """The rows of `window_spend` from blocks."""
    sums = blocks.groupBy(*GROUP).agg(
        F.sum("block_total").alias("total"), F.sum("block_payments").alias("payments"))
    return with_window_end(sums, size).select(*GROUP, "window_end", "total", "payments")


def payment_id_blocks(windows: DataFrame, blocks: DataFrame) -> DataFrame:
    """The id table of some windows: one row per user, window and block, ids in order."""
    return blocks.select(*GROUP, "block", "ids").join(windows.select(*GROUP), GROUP, "left_semi")


def with_payment_ids(windows: DataFrame, id_blocks: DataFrame) -> DataFrame:
    """Windows with their whole id list in one array, in the order of time, partition and offset.

    One row then holds all ids of a window: ask for it where windows are known to be small, and read the id table
    otherwise.
    """
    lists = id_blocks.groupBy(*GROUP).agg(F.sort_array(F.flatten(F.collect_list("ids"))).alias("_ids"))
    return windows.join(lists, GROUP).withColumn("triggering_payment_ids", F.col("_ids.payment_id")).drop("_ids")


def early_signal(
    payments: DataFrame,
    threshold: str = settings.RISK_THRESHOLD,
    ts: str = "record_ts",
    size: str = settings.WINDOW,
    block: str | None = None,
    block_rows: int = settings.SIGNAL_BLOCK_ROWS,
) -> DataFrame:
    """Running total at each payment, before its window closes, and whether it is over the threshold.

    Payments follow each other by time, then partition, then offset: offsets of different partitions cannot be compared.
    A window is cut into blocks of about `block_rows` payments, however they crowd in time, or into spans of `block`.
    """
    rows = with_window_start(payments.dropna(subset=["user_id"]), ts, size)
    columns = rows.columns
    if block is None:
        rows = ordered.even_blocks(rows, GROUP, (ts, "partition", "offset"), block_rows, "_cut")
    else:
        rows = rows.withColumn("_cut", F.window(ts, block)["start"])
    totals = ordered.running(
        rows, GROUP, "amount", "running_total", position=ts, ties=("partition", "offset"), block=F.col("_cut"))
    limit = F.lit(threshold).cast("decimal(18,2)")
    return totals.select(*columns, "running_total").withColumn("over_threshold", F.col("running_total") > limit)
