"""Alerts with the exact rule for late records, whatever the micro-batches are.

Spark's own watermark moves after a micro-batch and over all partitions. Here each micro-batch judges its records one by one:
a record is late if its window had closed when it arrived, by the newest time that its topic partition had shown up to
then. What earlier batches have shown is a table of one row per partition. Open windows wait as blocks (sums and
payment ids, `operators.windows`) in a second table. Both are committed with the batch's alerts, so a batch that dies
changes nothing, and a replay of a committed one does nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from spendwatch import schemas, settings
from spendwatch.functions.times import interval
from spendwatch.operators import late
from spendwatch.operators.windows import GROUP, spend_blocks
from spendwatch.sinks.topics import alert_records
from spendwatch.sinks.transactional import create_tables, is_committed, write_batch
from spendwatch.sources.tables import last_committed, read_snapshot
from spendwatch.streaming.alerts import alerts_from_blocks
from spendwatch.streaming.triggers import AVAILABLE_NOW, Trigger

TIMES = StructType([
    StructField("topic", StringType(), True), StructField("partition", IntegerType(), True),
    StructField("newest", TimestampType(), True)])
_IDS = schemas.ALERT_PAYMENT_IDS["ids"]
OPEN_BLOCKS = StructType([
    *(schemas.ALERT_PAYMENT_IDS[c] for c in ("user_id", "window_start", "block")),
    StructField("block_total", schemas.ALERTS["total_amount"].dataType, True),
    StructField("block_payments", LongType(), True), _IDS])
LATE = StructType([
    *(schemas.ENVELOPE[c] for c in ("topic", "partition", "offset", "record_ts")), schemas.PAYMENTS_INITIATED["payment_id"],
    StructField("stream_time", TimestampType(), True)])


def merged_blocks(blocks: DataFrame, more: DataFrame) -> DataFrame:
    """Blocks of the same user, window and offsets as one; ids stay in order."""
    both = blocks.select(*OPEN_BLOCKS.fieldNames()).unionByName(more.select(*OPEN_BLOCKS.fieldNames()))
    return both.groupBy(*GROUP, "block").agg(
        F.sum("block_total").alias("block_total"), F.sum("block_payments").alias("block_payments"),
        F.sort_array(F.flatten(F.collect_list("ids"))).alias("ids"))


class ExactAlerts:
    """Payments (with topic, partition and offset, in order of offset inside a partition) -> graded alerts.

    A window closes once every partition seen has passed its end plus the grace: from then on each record of it is
    late, so one alert row is final. `all_partitions=False` closes it by the newest record of any partition, as
    `operators.windows.closed_windows` does; use it where partitions may fall silent. Records that a slower partition
    then still brings for a window that is closed are late too.
    """

    def __init__(self, spark: SparkSession, root: str, threshold: str = settings.RISK_THRESHOLD, ts: str = "record_ts",
                 size: str = settings.WINDOW, grace: str = settings.GRACE, all_partitions: bool = True,
                 block_offsets: int = settings.ID_BLOCK_OFFSETS):
        self.spark, self.root, self.threshold, self.ts = spark, root, threshold, ts
        self.size, self.grace, self.all_partitions, self.block_offsets = size, grace, all_partitions, block_offsets

    def create(self) -> None:
        create_tables(self.spark, self.root, {
            "stream_times": TIMES, "open_blocks": OPEN_BLOCKS, "late_records": LATE, "alerts": schemas.ALERTS,
            "alert_payment_ids": schemas.ALERT_PAYMENT_IDS})

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Judge, sum and close; batch ids rise."""
        if is_committed(self.spark, self.root, batch_id):
            return
        before = last_committed(self.spark, self.root, batch_id)
        carry = read_snapshot(self.spark, self.root, "stream_times", TIMES, before)
        waiting = read_snapshot(self.spark, self.root, "open_blocks", OPEN_BLOCKS, before)
        rows = batch if "topic" in batch.columns else batch.withColumn("topic", F.lit(settings.TOPIC_INITIATED))
        flagged = late.flag_late(rows, self.ts, self.size, self.grace, carry=carry)
        if not self.all_partitions:
            gone = carry.agg(F.max("newest")).scalar() - interval(self.grace)
            flagged = flagged.withColumn(
                "late", F.col("late") | F.coalesce(F.window(self.ts, self.size)["end"] <= gone, F.lit(False)))
        flagged = flagged.persist()
        try:
            times = late.newest_times(rows, carry, self.ts).persist()
            reached = (F.min if self.all_partitions else F.max)("newest")
            passed = times.agg((reached - interval(self.grace)).alias("passed")).first().passed
            new = spend_blocks(flagged.where(~F.col("late")), self.ts, self.size, block_offsets=self.block_offsets)
            blocks = merged_blocks(waiting, new).persist()
            closed = F.lit(False) if passed is None else F.col("window_start") + interval(self.size) <= F.lit(passed)
            alerts, ids = alerts_from_blocks(blocks.where(closed), self.threshold, self.size)
            dropped = flagged.where("late").withColumn("record_ts", F.col(self.ts))
            write_batch(self.spark, self.root, batch_id, {
                "alerts": alerts, "alert_payment_ids": ids, settings.TOPIC_ALERTS: alert_records(alerts),
                "late_records": dropped.select(*[F.col(f.name).cast(f.dataType) for f in LATE.fields]),
                "stream_times": times.select(*TIMES.fieldNames()),
                "open_blocks": blocks.where(~closed).select(
                    *[F.col(f.name).cast(f.dataType) for f in OPEN_BLOCKS.fields]),
            })
            blocks.unpersist()
            times.unpersist()
        finally:
            flagged.unpersist()

    def start(self, payments: DataFrame, checkpoint: str, trigger: Trigger = AVAILABLE_NOW) -> StreamingQuery:
        return (
            payments.writeStream.queryName("exact_alerts").foreachBatch(self.process)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start()
        )
