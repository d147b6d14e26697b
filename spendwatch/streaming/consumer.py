"""Idempotent consumer with retries and dead letters, as a micro-batch function over committed tables.

Tables: `attempts` and `dead_letter` (append-only logs), and the ledger of processed keys and the queue of waiting payments
(`streaming.ledger`), of which a batch opens the hours, minutes and key buckets it needs: its cost follows its own
payments and what has become due, not how long the consumer has run or how many payments wait. A batch that is
committed is not run again. Copies of one key collapse map side before any shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from spendwatch import schemas, settings
from spendwatch.functions.identifiers import dedup_key
from spendwatch.functions.times import interval
from spendwatch.operators.dedup import idempotent_first, ledger_rows
from spendwatch.operators.retry import dead_letters, retry_state
from spendwatch.sinks.transactional import create_tables, is_committed, write_batch
from spendwatch.streaming.ledger import CALENDAR, TABLES, WAITING, Memory, bucket
from spendwatch.streaming.triggers import AVAILABLE_NOW, Trigger

# Takes payments, returns them with error_class and exception_message (both null on success).
Handler = Callable[[DataFrame], DataFrame]


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


class PaymentConsumer:
    """Process each payment once; failed ones come back after a delay, then end as dead letters.

    `use_ledger=False` is for input that `streaming.dedup` has already freed of repeated deliveries: the
    ledger is then only written.
    """

    def __init__(self, spark: SparkSession, root: str, payment_schema: StructType, handler: Handler,
                 ttl: str = settings.DEDUP_TTL, max_attempts: int = settings.MAX_ATTEMPTS,
                 delay_seconds: int = settings.RETRY_DELAY_SECONDS,
                 multiplier: int = settings.RETRY_MULTIPLIER, use_ledger: bool = True,
                 now: Callable[[], dt.datetime] = _utc_now):
        self.spark, self.root, self.handler, self.now = spark, root, handler, now
        self.payment_schema, self.use_ledger = payment_schema, use_ledger
        self.schedule = {
            "max_attempts": max_attempts, "delay_seconds": delay_seconds, "multiplier": multiplier}
        waits = [delay_seconds * multiplier**n for n in range(max(max_attempts - 1, 1))]
        self.longest_wait = int(max(waits) * 1_000_000)
        epoch = F.timestamp_micros(F.lit(0).cast("long"))
        self.ttl_micros = spark.range(1).select(F.unix_micros(epoch + interval(ttl))).first()[0]

    def create(self) -> None:
        create_tables(self.spark, self.root, {
            "attempts": schemas.ATTEMPTS, "dead_letter": schemas.DEAD_LETTER, **TABLES}, calendar=CALENDAR)

    def memory(self, batch_id: int) -> Memory:
        return Memory.load(self.spark, self.root, batch_id, round(self.now().timestamp() * 1_000_000))

    def known_keys(self, memory: Memory, buckets: list[int]) -> DataFrame:
        """Keys of these buckets that a delivery must not start again: processed within the ttl, or waiting."""
        waiting = memory.waiting_keys(self.longest_wait, buckets)
        if not self.use_ledger:
            return waiting
        return waiting.unionByName(memory.processed(memory.at - self.ttl_micros, buckets))

    def _fresh(self, batch: DataFrame, memory: Memory, due: DataFrame) -> DataFrame:
        """First deliveries of payments that are neither processed already nor waiting for a retry."""
        columns = self.payment_schema.fieldNames()
        first = idempotent_first(batch.select(*columns)).withColumn("message_key", dedup_key(F.col("payment_id"))).persist()
        try:
            buckets = sorted(r.bucket for r in first.select(bucket(F.col("message_key")).alias("bucket")).distinct().collect())
            fresh = first.join(self.known_keys(memory, buckets), "message_key", "left_anti").join(
                due.select("payment_id"), "payment_id", "left_anti")
            # The handler reads the result once; it is fixed here, with the batch's keys still held.
            path = f"{self.root}/fresh/at={memory.at}"
            fresh.select(*columns).write.mode("overwrite").parquet(path)
        finally:
            first.unpersist()
        return self.spark.read.schema(self.payment_schema).parquet(path).withColumn("earlier_attempts", F.lit(0))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Handle the batch's new payments and the retries that are due; batch ids rise."""
        if is_committed(self.spark, self.root, batch_id):
            return
        memory = self.memory(batch_id)
        # A literal instant: all outputs of the batch agree on the time.
        at = memory.instant
        columns = self.payment_schema.fieldNames()
        due = memory.due()
        again = due.select(
            F.from_json("payload", self.payment_schema).alias("_p"), F.col("attempt").alias("earlier_attempts"))
        tries = self._fresh(batch, memory, due).unionByName(again.select("_p.*", "earlier_attempts"))

        # The handler's result feeds several tables, so it is written once and read back.
        outcomes_path = f"{self.root}/outcomes/batch_id={batch_id}"
        self.handler(tries).write.mode("overwrite").parquet(outcomes_path)
        outcomes = self.spark.read.parquet(outcomes_path)

        def original(name: str, kind: str, otherwise: Column | None = None) -> Column:
            known = F.col(name) if name in columns else F.lit(None) if otherwise is None else otherwise
            return known.cast(kind).alias(f"original_{name}")

        tried = outcomes.select(
            "payment_id",
            (F.col("earlier_attempts") + 1).alias("attempt"),
            at.alias("failed_at"),
            "error_class", "exception_message",
            original("topic", "string", F.lit(settings.TOPIC_INITIATED)),
            original("partition", "int"), original("offset", "long"),
            original("key", "string", F.col("user_id") if "user_id" in columns else None),
            F.to_json(F.struct(*columns)).alias("payload"),
        )
        # First-time successes need no attempt row; a success after failures closes the payment.
        logged = tried.where(F.col("error_class").isNotNull() | (F.col("attempt") > 1))
        state = retry_state(logged, **self.schedule)
        done = outcomes.where(F.col("error_class").isNull()).withColumn("_at", at)
        failed = state.where("disposition = 'retry'").select(*WAITING.fieldNames())
        write_batch(self.spark, self.root, batch_id, {
            "attempts": logged,
            "dead_letter": dead_letters(state).drop("disposition"),
            **memory.tables(ledger_rows(done, ts="_at"), failed, self.ttl_micros, self.longest_wait),
        }, calendar=CALENDAR)

    def start(self, payments: DataFrame, checkpoint: str, trigger: Trigger = AVAILABLE_NOW,
              heartbeat: bool = False) -> StreamingQuery:
        """Run over a stream of payments. With `heartbeat` a row a second joins the stream and is dropped again, so
        that a due retry runs even if no payment arrives; it needs a trigger that runs on."""
        stream = payments.withColumn("_beat", F.lit(False))
        if heartbeat:
            beats = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in payments.schema.fields]
            stream = stream.unionByName(beats.select(*nothing, F.lit(True).alias("_beat")))

        def run(batch: DataFrame, batch_id: int) -> None:
            self.process(batch.where("NOT _beat").drop("_beat"), batch_id)

        return (
            stream.writeStream.queryName("payment_consumer").foreachBatch(run)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start()
        )
