"""Outbox relay and the two-topic publication of processed payments.

Each poll leaves three snapshots beside what it sent: the rows still pending, the end offset of each topic partition, and
the outbox batch up to which arrivals have been taken. The next poll opens these and the outbox batches that came
since, so its cost follows what is pending, not how long the relay has run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from spendwatch import schemas, settings
from spendwatch.operators.numbering import dense_offsets, next_ends, staged_in_order
from spendwatch.operators.outbox import next_page, pending, published_marks
from spendwatch.sinks.topics import relay_records
from spendwatch.sinks.transactional import CREATE, create_tables, is_committed, write_batch
from spendwatch.sources.tables import committed_after, last_committed, read_batches, read_snapshot, read_table

MARKS = StructType([
    StructField("id", StringType(), True), StructField("status", StringType(), True),
    StructField("published_at", TimestampType(), True)])
SENT = StructType([StructField("id", StringType(), True), *schemas.ENVELOPE.fields])
ENDS = StructType([
    StructField("topic", StringType(), True), StructField("partition", IntegerType(), True),
    StructField("end_offset", LongType(), True)])
TAKEN = StructType([StructField("outbox_batch", LongType(), True)])


# Folders of the sent records, so that a reader of one topic lists that topic only.
LAYOUT = {"sent": ["topic", "partition"]}


def create(spark: SparkSession, relay_root: str) -> None:
    create_tables(spark, relay_root, {
        "marks": MARKS, "sent": SENT, "pending": schemas.OUTBOX, "ends": ENDS, "taken": TAKEN}, LAYOUT)


def open_rows(spark: SparkSession, outbox_root: str, relay_root: str, poll_id: int) -> tuple[DataFrame, int]:
    """What a poll may send: rows the poll before left pending, and pending rows of outbox batches committed since.

    Also the newest of these batches. Outbox batches are committed in the order of their numbers.
    """
    before = last_committed(spark, relay_root, poll_id)
    left = read_snapshot(spark, relay_root, "pending", schemas.OUTBOX, before)
    taken = read_snapshot(spark, relay_root, "taken", TAKEN, before).first()
    newest = taken.outbox_batch if taken else CREATE - 1
    arrived = committed_after(spark, outbox_root, newest)
    rows = pending(read_batches(spark, outbox_root, "outbox", schemas.OUTBOX, arrived))
    return left.unionByName(rows), max([newest, *(n for n, _ in arrived)])


def relay_once(spark: SparkSession, outbox_root: str, relay_root: str, poll_id: int,
               page: int | None = None) -> None:
    """One poll: send the oldest pending rows to the topic each names and mark them published.

    Records, marks, end offsets and what stays pending become visible together, so a poll that dies changes nothing. Offsets
    of a topic partition are dense and follow the rows' creation. Everything pending goes by default; `page` limits a
    poll to the oldest rows. A replay of a committed poll does nothing.
    """
    if is_committed(spark, relay_root, poll_id):
        return
    rows, newest = open_rows(spark, outbox_root, relay_root, poll_id)
    at = F.lit(dt.datetime.now(dt.timezone.utc))
    ends = read_snapshot(spark, relay_root, "ends", ENDS, last_committed(spark, relay_root, poll_id))
    sending = rows if page is None else next_page(rows, page)
    staged = staged_in_order(relay_records(sending, at), ("created_at", "id"))
    left = rows.limit(0) if page is None else rows.join(staged.select("id"), "id", "left_anti")
    write_batch(spark, relay_root, poll_id, {
        "sent": dense_offsets(staged, ends).select(*SENT.fieldNames()),
        "marks": published_marks(staged, at),
        "ends": next_ends(staged, ends),
        "pending": left.select(*schemas.OUTBOX.fieldNames()),
        "taken": spark.createDataFrame([(newest,)], TAKEN),
    }, LAYOUT)


def sent_topic(spark: SparkSession, relay_root: str, topic: str) -> DataFrame:
    """The committed records of one topic that the relay has sent, as `sources.topics` gives them; reads its folders only."""
    rows = read_table(spark, relay_root, "sent", SENT).where(F.col("topic") == topic)
    return rows.select(*schemas.ENVELOPE.fieldNames())


def publish_processed(processed: DataFrame, balances: DataFrame, root: str, batch_id: int) -> None:
    """Processed events and balance updates: readers see both or neither."""
    write_batch(processed.sparkSession, root, batch_id, {
        settings.TOPIC_PROCESSED: processed, settings.TOPIC_BALANCES: balances})
