"""Transactional outbox: build rows, poll, mark published, reconcile with the topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spendwatch import settings
from spendwatch.functions.identifiers import derived_uuid
from spendwatch.functions.times import to_millis


def payment_rows(requests: DataFrame, key: str, created_at: str = "record_ts") -> DataFrame:
    """Accepted requests -> payments rows; ids derive from the request key, so replays agree."""
    return requests.select(
        derived_uuid("payment", F.col(key)).alias("id"),
        "user_id", "merchant_id", "amount", "currency",
        F.lit(settings.INITIAL_STATUS).alias("status"),
        F.col(created_at).alias("created_at"),
    )


def event_payload() -> Column:
    """JSON mirror of a payments row."""
    return F.to_json(F.struct(
        F.col("id").alias("paymentId"),
        F.col("user_id").alias("userId"),
        F.col("merchant_id").alias("merchantId"),
        "amount",
        "currency",
        to_millis(F.col("created_at")).alias("initiatedTimestamp"),
    ))


def outbox_rows(payments: DataFrame, topic: str = settings.TOPIC_INITIATED) -> DataFrame:
    """One pending outbox row per payments row."""
    return payments.select(
        derived_uuid("outbox", F.col("id")).alias("id"),
        F.lit(settings.AGGREGATE_TYPE).alias("aggregate_type"),
        F.col("id").alias("aggregate_id"),
        F.lit(settings.EVENT_TYPE).alias("event_type"),
        event_payload().alias("payload"),
        F.lit(topic).alias("kafka_topic"),
        F.col("user_id").alias("kafka_key"),
        F.lit("PENDING").alias("status"),
        "created_at",
        F.lit(None).cast("timestamp").alias("published_at"),
    )


def pending(outbox: DataFrame) -> DataFrame:
    return outbox.where(F.col("status") == "PENDING")


def next_page(outbox: DataFrame, page: int = settings.OUTBOX_PAGE) -> DataFrame:
    """Oldest pending rows of one poll; the id makes the order total."""
    return pending(outbox).orderBy("created_at", "id").limit(page)


def signalled(outbox: DataFrame, signals: DataFrame) -> DataFrame:
    """Rows named by commit signals (column `id`) that are still pending."""
    return pending(outbox).join(signals.select("id"), "id", "left_semi")


def published_marks(sent: DataFrame, at: Column) -> DataFrame:
    """Status changes for rows that were sent; rows that failed to send get none and stay pending."""
    return sent.select("id", F.lit("PUBLISHED").alias("status"), at.alias("published_at"))


def current_outbox(outbox: DataFrame, marks: DataFrame) -> DataFrame:
    """Outbox with its status log applied: the latest mark per id wins."""
    latest = (
        marks.groupBy("id")
        .agg(F.max(F.struct("published_at", "status")).alias("_mark"))
        .select("id", "_mark")
    )
    return (
        outbox.drop("published_at").withColumnRenamed("status", "_status")
        .join(latest, "id", "left")
        .withColumn("status", F.coalesce(F.col("_mark.status"), F.col("_status")))
        .withColumn("published_at", F.col("_mark.published_at"))
        .drop("_mark", "_status")
    )


def reconcile(outbox: DataFrame, sent: DataFrame, as_of: Column) -> DataFrame:
    """Compare outbox rows with the topic's records (column `id`), listing every disagreement.

    Copies are counted before the join, so a record published very often is one row by then.
    """
    copies = sent.groupBy(F.col("id").alias("_sent_id")).agg(F.count(F.lit(1)).alias("_copies"))
    both = outbox.join(copies, F.col("id") == F.col("_sent_id"), "full_outer")
    copies_seen = F.coalesce(F.col("_copies"), F.lit(0))
    issue = (
        F.when(F.col("id").isNull(), "not_in_outbox")
        .when(copies_seen > 1, "published_twice")
        .when((F.col("status") == "PUBLISHED") & (copies_seen == 0), "missing_on_topic")
        .when((F.col("status") == "PENDING") & (copies_seen == 1), "sent_not_marked")
        .when(F.col("status") == "PENDING", "pending")
    )
    age = F.unix_seconds(as_of) - F.unix_seconds("created_at")
    return both.select(
        F.coalesce("id", "_sent_id").alias("id"),
        issue.alias("issue"),
        copies_seen.alias("copies"),
        F.when(F.col("status") == "PENDING", age).alias("pending_seconds"),
    ).where(F.col("issue").isNotNull())
