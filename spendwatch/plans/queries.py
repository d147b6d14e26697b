"""One registered query per operator group, each over the whole tables.

Money is exact decimal inside the operators; results show it in whole cents and instants as zone-free
timestamps, so that any client compares them exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spendwatch import schemas, settings
from spendwatch.functions.identifiers import dedup_key
from spendwatch.operators import (
    alerts, commits, compatibility, dedup, evolution, intake, landing, late, numbering, outbox, partitioning,
    progress, quarantine, retry, upkeep, windows)
from spendwatch.plans import views
from spendwatch.sinks import topics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}



def at(instant: str) -> Column:
    return F.lit(instant).cast("timestamp")



def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _shown(fn(spark, sf_dir))
        QUERIES[name] = run
        return run
    return register


def _shown(df: DataFrame) -> DataFrame:
    shown = []
    for field in df.schema.fields:
        column, kind = F.col(field.name), field.dataType.typeName()
        if kind == "decimal":
            column = (column * 100).cast("bigint")
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind == "array":
            column = F.array_join(column, ",")
        shown.append(column.alias(field.name))
    return df.select(*shown)


@query("q01_intake_validate")
def intake_validate(spark, sf_dir):
    checked = intake.check_payments(intake.parse_intake(views.requests(spark, sf_dir)))
    return checked.select("request_id", "accepted", "reject_reasons")


@query("q02_payment_rows")
def payment_table(spark, sf_dir):
    return outbox.payment_rows(views.payments(spark, sf_dir), "offset")


@query("q02_outbox_envelope")
def outbox_envelope(spark, sf_dir):
    rows = outbox.outbox_rows(outbox.payment_rows(views.payments(spark, sf_dir), "offset"))
    payload = F.from_json("payload", schemas.EVENT_JSON)
    return rows.withColumn("_p", payload).drop("payload", "published_at").select(
        "*", F.col("_p.paymentId").alias("payload_payment_id"), F.col("_p.userId").alias("payload_user_id"),
        F.col("_p.merchantId").alias("payload_merchant_id"), F.col("_p.amount").alias("payload_amount"),
        F.col("_p.currency").alias("payload_currency"),
        F.col("_p.initiatedTimestamp").alias("payload_initiated_millis"),
    ).drop("_p")


@query("q03_outbox_relay_batch")
def outbox_relay_batch(spark, sf_dir):
    return outbox.next_page(views.outbox(spark, sf_dir)).select(
        "id", "kafka_topic", "kafka_key", "payload", "created_at")


@query("q03_outbox_signalled")
def outbox_signalled(spark, sf_dir):
    signals = views.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"))
    return outbox.signalled(views.outbox(spark, sf_dir), signals).select("id", "kafka_topic", "created_at")


@query("q04_outbox_state")
def outbox_state(spark, sf_dir):
    sent = views.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_shipdate").alias("at"))
    marks = outbox.published_marks(sent, F.col("at"))
    return outbox.current_outbox(views.outbox(spark, sf_dir), marks).select("id", "status", "published_at")


@query("q04_outbox_reconcile")
def outbox_reconcile(spark, sf_dir):
    # Every line is a record. Its order and line number make up the id it was sent under, so some ids were sent
    # once, some more often, some never, and some belong to no order.
    sent = views.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 2 - F.col("l_linenumber") * 3).alias("id"))
    return outbox.reconcile(views.outbox(spark, sf_dir), sent, at("2001-08-02 00:00:00"))


@query("q05_typed_landing")
def typed_landing(spark, sf_dir):
    good, _ = landing.typed_landing(*views.raw_records(spark, sf_dir))
    return good.withColumn("metadata", F.element_at("metadata", "k"))


@query("q05_landing_quarantine")
def landing_quarantine(spark, sf_dir):
    _, bad = landing.typed_landing(*views.raw_records(spark, sf_dir))
    return bad.select("payment_id", "offset", "poison_reason")


@query("q06_quarantine_split")
def quarantine_split(spark, sf_dir):
    body = F.to_json(F.struct(
        F.col("payment_id").alias("paymentId"),
        F.when(~views.every(23), F.col("user_id")).alias("userId"), "amount"))
    value = (
        F.when(views.every(41), F.lit(None)).when(views.every(13), "garbage-payload")
        .when(views.every(19), F.expr("substring(body, 1, length(body) - 1)")).otherwise(F.col("body")))
    records = views.payments(spark, sf_dir).withColumn("body", body).withColumn("value", value)
    parsed = quarantine.parse_json(
        records.select("offset", "value"), schemas.EVENT_JSON, required=("paymentId", "userId"))
    return parsed.select(
        "offset", F.col("poison_reason").isNull().alias("readable"),
        F.coalesce("poison_reason", F.lit("")).alias("reason"),
        F.col("record.paymentId").alias("payment_id"), F.col("record.amount").alias("amount"))


@query("q07_partition_assign")
def partition_assign(spark, sf_dir):
    rows = views.payments(spark, sf_dir).withColumn("amount", F.when(~views.every(97), F.col("amount")))
    coded = partitioning.assign_partition(rows, high=views.HIGH, into="coded_partition")
    both = partitioning.assign_partition(coded, high=views.HIGH, mode="kafka", into="kafka_partition")
    return both.select(
        "payment_id", "user_id", "coded_partition", "kafka_partition",
        partitioning.is_high_value(F.col("amount"), views.HIGH).alias("high_value"))


@query("q08_partition_skew")
def partition_skew(spark, sf_dir):
    return partitioning.partition_skew(views.routed_payments(spark, sf_dir), high=views.HIGH)


@query("q09_idempotent_first")
def idempotent_first(spark, sf_dir):
    deliveries = views.redelivered(views.payments(spark, sf_dir))
    first = dedup.idempotent_first(deliveries)
    return first.select(
        dedup_key(F.col("payment_id")).alias("message_key"), "topic",
        F.col("record_ts").alias("processed_at"), "offset", "user_id", "amount", "deliveries")


@query("q10_idempotent_ttl")
def idempotent_ttl(spark, sf_dir):
    rows = views.payments(spark, sf_dir).withColumn("failed", F.col("event_type") == "error")
    return dedup.idempotent_ttl(rows, "user_id", failed="failed").select(
        "payment_id", "user_id", "record_ts", "outcome")


@query("q11_window_spend")
def window_spend(spark, sf_dir):
    return windows.window_spend(views.payments(spark, sf_dir))


@query("q11_window_payment_ids")
def window_payment_ids(spark, sf_dir):
    blocks = windows.spend_blocks(views.payments(spark, sf_dir), size="1 day")
    return windows.with_payment_ids(windows.spend_of_blocks(blocks, "1 day"), blocks)


def _alerts(rows: DataFrame, blocks: DataFrame, size: str = settings.WINDOW) -> DataFrame:
    """Alerts of closed windows with their ids; sums and ids come from the same blocks."""
    spend = windows.closed_windows(windows.spend_of_blocks(blocks, size), rows)
    graded = alerts.risk_alerts(spend, views.THRESHOLD)
    return windows.with_payment_ids(graded, windows.payment_id_blocks(graded, blocks))


@query("q12_high_risk_alerts")
def high_risk_alerts(spark, sf_dir):
    rows = views.payments(spark, sf_dir)
    return _alerts(rows, windows.spend_blocks(rows))


@query("q12_deduped_alerts")
def deduped_alerts(spark, sf_dir):
    rows = views.redelivered(views.payments(spark, sf_dir))
    return _alerts(rows, windows.spend_blocks(rows, size="1 day", dedup=True), "1 day")


@query("q12_alert_id_blocks")
def alert_id_blocks(spark, sf_dir):
    """The id table with blocks of 100 offsets, so that most alerts have several rows."""
    blocks = windows.spend_blocks(views.payments(spark, sf_dir), size="1 day", block_offsets=100)
    graded = alerts.risk_alerts(windows.spend_of_blocks(blocks, "1 day"), views.THRESHOLD)
    return windows.payment_id_blocks(graded, blocks).select(
        "user_id", "window_start", "block", F.col("ids.payment_id").alias("payment_ids"))


@query("q13_risk_level_summary")
def risk_level_summary(spark, sf_dir):
    spend = windows.window_spend(views.payments(spark, sf_dir))
    return alerts.risk_summary(alerts.risk_alerts(spend, views.THRESHOLD))


@query("q14_early_signal")
def early_signal(spark, sf_dir):
    rows = windows.early_signal(views.payments(spark, sf_dir), views.THRESHOLD, size="1 day")
    return rows.select("payment_id", "user_id", "window_start", "running_total", "over_threshold")


@query("q15_late_drop")
def late_drop(spark, sf_dir):
    rows = views.disordered(views.payments(spark, sf_dir))
    return late.flag_late(rows).select("payment_id", "record_ts", "stream_time", "late")


@query("q15_spend_without_late")
def spend_without_late(spark, sf_dir):
    rows = views.disordered(views.payments(spark, sf_dir))
    return windows.window_spend(rows, size="1 hour", grace="30 seconds", drop_late=True)


@query("q16_partition_split_audit")
def partition_split_audit(spark, sf_dir):
    return partitioning.partition_split_audit(views.routed_payments(spark, sf_dir), views.THRESHOLD, size="1 day")


@query("q17_retry_schedule")
def retry_schedule(spark, sf_dir):
    state = retry.retry_state(retry.all_attempts(*views.attempts(spark, sf_dir)))
    return state.select("payment_id", "attempt", "failed_at", "disposition", "next_attempt_at")


@query("q17_container_retry")
def container_retry(spark, sf_dir):
    state = retry.retry_state(retry.all_attempts(*views.attempts(spark, sf_dir)), multiplier=1)
    return retry.due_attempts(state, at("2024-01-15 00:00:00")).select(
        "payment_id", "attempt", "next_attempt_at")


@query("q17_dead_letters")
def dead_letter_rows(spark, sf_dir):
    return retry.dead_letters(retry.retry_state(retry.all_attempts(*views.attempts(spark, sf_dir))))


@query("q18_dead_letter_monitor")
def dead_letter_monitor(spark, sf_dir):
    dead = retry.dead_letters(retry.retry_state(retry.all_attempts(*views.attempts(spark, sf_dir))))
    return retry.dead_letter_monitor(dead, size="1 day", burst=3)


@query("q19_latest_by_key")
def latest_by_key(spark, sf_dir):
    return upkeep.latest_by_key(_balances(spark, sf_dir), "user_id", "balance", order=("offset",))


@query("q19_compacted_log")
def compacted_log(spark, sf_dir):
    log = upkeep.compact(_balances(spark, sf_dir), "user_id", "balance", at("2024-01-31 00:00:00"), order=("offset",))
    return log.select("user_id", "record_ts", "offset", F.col("balance").isNull().alias("tombstone"))


def _balances(spark, sf_dir):
    """Balance updates: each payment's amount, a tombstone for an error."""
    return views.payments(spark, sf_dir).select(
        "user_id", "record_ts", "offset",
        F.when(F.col("event_type") != "error", F.col("amount")).alias("balance"))


@query("q20_retention_time")
def retention_time(spark, sf_dir):
    return upkeep.retain_time(views.payments(spark, sf_dir), at("2024-01-31 00:00:00")).select("payment_id", "record_ts")


@query("q20_alert_retention")
def alert_retention(spark, sf_dir):
    graded = alerts.risk_alerts(windows.window_spend(views.payments(spark, sf_dir)), views.THRESHOLD)
    return upkeep.retain_time(
        graded, at("2024-02-10 00:00:00"), ts="window_end", max_age=settings.ALERT_RETENTION)


@query("q21_retention_bytes")
def retention_bytes(spark, sf_dir):
    rows = views.routed_payments(spark, sf_dir).withColumn(
        "bytes", F.octet_length("props") + F.octet_length("user_id"))
    kept = upkeep.retain_bytes(rows, "bytes", max_bytes=10_000)
    return kept.select("payment_id", "partition", "offset", "bytes")


@query("q22_read_committed")
def read_committed(spark, sf_dir):
    rows = views.payments(spark, sf_dir).withColumn("batch_id", F.floor(F.col("offset") / 100))
    processed = rows.select("batch_id", "payment_id", "user_id", F.lit("processed").alias("output"))
    balances = rows.select("batch_id", "payment_id", "user_id", F.lit("balance").alias("output"))
    # A batch whose marker record (its 50th) is an error died before its commit.
    markers = rows.where((F.col("offset") % 100 == 50) & (F.col("event_type") != "error"))
    return commits.read_committed(processed.unionByName(balances), markers)


@query("q23_schema_compat")
def schema_compat(spark, sf_dir):
    return compatibility.schema_verdict(views.field_catalog(spark, sf_dir), gathered=True)


@query("q23_schema_compat_strict")
def schema_compat_strict(spark, sf_dir):
    return compatibility.schema_verdict(views.field_catalog(spark, sf_dir), strict_types=True, gathered=True)


@query("q23_deleted_versions")
def deleted_versions(spark, sf_dir):
    """Every third version was deleted from the registry, so the one before may be further back."""
    left = views.field_catalog(spark, sf_dir).where("(subject + version) % 3 <> 0")
    return compatibility.schema_verdict(left, gathered=True)


@query("q24_evolved_read")
def evolved_read(spark, sf_dir):
    rows = views.payments(spark, sf_dir).withColumn("initiated_ts", F.col("record_ts"))
    v1 = rows.where(views.every(3)).select("payment_id", "user_id", "merchant_id", "amount", "initiated_ts")
    v2 = rows.where(~views.every(3)).withColumn(
        "currency", F.when(~views.every(10), F.lit("EUR"))).drop("metadata")
    return evolution.evolved_union([v1, v2], schemas.PAYMENTS_INITIATED).withColumn(
        "metadata", F.size(F.coalesce(F.map_keys("metadata"), F.array().cast("array<string>"))))


@query("q24_processed_defaults")
def processed_defaults(spark, sf_dir):
    rows = views.payments(spark, sf_dir).select(
        "payment_id", "user_id", "amount", F.col("record_ts").alias("processed_ts"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("APPROVED").alias("status"),
        F.when(F.col("event_type") == "error", "declined by issuer").alias("failure_reason"))
    return evolution.conform(rows, schemas.PAYMENTS_PROCESSED)


@query("q25_topic_counts")
def topic_counts(spark, sf_dir):
    return progress.topic_counts(views.routed_payments(spark, sf_dir))


@query("q26_consumer_lag")
def consumer_lag(spark, sf_dir):
    log = views.routed_payments(spark, sf_dir)
    return progress.consumer_lag(log, views.committed_offsets(log))


@query("q27_delivery_audit")
def delivery_audit(spark, sf_dir):
    accepted = views.payments(spark, sf_dir)
    delivered = views.redelivered(accepted.where(~views.every(97)))
    return progress.delivery_audit(accepted, delivered)


@query("q27_offset_gaps")
def offset_gaps(spark, sf_dir):
    log = views.payments(spark, sf_dir).withColumn("partition", F.lit(0))
    return progress.offset_gaps(log.where((F.col("event_type") != "error") & (F.col("amount") < 100)))


@query("q27_order_inversions")
def order_inversions(spark, sf_dir):
    rows = views.disordered(views.payments(spark, sf_dir))
    # A shift of 40 places rarely passes another record of the same user; five hot keys show many.
    return progress.order_inversions(rows, key="payment_method").select(
        "payment_id", "payment_method", "record_ts", "newest_before")


@query("q28_hopping_spend")
def hopping_spend(spark, sf_dir):
    return windows.window_spend(views.payments(spark, sf_dir), slide="1 minute")


@query("q27_user_inversions")
def user_inversions(spark, sf_dir):
    rows = views.disordered(views.payments(spark, sf_dir), places=2000)
    return progress.order_inversions(rows).select("payment_id", "user_id", "record_ts", "newest_before")


@query("q28_hopping_alerts")
def hopping_alerts(spark, sf_dir):
    blocks = windows.spend_blocks(views.payments(spark, sf_dir), slide="1 minute", block_offsets=500)
    graded = alerts.risk_alerts(windows.spend_of_blocks(blocks), views.THRESHOLD)
    return windows.with_payment_ids(graded, windows.payment_id_blocks(graded, blocks))


@query("q15_late_by_topic")
def late_by_topic(spark, sf_dir):
    """Two topics share partition numbers; each has a stream time of its own."""
    rows = views.disordered(views.payments(spark, sf_dir)).withColumn(
        "topic", F.when(views.every(3), F.lit("replayed")).otherwise(F.col("topic")))
    return late.flag_late(rows).select("payment_id", "topic", "stream_time", "late")


@query("q03_relay_offsets")
def relay_offsets(spark, sf_dir):
    """The outbox relayed in two polls: offsets of a topic partition are dense and follow the rows' creation."""
    rows = views.outbox(spark, sf_dir).where("kafka_key IS NOT NULL")
    records = topics.relay_records(rows, F.col("created_at")).withColumn(
        "partition", (F.col("key").cast("bigint") % 4).cast("int"))
    cut = at("1998-01-01 00:00:00")
    first = numbering.staged_in_order(records.where(F.col("created_at") < cut), ("created_at", "id"))
    nothing = spark.createDataFrame([], "topic string, partition int, end_offset bigint")
    ends = numbering.next_ends(first, nothing)
    second = numbering.staged_in_order(records.where(F.col("created_at") >= cut), ("created_at", "id"))
    both = numbering.dense_offsets(first, nothing).unionByName(numbering.dense_offsets(second, ends))
    return both.select("id", "topic", "partition", "offset")


@query("q15_late_in_batches")
def late_in_batches(spark, sf_dir):
    """The records in eight micro-batches; each judges its own, with the newest times of the batches before."""
    rows = views.disordered(views.payments(spark, sf_dir))
    end = rows.agg(F.max("offset")).first()[0] + 1
    flagged, carry = None, None
    for i in range(8):
        batch = rows.where((F.col("offset") >= i * end // 8) & (F.col("offset") < (i + 1) * end // 8))
        judged = late.flag_late(batch, carry=carry).select("payment_id", "stream_time", "late")
        flagged = judged if flagged is None else flagged.unionByName(judged)
        carry = late.newest_times(batch, carry)
    return flagged


@query("q18_monitor_deltas")
def monitor_deltas(spark, sf_dir):
    """Dead letters counted in five parts, whose counts add up."""
    dead = retry.dead_letters(retry.retry_state(retry.all_attempts(*views.attempts(spark, sf_dir))))
    part = F.pmod(F.xxhash64("payment_id"), F.lit(5))
    deltas = None
    for i in range(5):
        counts = retry.dead_letter_counts(dead.where(part == i), size="1 day")
        deltas = counts if deltas is None else deltas.unionByName(counts)
    return retry.summed_counts(deltas, burst=3)
