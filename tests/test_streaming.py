"""Stream forms against their batch forms, restarts included."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import Window, functions as F

from conftest import DATA, ts
from spendwatch import schemas
from spendwatch.functions.times import interval
from spendwatch.operators import landing as landing_operators, late, numbering, progress, retry, windows
from spendwatch.operators.alerts import risk_alerts
from spendwatch.plans import views
from spendwatch.sinks import topics as topic_sink, transactional
from spendwatch.sources import requests as request_source, tables, topics as topic_source
from spendwatch.streaming import alerts, consumer, dedup, landing, ledger, monitor, relay
from spendwatch.streaming.exact import ExactAlerts

D = "2026-01-01 "
COLUMNS = ["payment_id", "user_id", "amount", "record_ts", "partition", "offset"]
ALERT_COLUMNS = ["user_id", "window_start", "window_end", "payments", "total_amount", "risk_level"]


class Topic:
    """Landing folder fed one file per micro-batch."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)

    def send(self, df):
        df.coalesce(1).write.mode("append").parquet(self.path)
        self.schema = df.schema

    def stream(self, files_per_batch=1):
        return topic_source.stream_topic(self.spark, self.path, self.schema, files_per_batch)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def drain(query):
    assert query.awaitTermination(180)
    assert query.exception() is None
    return query


def committed(spark, root, name):
    """Committed rows without a declared shape."""
    rows = spark.read.parquet(f"{root}/{name}")
    return rows.join(tables.read_commits(spark, root).select("batch_id", "try_id"), ["batch_id", "try_id"], "left_semi")


def stream_alerts(spark, root):
    """Alerts of a stream with their ids."""
    return windows.with_payment_ids(committed(spark, root, "alerts"), committed(spark, root, "alert_payment_ids"))


def batch_alerts(payments, threshold, closed=True, size="5 minutes", **options):
    blocks = windows.spend_blocks(payments, size=size, **options)
    spend = windows.spend_of_blocks(blocks, size)
    graded = risk_alerts(windows.closed_windows(spend, payments) if closed else spend, threshold)
    return windows.with_payment_ids(graded, windows.payment_id_blocks(graded, blocks))


def alert_rows(df):
    return sorted(df.select(*ALERT_COLUMNS, "triggering_payment_ids").collect())


def test_closed_windows_equal_the_batch_and_a_restart_adds_nothing(spark, topic, tmp_path):
    payments = views.payments(spark, DATA).select(*COLUMNS)
    cut = F.lit("2024-01-10 00:00:00").cast("timestamp")
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        drain(alerts.start_alerts(topic.stream(), root, checkpoint, views.THRESHOLD, block_offsets=200))

    topic.send(payments.where(F.col("record_ts") < cut))
    run()
    first = committed(spark, root, "alerts").count()
    run()
    assert committed(spark, root, "alerts").count() == first > 0
    topic.send(payments.where(F.col("record_ts") >= cut))
    run()
    assert alert_rows(stream_alerts(spark, root)) == alert_rows(batch_alerts(payments, views.THRESHOLD))
    topic_rows = committed(spark, root, "fraud.high-risk.alerts")
    assert topic_rows.count() == committed(spark, root, "alerts").count()


def test_one_alert_row_for_each_window_however_many_ids(spark, topic, tmp_path, make_payments):
    rows = [("hot" if i % 3 else "u", "100", D + f"00:{i % 4:02}:{i % 60:02}") for i in range(300)]
    payments = make_payments(*rows, ("flush", "1", D + "01:00:00")).select(*COLUMNS)
    topic.send(payments)
    root = str(tmp_path / "out")
    drain(alerts.start_alerts(topic.stream(), root, str(tmp_path / "c"), "5000", block_offsets=50))
    assert alert_rows(stream_alerts(spark, root)) == alert_rows(batch_alerts(payments, "5000"))
    assert committed(spark, root, "alerts").count() == 2
    assert committed(spark, root, "alert_payment_ids").count() > 2
    assert committed(spark, root, "alerts").where("alert_generated_ts IS NULL").count() == 0


def test_stream_options_apply_to_sums_and_ids(spark, topic, tmp_path, make_payments):
    payments = make_payments(("u", "8000", D + "00:01:00"), ("u", "8000", D + "00:01:00"), ("u", "9000", D + "00:02:00"),
                             ("flush", "1", D + "01:00:00"), ids=["a", "a", "b", "f"]).select(*COLUMNS)
    topic.send(payments)
    root = str(tmp_path / "out")
    drain(alerts.start_alerts(topic.stream(), root, str(tmp_path / "c"), slide="1 minute", dedup=True))
    got = stream_alerts(spark, root).collect()
    assert len(got) == 4  # the starts from which both payments lie inside
    assert all(r.total_amount == 17000 and r.triggering_payment_ids == ["a", "b"] for r in got)


def test_no_window_closes_without_a_later_record(spark, topic, tmp_path, make_payments):
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    transactional.create_tables(spark, root, {"alerts": schemas.ALERTS})
    topic.send(make_payments(("u", "16000", D + "00:01:00"), ("u", "1", D + "00:05:29")).select(*COLUMNS))
    drain(alerts.start_alerts(topic.stream(), root, checkpoint))
    assert committed(spark, root, "alerts").count() == 0
    topic.send(make_payments(("v", "1", D + "00:05:30")).select(*COLUMNS))
    drain(alerts.start_alerts(topic.stream(), root, checkpoint))
    assert [r.user_id for r in committed(spark, root, "alerts").collect()] == ["u"]


def test_stream_accepts_what_the_next_batch_still_may(spark, topic, tmp_path, make_payments):
    """The per-record rule drops this payment; the watermark of the batch before does not."""
    root = str(tmp_path / "out")
    topic.send(make_payments(("u", "8000", D + "00:01:00"), ("v", "1", D + "00:05:30")).select(*COLUMNS))
    topic.send(make_payments(("u", "8000", D + "00:04:59")).select(*COLUMNS))
    topic.send(make_payments(("v", "1", D + "01:00:00")).select(*COLUMNS))
    drain(alerts.start_alerts(topic.stream(), root, str(tmp_path / "c")))
    assert [str(r.total_amount) for r in committed(spark, root, "alerts").collect()] == ["16000.00"]


def test_append_sink_writes_each_closed_window_once(spark, topic, tmp_path):
    payments = views.payments(spark, DATA).select(*COLUMNS)
    topic.send(payments)
    out, checkpoint = str(tmp_path / "spend"), str(tmp_path / "c")
    for _ in range(2):
        spend = alerts.window_spend_stream(topic.stream())
        drain(topic_sink.append_stream(spend, out, checkpoint, "spend"))
    batch = windows.window_spend(payments, closed_only=True)
    assert sorted(spark.read.parquet(out).collect()) == sorted(batch.collect())
    # The named window state can be inspected.
    state = spark.read.format("statestore").load(checkpoint)
    assert {"key", "value", "partition_id"} <= set(state.columns)


def test_early_signals_end_at_the_batch_totals(spark, topic, tmp_path):
    payments = views.payments(spark, DATA).select(*COLUMNS)
    for day in range(3):
        topic.send(payments.where(F.col("offset") % 3 == day).where("record_ts < '2024-01-03'"))
    root = str(tmp_path / "out")
    drain(alerts.start_early_signals(
        topic.stream(), root, str(tmp_path / "c"), views.THRESHOLD, size="1 day", grace="3 days"))
    signals = committed(spark, root, "early_signals")
    last = signals.groupBy("user_id", "window_start").agg(
        F.max_by(F.struct("total", "payments", "over_threshold"), "batch_id").alias("s")).select(
        "user_id", "window_start", "s.*")
    batch = windows.window_spend(payments.where("record_ts < '2024-01-03'"), size="1 day").select(
        "user_id", "window_start", "total", "payments", (F.col("total") > 150).alias("over_threshold"))
    assert sorted(last.collect()) == sorted(batch.collect())
    assert signals.count() > batch.count()


def test_quarantine_stream(spark, topic, tmp_path):
    records = spark.createDataFrame(
        [("poison-key", "garbage-payload"), ("k", '{"paymentId":"p1","userId":"u"}')], "key string, value string")
    topic.send(records)
    topic.send(spark.createDataFrame([("k", '{"paymentId":"p2","userId":"u"}')], "key string, value string"))
    root = str(tmp_path / "out")
    drain(landing.start_quarantine_split(topic.stream(), schemas.EVENT_JSON, root, str(tmp_path / "c")))
    assert sorted(r.paymentId for r in committed(spark, root, "records").collect()) == ["p1", "p2"]
    assert [(r.key, r.poison_reason) for r in committed(spark, root, "quarantine").collect()] == [
        ("poison-key", "undecodable")]


BINARY = {"payment_id": "string", "user_id": "string", "merchant_id": "string", "currency": "string",
          "payment_method": "string", "metadata": "map<string,string>", "amount_bytes": "binary",
          "initiated_millis": "bigint"}


def assert_dense(rows):
    """Offsets of each topic partition are 0, 1, 2 and so on."""
    found = {}
    for r in rows:
        found.setdefault((r.topic, r.partition), []).append(r.offset)
    assert all(sorted(offsets) == list(range(len(offsets))) for offsets in found.values())


def body(user, amount):
    return json.dumps({"userId": user, "merchantId": "m", "amount": amount, "currency": "USD"})


def test_intake_to_outbox_to_topic(spark, tmp_path):
    landing_dir = tmp_path / "in"
    landing_dir.mkdir()
    (landing_dir / "a.json").write_text("\n".join([*[body(f"u{i}", 10 + i) for i in range(20)], body("bad", -1)]))
    intake_root, relay_root = str(tmp_path / "intake"), str(tmp_path / "relay")
    requests = request_source.stream_requests(spark, str(landing_dir)).withColumn("request_id", F.col("value"))
    drain(landing.start_intake(requests, intake_root, str(tmp_path / "c")))

    payments = tables.read_table(spark, intake_root, "payments", schemas.PAYMENTS)
    outbox = tables.read_table(spark, intake_root, "outbox", schemas.OUTBOX)
    assert payments.count() == outbox.count() == 20
    assert sorted(r.id for r in payments.collect()) == sorted(r.aggregate_id for r in outbox.collect())
    # One instant for the payment, its outbox row and the event inside.
    event = outbox.select("created_at", F.from_json("payload", schemas.EVENT_JSON)["initiatedTimestamp"].alias("at"))
    instants = {r.created_at for r in payments.collect()} | {r.created_at for r in event.collect()}
    assert len(instants) == 1
    assert event.where(F.col("at") != F.unix_millis("created_at")).count() == 0
    assert [r.reject_reasons for r in committed(spark, intake_root, "rejected").collect()] == [["amount:not_positive"]]

    relay.create(spark, relay_root)
    for poll, sent in ((0, 15), (1, 20), (1, 20), (2, 20)):  # poll 1 is replayed
        relay.relay_once(spark, intake_root, relay_root, poll, page=15)
        rows = tables.read_table(spark, relay_root, "sent", relay.SENT).collect()
        assert len(rows) == len({r.id for r in rows}) == sent
        assert_dense(rows)
    assert {r.topic for r in rows} == {"payment.initiated.events"}

    # What the relay sent is a topic like any other: from request bodies to alerts.
    topic_rows = relay.sent_topic(spark, relay_root, "payment.initiated.events")
    assert topic_rows.select("partition", "offset").distinct().count() == topic_rows.count() == 20
    assert relay.sent_topic(spark, relay_root, "another").count() == 0
    typed, bad = landing_operators.typed_landing(topic_rows.limit(0).select(
        "topic", "partition", "offset", "record_ts", *[F.lit(None).cast(t).alias(n) for n, t in BINARY.items()]), topic_rows)
    assert bad.count() == 0
    found = batch_alerts(typed, "15", closed=False, size="1 day").collect()
    assert sorted(r.user_id for r in found) == sorted(f"u{i}" for i in range(6, 20))
    assert all(len(r.triggering_payment_ids) == 1 for r in found)


def outbox_batch(spark, root, batch_id, n, users=3):
    rows = spark.range(0, n, 1, 1).select(
        F.concat(F.lit(f"b{batch_id}-"), "id").alias("id"), F.lit("Payment").alias("aggregate_type"),
        F.col("id").cast("string").alias("aggregate_id"), F.lit("E").alias("event_type"), F.lit("{}").alias("payload"),
        F.lit("t").alias("kafka_topic"), F.concat(F.lit("u"), F.col("id") % users).alias("kafka_key"),
        F.when(F.col("id") % 10 == 9, "FAILED").otherwise("PENDING").alias("status"),
        F.timestamp_seconds(F.lit(1_760_000_000) + F.lit(batch_id) * 60 + F.col("id") % 7).alias("created_at"),
        F.lit(None).cast("timestamp").alias("published_at"))
    transactional.write_batch(spark, root, batch_id, {"outbox": rows})


def test_offsets_stay_dense_over_polls_far_apart(spark, tmp_path):
    outbox_root, relay_root = str(tmp_path / "intake"), str(tmp_path / "relay")
    transactional.create_tables(spark, outbox_root, {"outbox": schemas.OUTBOX})
    relay.create(spark, relay_root)
    for batch, poll in enumerate((0, 524_288, 1_000_000)):
        outbox_batch(spark, outbox_root, batch, 50)
        relay.relay_once(spark, outbox_root, relay_root, poll)
    sent = tables.read_table(spark, relay_root, "sent", relay.SENT)
    rows = sent.collect()
    assert len(rows) == len({r.id for r in rows}) == 135
    assert_dense(rows)
    assert progress.offset_gaps(sent).count() == 0
    # Offsets follow the order of creation, over polls as well.
    outbox = tables.read_table(spark, outbox_root, "outbox", schemas.OUTBOX)
    wrong = sent.join(outbox.select("id", "created_at"), "id").select(
        F.col("created_at") < F.max("created_at").over(
            Window.partitionBy("topic", "partition").orderBy("offset")))
    assert wrong.toDF("wrong").where("wrong").count() == 0


def test_a_poll_reads_what_is_pending_not_the_history(spark, tmp_path):
    outbox_root, relay_root = str(tmp_path / "intake"), str(tmp_path / "relay")
    transactional.create_tables(spark, outbox_root, {"outbox": schemas.OUTBOX})
    relay.create(spark, relay_root)
    for day in range(30):
        outbox_batch(spark, outbox_root, day, 20)
    relay.relay_once(spark, outbox_root, relay_root, 0, page=30 * 18 - 3)
    opened = []
    for day in range(30, 33):
        outbox_batch(spark, outbox_root, day, 20)
        rows, newest = relay.open_rows(spark, outbox_root, relay_root, day)
        opened.append((rows.count(), newest))
        names = {f.split("/outbox/")[1].split("/")[0] for f in rows.inputFiles() if "/outbox/" in f}
        assert names == {f"batch_id={day}"}
        assert {f.split("/pending/")[1].split("/")[0] for f in rows.inputFiles() if "/pending/" in f} == {
            f"batch_id={day - 1 if day > 30 else 0}"}
        relay.relay_once(spark, outbox_root, relay_root, day, page=18)
    assert opened == [(21, day) for day in range(30, 33)]
    relay.relay_once(spark, outbox_root, relay_root, 33)
    assert relay.open_rows(spark, outbox_root, relay_root, 34)[0].count() == 0
    sent = tables.read_table(spark, relay_root, "sent", relay.SENT).collect()
    assert len({r.id for r in sent}) == len(sent) == 33 * 18
    assert_dense(sent)


def test_a_poll_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    outbox_root, relay_root = str(tmp_path / "intake"), str(tmp_path / "relay")
    relay.create(spark, relay_root)
    outbox_batch(spark, outbox_root, 0, 20)

    def die(*_):
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        patch.setattr(transactional, "mark_committed", die)
        with pytest.raises(RuntimeError, match="died"):
            relay.relay_once(spark, outbox_root, relay_root, 0)
    assert tables.read_table(spark, relay_root, "sent", relay.SENT).count() == 0
    relay.relay_once(spark, outbox_root, relay_root, 0)
    rows = tables.read_table(spark, relay_root, "sent", relay.SENT).collect()
    assert len(rows) == 18
    assert_dense(rows)


def test_numbers_are_dense_over_very_many_tasks(spark):
    records = spark.range(20_000).select(
        F.lit("t").alias("topic"), F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("partition"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "2100")
    try:
        staged = numbering.staged_in_order(records, ("id",))
        assert staged.select("_range").distinct().count() > 2049  # more than an offset once had room for
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    ends = spark.createDataFrame([("t", 0, 7), ("gone", 0, 5)], relay.ENDS)
    rows = numbering.dense_offsets(staged, ends).orderBy("id").collect()
    assert [r.offset for r in rows if r.partition == 1] == list(range(6667))
    assert [r.offset for r in rows if r.partition == 0] == list(range(7, 13_340))
    assert {(r.topic, r.partition): r.end_offset for r in numbering.next_ends(staged, ends).collect()} == {
        ("t", 0): 13_340, ("t", 1): 6667, ("gone", 0): 5}
    nothing = numbering.staged_in_order(records.limit(0), ("id",))
    assert numbering.dense_offsets(nothing, ends).count() == 0
    assert numbering.next_ends(nothing, ends).count() == 2


# Exact lateness

def exact(spark, tmp_path, name="exact", **options):
    job = ExactAlerts(spark, str(tmp_path / name), **options)
    job.create()
    return job


def test_exact_lateness_drops_what_the_watermark_keeps(spark, topic, tmp_path, make_payments):
    """The probe of `test_stream_accepts_what_the_next_batch_still_may`: here the payment at 00:04:59 is late."""
    topic.send(make_payments(("u", "8000", D + "00:01:00"), ("v", "1", D + "00:05:30")).select(*COLUMNS))
    topic.send(make_payments(("u", "8000", D + "00:04:59")).select(*COLUMNS))
    topic.send(make_payments(("u", "16000", D + "00:06:00"), ("v", "1", D + "01:00:00")).select(*COLUMNS))
    job = exact(spark, tmp_path)
    for _ in range(2):
        drain(job.start(topic.stream(), str(tmp_path / "c")))
    assert [(r.user_id, str(r.total_amount)) for r in committed(spark, job.root, "alerts").collect()] == [("u", "16000.00")]
    late_rows = committed(spark, job.root, "late_records").collect()
    assert [(r.payment_id, r.stream_time) for r in late_rows] == [("p0", ts(D + "00:05:30"))]


@pytest.mark.parametrize("cuts", [[], [500], [100, 101, 350, 700], list(range(90, 1000, 90))])
def test_late_flags_do_not_depend_on_the_micro_batches(spark, cuts):
    rows = views.disordered(views.payments(spark, DATA)).withColumn(
        "topic", F.when(views.every(3), F.lit("replayed")).otherwise(F.col("topic"))).withColumn(
        "partition", (F.col("event_id") % 2).cast("int"))
    whole = late.flag_late(rows, size="1 hour").select("payment_id", "stream_time", "late")
    carry, got = None, []
    borders = [-1, *[2 * c for c in cuts], 10**9]
    for low, high in zip(borders[:-1], borders[1:]):
        batch = rows.where((F.col("offset") > low) & (F.col("offset") <= high))
        got += late.flag_late(batch, size="1 hour", carry=carry).select("payment_id", "stream_time", "late").collect()
        times = late.newest_times(batch, carry).collect()
        carry = spark.createDataFrame(times, "topic string, partition int, newest timestamp")
    assert sorted(got) == sorted(whole.collect())
    assert any(r.late for r in got)


@pytest.mark.parametrize("batches", [1, 4])
def test_exact_alerts_equal_the_batch(spark, tmp_path, batches):
    rows = views.disordered(views.payments(spark, DATA)).withColumn("partition", (F.col("event_id") % 2).cast("int")).select(
        *COLUMNS, "topic").cache()
    end = rows.agg(F.max("offset")).first()[0]
    job = exact(spark, tmp_path, threshold=views.THRESHOLD, size="1 hour", block_offsets=100)
    for i in range(batches):
        part = rows.where(F.col("offset").between(i * end // batches + (i > 0), (i + 1) * end // batches))
        job.process(part, i)
        job.process(part, i)  # a replay does nothing
    passed = rows.groupBy("partition").agg(F.max("record_ts").alias("newest")).agg(F.min("newest")).first()[0]
    blocks = windows.spend_blocks(rows, size="1 hour", drop_late=True)
    spend = windows.spend_of_blocks(blocks, "1 hour").where(
        F.col("window_end") + interval("30 seconds") <= F.lit(passed))
    graded = risk_alerts(spend, views.THRESHOLD)
    want = windows.with_payment_ids(graded, windows.payment_id_blocks(graded, blocks))
    assert alert_rows(stream_alerts(spark, job.root)) == alert_rows(want) != []
    dropped = late.flag_late(rows, size="1 hour").where("late").select("payment_id").collect()
    assert sorted(committed(spark, job.root, "late_records").select("payment_id").collect()) == sorted(dropped) != []


def test_a_silent_partition_holds_windows_back_unless_told_otherwise(spark, tmp_path, make_payments):
    first = make_payments(("u", "16000", D + "00:01:00"), ("w", "1", D + "00:01:00", 1), ("v", "1", D + "00:20:00"))
    more = make_payments(("w", "20000", D + "00:02:00", 1))
    for every, users in ((True, []), (False, ["u"])):
        job = exact(spark, tmp_path, f"all-{every}", all_partitions=every)
        job.process(first.select(*COLUMNS), 0)
        assert [r.user_id for r in committed(spark, job.root, "alerts").collect()] == users
        job.process(more.select(*COLUMNS), 1)  # on time on its own partition
        assert committed(spark, job.root, "late_records").count() == (0 if every else 1)


def test_processed_and_balance_appear_together(spark, tmp_path):
    root = str(tmp_path / "out")
    processed = spark.createDataFrame([("p", "u")], "payment_id string, user_id string")
    balance = spark.createDataFrame([("u", None)], schemas.BALANCES)

    failing = balance.withColumn("balance", F.raise_error(F.lit("broken")).cast("decimal(18,2)"))
    transactional.create_tables(spark, root, {"payment.processed.events": processed.schema,
                                              "user-account-balances": schemas.BALANCES})
    with pytest.raises(Exception, match="broken"):
        relay.publish_processed(processed, failing, root, 0)
    assert committed(spark, root, "payment.processed.events").count() == 0
    relay.publish_processed(processed, balance, root, 0)
    assert committed(spark, root, "payment.processed.events").count() == 1
    assert committed(spark, root, "user-account-balances").count() == 1


class Clock:
    def __init__(self, text):
        self.time = ts(text)

    def __call__(self):
        return self.time

    def advance(self, **delta):
        self.time += dt.timedelta(**delta)


@pytest.fixture
def shop(spark, tmp_path):
    """A consumer whose handler fails for 'retry-test-user' and cannot read 'poison'."""
    def handler(df):
        error = F.when(F.col("user_id") == "retry-test-user", "RuntimeException").when(
            F.col("user_id") == "poison", "DeserializationException")
        flaky = F.when((F.col("user_id") == "flaky") & (F.col("earlier_attempts") == 0), "RuntimeException")
        return df.withColumn("error_class", F.coalesce(error, flaky)).withColumn(
            "exception_message", F.when(F.col("error_class").isNotNull(), "boom"))

    schema = spark.range(0).selectExpr(
        "'' AS payment_id", "'' AS user_id", "cast(0 AS decimal(18,2)) AS amount",
        "timestamp'2026-01-01' AS record_ts", "0 AS partition", "0L AS offset").schema
    clock = Clock(D + "00:00:00")
    shop = consumer.PaymentConsumer(spark, str(tmp_path / "shop"), schema, handler, now=clock)
    shop.create()
    shop.clock = clock
    return shop


def table_rows(shop, name, schema):
    return tables.read_table(shop.spark, shop.root, name, schema)


def done(shop):
    return sorted(r.message_key.split(":")[1] for r in table_rows(shop, "processed_messages", schemas.PROCESSED_MESSAGES).collect())


def dead(shop):
    return {r.payment_id: r.attempts for r in table_rows(shop, "dead_letter", schemas.DEAD_LETTER).collect()}


def test_consumer_processes_once_retries_and_gives_up(spark, shop, make_payments):
    nothing = make_payments(("u", "1", D + "00:00:00")).select(*COLUMNS).limit(0)
    batch = make_payments(
        ("u", "1", D + "00:00:00"), ("u", "1", D + "00:00:01"), ("retry-test-user", "50", D + "00:00:00"),
        ("poison", "1", D + "00:00:00"), ("flaky", "1", D + "00:00:00"),
        ids=["a", "a", "r", "x", "f"]).select(*COLUMNS)
    shop.process(batch, 0)
    assert done(shop) == ["a"] and dead(shop) == {"x": 1}
    shop.process(batch, 0)  # replay of the same micro-batch
    assert done(shop) == ["a"] and dead(shop) == {"x": 1}

    shop.clock.advance(milliseconds=999)
    shop.process(batch, 1)  # redelivery: 'a' is known, 'r' and 'f' wait, nothing is due
    assert done(shop) == ["a"] and dead(shop) == {"x": 1}
    shop.clock.advance(milliseconds=1)
    shop.process(make_payments(("v", "1", D + "00:00:02"), ids=["b"]).select(*COLUMNS), 2)
    assert done(shop) == ["a", "b", "f"]  # other users are not delayed, the second attempt of f works
    shop.clock.advance(milliseconds=1999)
    shop.process(nothing, 3)
    assert "r" not in dead(shop)
    shop.clock.advance(milliseconds=1)
    shop.process(nothing, 4)
    assert dead(shop)["r"] == 3
    shop.clock.advance(hours=1)
    shop.process(nothing, 5)
    assert table_rows(shop, "attempts", schemas.ATTEMPTS).where("payment_id = 'r'").count() == 3
    letter = table_rows(shop, "dead_letter", schemas.DEAD_LETTER).where("payment_id = 'r'").first()
    assert (letter.original_topic, letter.original_partition, letter.original_offset, letter.original_key) == (
        "payment.initiated.events", 0, 2, "retry-test-user")


def test_consumer_forgets_a_key_after_the_ttl(spark, shop, make_payments):
    batch = make_payments(("u", "1", D + "00:00:00"), ids=["a"]).select(*COLUMNS)
    shop.process(batch, 0)
    shop.clock.advance(hours=23, minutes=59)
    shop.process(batch, 1)
    assert done(shop) == ["a"]
    shop.clock.advance(minutes=1)
    shop.process(batch, 2)
    assert done(shop) == ["a", "a"]


def files_of(frame):
    """Files of the ledger and the queue that a plan opens."""
    names = ("/processed_messages/", "/ledger_hours/", "/waiting/", "/waiting_keys/")
    return sum(any(n in f for n in names) for f in frame.inputFiles())


def test_ledger_opens_a_day_whatever_the_history(spark, shop, make_payments):
    opened, hours = [], [h for day in (0, 15, 30) for h in (24 * day, 24 * day + 1, 24 * day + 20)]
    start = shop.clock.time
    for n, hour in enumerate(hours):
        shop.clock.time = start + dt.timedelta(hours=hour)
        known = shop.known_keys(shop.memory(n), [3])
        opened.append(files_of(known))
        ids = [f"{hour}-{i}" for i in range(40)]
        shop.process(make_payments(*[("u", "1", D + "00:00:00")] * 40, ids=ids).select(*COLUMNS).coalesce(1), n)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert all("bucket" in scan.split("PushedFilters")[0] for scan in plan.split("PartitionFilters: ")[1:] if "hour=" in scan)
    # Nothing of two weeks ago, then the hours of the day itself: one file for each hour and bucket.
    assert opened[3::3] == [0] * 2 and 0 < max(opened) <= 2 * ledger.BUCKETS
    # Rewritten hours hold their keys for the whole ttl, and no longer.
    for later, left in ((23, {hours[-2], hours[-1]}), (43, {hours[-1]}), (44, set())):
        shop.clock.time = start + dt.timedelta(hours=hours[-3] + later, minutes=59 * (later == 23))
        known = shop.known_keys(shop.memory(10**6), list(range(ledger.BUCKETS))).collect()
        found = {int(r.message_key.split(":")[1].split("-")[0]) for r in known}
        assert found == left | ({hours[-3]} if later == 23 else set())
        assert len(known) == 40 * len(found)


def test_waiting_payments_cost_nothing_before_they_are_due(spark, shop, make_payments):
    shop.schedule["delay_seconds"], shop.longest_wait = 3600, 2 * 3600 * 1_000_000
    many = make_payments(*[("retry-test-user", "1", D + "00:00:00")] * 200, ids=[f"r{i}" for i in range(200)]).select(*COLUMNS)
    nothing = many.limit(0)
    shop.process(many, 0)
    for batch in (1, 2):
        shop.clock.advance(minutes=10)
        assert files_of(shop.memory(batch).due()) == 0
        shop.process(nothing, batch)
        waiting = spark.read.parquet(f"{shop.root}/waiting")
        assert waiting.where(F.col("batch_id") >= 1).count() == 0  # nothing is written again
        assert table_rows(shop, "attempts", schemas.ATTEMPTS).count() == 200
    shop.process(many, 3)  # second deliveries of waiting payments start nothing
    assert table_rows(shop, "attempts", schemas.ATTEMPTS).count() == 200
    shop.clock.advance(minutes=40)
    assert shop.memory(4).due().count() == 200
    shop.process(many, 4)
    assert table_rows(shop, "attempts", schemas.ATTEMPTS).groupBy("attempt").count().collect() == [(1, 200), (2, 200)]


def test_a_batch_that_dies_leaves_no_trace_in_ledger_and_queue(spark, shop, make_payments, monkeypatch):
    batch = make_payments(("u", "1", D + "00:00:00"), ("flaky", "1", D + "00:00:00"), ids=["a", "f"]).select(*COLUMNS)

    def die(*_):
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        patch.setattr(transactional, "mark_committed", die)
        with pytest.raises(RuntimeError, match="died"):
            shop.process(batch, 0)
    assert done(shop) == []
    shop.process(batch, 0)
    assert done(shop) == ["a"]
    shop.clock.advance(seconds=1)
    shop.process(batch, 1)
    assert done(shop) == ["a", "f"]
    assert table_rows(shop, "attempts", schemas.ATTEMPTS).count() == 2


def test_a_retry_without_delay_runs_in_the_next_batch(spark, shop, make_payments):
    shop.schedule["delay_seconds"] = 0
    batch = make_payments(("retry-test-user", "1", D + "00:00:00"), ids=["r"]).select(*COLUMNS)
    shop.process(batch, 0)
    shop.clock.advance(microseconds=1)
    shop.process(batch.limit(0), 1)
    shop.clock.advance(days=40)  # a long time without batches
    shop.process(batch.limit(0), 2)
    assert dead(shop) == {"r": 3}


def test_consumer_as_a_stream_survives_a_restart(spark, shop, topic, tmp_path):
    payments = views.redelivered(views.payments(spark, DATA).select(*COLUMNS, "event_id")).drop("event_id")
    topic.send(payments.where("offset < 500"))
    topic.send(payments.where("offset >= 500"))
    checkpoint = str(tmp_path / "c")
    for _ in range(2):
        drain(shop.start(topic.stream(), checkpoint))
    assert len(done(shop)) == len(set(done(shop))) == views.payments(spark, DATA).count()


def test_a_due_retry_runs_without_new_payments(spark, shop, topic, tmp_path, make_payments):
    shop.now = consumer._utc_now
    topic.send(make_payments(("flaky", "1", D + "00:00:00"), ids=["f"]).select(*COLUMNS))
    query = shop.start(topic.stream(), str(tmp_path / "c"), {"processingTime": "1 second"}, heartbeat=True)
    try:
        for _ in range(60):
            assert query.exception() is None
            query.awaitTermination(1)
            if done(shop) == ["f"]:
                break
    finally:
        query.stop()
    assert done(shop) == ["f"]


def test_watermark_dedup(spark, topic, tmp_path, make_payments):
    topic.send(make_payments(
        ("u", "1", D + "00:00:00"), ("u", "1", D + "00:00:05"), ("v", "1", D + "00:00:05"),
        ids=["a", "a", "b"]).select(*COLUMNS))
    topic.send(make_payments(("u", "1", D + "01:00:00"), ids=["a"]).select(*COLUMNS))
    unique = dedup.dedup_within_watermark(topic.stream())
    out = str(tmp_path / "out")
    drain(topic_sink.append_stream(unique, out, str(tmp_path / "c"), "dedup"))
    assert sorted(r.payment_id for r in spark.read.parquet(out).collect()) == ["a", "b"]


def run_for(query, path, rows, spark, seconds=30):
    """A query with processing-time state never ends by itself: wait for its rows, then stop it."""
    try:
        for _ in range(seconds):
            assert query.exception() is None
            query.awaitTermination(1)
            written = os.path.isdir(f"{path}/_spark_metadata")
            if written and spark.read.schema("payment_id string").parquet(path).count() >= rows:
                break
    finally:
        query.stop()


def start_first_deliveries(topic, out, checkpoint, ttl_seconds, releases=None):
    unique = dedup.first_deliveries(topic.stream(100), ttl_seconds=ttl_seconds, releases=releases)
    return (
        unique.writeStream.outputMode("append").format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(processingTime="1 second").start())


def test_state_dedup_keeps_the_earliest_copy_across_restarts(spark, topic, tmp_path, make_payments):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    hot = [("hot", str(i + 1), D + f"00:{59 - i:02}:00") for i in range(60)]
    topic.send(make_payments(*hot, ("u", "1", D + "00:00:00"), ids=["h"] * 60 + ["a"]).select(*COLUMNS))
    run_for(start_first_deliveries(topic, out, checkpoint, 3600), out, 2, spark)
    topic.send(make_payments(
        ("hot", "1", D + "00:00:00"), ("v", "1", D + "00:00:00"), ids=["h", "b"]).select(*COLUMNS))
    run_for(start_first_deliveries(topic, out, checkpoint, 3600), out, 3, spark)
    rows = sorted((r.payment_id, str(r.amount)) for r in spark.read.parquet(out).collect())
    assert rows == [("a", "1.00"), ("b", "1.00"), ("h", "60.00")]


def test_state_dedup_forgets_after_the_ttl_or_a_release(spark, tmp_path, make_payments):
    topic, freed = Topic(spark, tmp_path / "topic"), Topic(spark, tmp_path / "freed")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    payment = make_payments(("u", "1", D + "00:00:00"), ids=["a"]).select(*COLUMNS)
    freed.send(payment.select("payment_id").limit(0))
    topic.send(payment)
    run_for(start_first_deliveries(topic, out, checkpoint, 3600, freed.stream()), out, 1, spark)
    freed.send(payment.select("payment_id"))
    topic.send(payment)
    run_for(start_first_deliveries(topic, out, checkpoint, 3600, freed.stream()), out, 2, spark)
    assert spark.read.parquet(out).count() == 2

    out, checkpoint = str(tmp_path / "out2"), str(tmp_path / "c2")
    run_for(start_first_deliveries(topic, out, checkpoint, 1), out, 1, spark)
    time.sleep(1.5)
    topic.send(payment)
    run_for(start_first_deliveries(topic, out, checkpoint, 1), out, 2, spark)
    assert spark.read.parquet(out).count() == 2


def test_consumer_behind_state_dedup_needs_no_ledger(spark, shop, make_payments):
    shop.use_ledger = False
    batch = make_payments(("u", "1", D + "00:00:00"), ("u", "1", D + "00:00:00"), ids=["a", "a"]).select(*COLUMNS)
    shop.process(batch, 0)
    assert done(shop) == ["a"]
    shop.process(batch, 1)  # the ledger is not asked
    assert done(shop) == ["a", "a"]


def test_dead_letter_monitor_reads_on_its_own(spark, shop, tmp_path, make_payments):
    batch = make_payments(("poison", "1", D + "00:00:00"), ("u", "1", D + "00:00:00")).select(*COLUMNS)
    shop.process(batch, 0)
    root = str(tmp_path / "monitor")
    # A try that died before its marker leaves rows that no reader may count.
    table_rows(shop, "dead_letter", schemas.DEAD_LETTER).drop("batch_id").write.parquet(
        f"{shop.root}/dead_letter/batch_id=1/try_id=dead")

    def counts():
        drain(monitor.start_monitor(spark, shop.root, root, str(tmp_path / "mc")))
        rows = monitor.current_counts(committed(spark, root, "dead_letter_deltas"))
        return [(r.error_class, r.dead_letters, r.burst) for r in rows.collect()]

    assert counts() == [("DeserializationException", 1, False)]
    more = make_payments(*[("poison", "1", D + "00:00:00")] * 10, ids=[f"q{i}" for i in range(10)]).select(*COLUMNS)
    shop.process(more, 1)
    assert counts() == [("DeserializationException", 11, True)]
    assert counts() == [("DeserializationException", 11, True)]
    letters = tables.read_table(spark, shop.root, "dead_letter", schemas.DEAD_LETTER)
    assert retry.dead_letter_monitor(letters).collect() == monitor.current_counts(
        committed(spark, root, "dead_letter_deltas")).collect()
    # A micro-batch opens the batches it is about, not the table.
    one = tables.read_commits(spark, shop.root).where("batch_id = 1")
    opened = monitor.new_letters(spark, shop.root, one)
    assert opened.count() == 10 and all("batch_id=1/" in f for f in opened.inputFiles())


def test_alert_records_are_keyed_by_user(spark, make_payments):
    spend = windows.window_spend(make_payments(("u", "16000", D + "00:00:00")))
    row = topic_sink.alert_records(risk_alerts(spend)).first()
    assert (row.topic, row.key) == ("fraud.high-risk.alerts", "u")
    assert json.loads(row.value)["risk_level"] == "MEDIUM"


def test_intervals_are_plain_sql(spark):
    assert spark.range(1).select(interval("30 seconds").alias("i")).first().i == dt.timedelta(seconds=30)
