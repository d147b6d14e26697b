import datetime as dt
import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import ts
from spendwatch.operators import dedup, progress, retry

D = "2026-01-01 "


def deliveries(spark, *rows):
    """(key, time[, failed]) in arrival order."""
    table = [(f"p{i}", k, ts(at), 0, i, bool(rest and rest[0])) for i, (k, at, *rest) in enumerate(rows)]
    return spark.createDataFrame(
        table, "payment_id string, key string, record_ts timestamp, partition int, offset long, failed boolean")


def outcomes(df, **options):
    rows = dedup.idempotent_ttl(df, "key", failed="failed", **options).orderBy("offset").collect()
    return [r.outcome for r in rows]


def test_first_delivery_wins(spark):
    df = deliveries(spark, ("x", D + "00:00:02"), ("x", D + "00:00:01"), ("y", D + "00:00:03"), ("x", D + "00:00:09"))
    first = dedup.idempotent_first(df, "key").orderBy("key").collect()
    assert [(r.key, r.payment_id, r.deliveries) for r in first] == [("x", "p1", 3), ("y", "p2", 1)]


def test_first_delivery_keeps_maps_and_column_order(spark):
    df = deliveries(spark, ("x", D + "00:00:01")).withColumn("metadata", F.create_map(F.lit("k"), F.lit("v")))
    first = dedup.idempotent_first(df, "key")
    assert first.columns == [*df.columns, "deliveries"] and first.first().metadata == {"k": "v"}


def test_ledger_rows(spark):
    row = dedup.ledger_rows(deliveries(spark, ("x", D + "00:00:01"))).first()
    assert (row.message_key, row.topic) == ("payment-event:p0", "payment.initiated.events")


def test_second_delivery_within_a_day_is_skipped(spark):
    df = deliveries(spark, ("x", D + "00:00:00"), ("x", D + "23:59:59.999"))
    assert outcomes(df) == ["processed", "duplicate"]


def test_key_is_free_exactly_after_the_ttl(spark):
    df = deliveries(spark, ("x", D + "00:00:00"), ("x", "2026-01-02 00:00:00"))
    assert outcomes(df) == ["processed", "processed"]


def test_a_duplicate_does_not_extend_the_hold(spark):
    df = deliveries(spark, ("x", D + "00:00:00"), ("x", D + "23:00:00"), ("x", "2026-01-02 01:00:00"))
    assert outcomes(df) == ["processed", "duplicate", "processed"]


def test_a_failed_attempt_releases_the_key(spark):
    df = deliveries(spark, ("x", D + "00:00:00", True), ("x", D + "00:00:01"), ("x", D + "00:00:02", True))
    assert outcomes(df) == ["failed", "processed", "duplicate"]


def test_equal_times_are_decided_by_offset(spark):
    df = deliveries(spark, ("x", D + "00:00:00"), ("x", D + "00:00:00"))
    assert outcomes(df) == ["processed", "duplicate"]


def test_deliveries_without_key_share_one_hold(spark):
    df = deliveries(spark, (None, D + "00:00:00"), (None, D + "01:00:00"))
    assert outcomes(df) == ["processed", "duplicate"]


def brute_force(rows, ttl):
    last, result = {}, {}
    for r in sorted(rows, key=lambda r: (r.record_ts, r.offset)):
        held = r.key in last and r.record_ts < last[r.key] + ttl
        result[r.payment_id] = "duplicate" if held else "failed" if r.failed else "processed"
        if not held and not r.failed:
            last[r.key] = r.record_ts
    return result


@pytest.mark.parametrize("slots,key_claims", [(1, 0), (7, 0), (1024, 0), (10**9, 0), (7, 100), (1024, 10**6)])
def test_hot_and_cold_keys_equal_brute_force(spark, slots, key_claims):
    """Half of the deliveries share one key; slots and the bound on whole keys decide what the folds see."""
    rng = random.Random(7)
    base = dt.datetime(2026, 1, 1)
    rows = [
        (f"p{i}", rng.choice(["hot"] * 5 + ["a", "b", "c", "d", "e"]),
         base + dt.timedelta(minutes=rng.randrange(6 * 24 * 60)), 0, i, rng.random() < 0.2)
        for i in range(400)]
    df = spark.createDataFrame(
        rows, "payment_id string, key string, record_ts timestamp, partition int, offset long, failed boolean")
    result = dedup.idempotent_ttl(df, "key", failed="failed", slots=slots, key_claims=key_claims).collect()
    assert {r.payment_id: r.outcome for r in result} == brute_force(df.collect(), dt.timedelta(hours=24))
    assert {r.outcome for r in result} == {"processed", "duplicate", "failed"}


def test_keys_before_1970_and_null_keys(spark):
    df = deliveries(spark, ("x", "1969-12-31 20:00:00"), ("x", "1970-01-01 10:00:00"), ("x", "1970-01-01 20:00:00"),
                    (None, "1969-12-31 20:00:00"), (None, "1969-12-31 21:00:00"), ("null", "1969-12-31 21:00:00"))
    assert outcomes(df) == ["processed", "duplicate", "processed", "processed", "duplicate", "processed"]


def test_the_chain_runs_without_python(spark):
    plan = dedup.idempotent_ttl(deliveries(spark, ("x", D + "00:00:00")), "key", failed="failed")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "InArrow" not in text and "InPandas" not in text


def test_a_span_of_fifty_years_builds_at_once(spark):
    df = deliveries(spark, ("x", "1974-01-01 00:00:00"), ("x", "2024-01-01 00:00:00"), ("x", "2024-01-01 00:00:01"))
    began = time.time()
    plan = dedup.idempotent_ttl(df, "key", failed="failed")
    assert time.time() - began < 2
    assert [r.outcome for r in plan.orderBy("offset").collect()] == ["processed", "processed", "duplicate"]


def test_latest_attempt_keeps_maps_and_full_names_match(spark):
    df = attempts(spark, ("a", 1, D + "00:00:00", "java.lang.RuntimeException"),
                  ("b", 1, D + "00:00:00", "IllegalStateException"), ("c", 1, D + "00:00:00", "IllegalArgumentException"),
                  ("d", 1, D + "00:00:00", "com.shop.Busy")).withColumn("headers", F.create_map(F.lit("k"), F.col("payment_id")))
    state = {r.payment_id: r for r in retry.retry_state(df).collect()}
    assert {k: r.disposition for k, r in state.items()} == {
        "a": "retry", "b": "retry", "c": "not_retryable", "d": "not_retryable"}
    assert state["b"].headers == {"k": "b"}
    own = retry.retry_state(df, retryable=("Busy",)).where("disposition = 'retry'").collect()
    assert [r.payment_id for r in own] == ["d"]


ATTEMPTS = (
    "payment_id string, attempt int, failed_at timestamp, error_class string, exception_message string, "
    "original_topic string")


def attempts(spark, *rows):
    return spark.createDataFrame(
        [(p, n, ts(at), error, "boom", "t") for p, n, at, error in rows], ATTEMPTS)


def test_retry_delays_then_dead_letter(spark):
    df = attempts(
        spark, ("a", 1, D + "00:00:00", "RuntimeException"),
        ("b", 1, D + "00:00:00", "RuntimeException"), ("b", 2, D + "00:00:01", "RuntimeException"),
        ("c", 1, D + "00:00:00", "RuntimeException"), ("c", 2, D + "00:00:01", "RuntimeException"),
        ("c", 3, D + "00:00:03", "RuntimeException"), ("d", 1, D + "00:00:00", "DeserializationException"),
        ("e", 1, D + "00:00:00", "RuntimeException"), ("e", 2, D + "00:00:01", None))
    state = {r.payment_id: r for r in retry.retry_state(df).collect()}
    assert {k: r.disposition for k, r in state.items()} == {
        "a": "retry", "b": "retry", "c": "exhausted", "d": "not_retryable", "e": "done"}
    assert state["a"].next_attempt_at == ts(D + "00:00:01")
    assert state["b"].next_attempt_at == ts(D + "00:00:03")
    dead = {r.payment_id: r.attempts for r in retry.dead_letters(retry.retry_state(df)).collect()}
    assert dead == {"c": 3, "d": 1}


def test_fixed_backoff_and_due_rows(spark):
    df = attempts(
        spark, ("a", 1, D + "00:00:00", "RuntimeException"),
        ("b", 1, D + "00:00:00", "RuntimeException"), ("b", 2, D + "00:00:01", "RuntimeException"))
    state = retry.retry_state(df, multiplier=1)
    due = retry.due_attempts(state, F.lit(D + "00:00:01.5").cast("timestamp"))
    assert [r.payment_id for r in due.collect()] == ["a"]
    assert {r.payment_id: r.next_attempt_at for r in state.collect()}["b"] == ts(D + "00:00:02")


def test_main_and_retry_topics_are_handled_alike(spark):
    main = attempts(spark, ("a", 1, D + "00:00:00", "RuntimeException"))
    again = attempts(spark, ("a", 2, D + "00:00:01", "RuntimeException"))
    assert [r.attempt for r in retry.retry_state(retry.all_attempts(main, again)).collect()] == [2]


def test_dead_letter_burst(spark):
    rows = [(f"p{i}", 3, D + f"00:{i:02}:00", "RuntimeException") for i in range(10)]
    df = attempts(spark, *rows, ("x", 3, D + "02:00:00", "RuntimeException"))
    monitor = retry.dead_letter_monitor(retry.dead_letters(retry.retry_state(df))).orderBy("window_start").collect()
    assert [(r.dead_letters, r.burst) for r in monitor] == [(10, True), (1, False)]


def log_of(spark, *rows):
    return spark.createDataFrame([("t", p, o) for p, o in rows], "topic string, partition int, offset long")


def test_topic_counts(spark):
    rows = progress.topic_counts(log_of(spark, (0, 0), (0, 1), (0, 5), (1, 0))).collect()
    assert {r.partition: (r.records, r.end_offset) for r in rows} == {0: (3, 6), 1: (1, 1), None: (4, None)}


def test_consumer_lag_counts_untouched_partitions(spark):
    commits = spark.createDataFrame(
        [("g", "t", 0, 1), ("g", "t", 0, 2)], "group_id string, topic string, partition int, committed_offset long")
    rows = progress.consumer_lag(log_of(spark, (0, 0), (0, 3), (1, 9)), commits).collect()
    assert {r.partition: r.lag for r in rows} == {0: 2, 1: 10}


def test_commits_without_a_partition_make_a_group_that_owes_all(spark):
    commits = spark.createDataFrame(
        [("g", "t", None, 5), ("h", "t", 0, 2), ("h", "t", 0, 1)],
        "group_id string, topic string, partition int, committed_offset long")
    log = spark.createDataFrame([("t", 0, 0), ("t", 0, 3)], "topic string, partition int, offset long")
    assert {(r.group_id, r.committed_offset, r.lag) for r in progress.consumer_lag(log, commits).collect()} == {
        ("g", 0, 4), ("h", 2, 2)}


@pytest.mark.parametrize("block", [1, 4, 10**6])
def test_offset_gaps(spark, block):
    offsets = [0, 1, 4, 5, 6, 17, 18, 40]
    log = log_of(spark, *itertools.product((0, 1), offsets), (2, 3))
    gaps = sorted(progress.offset_gaps(log, block_offsets=block).select(
        "partition", "first_missing", "last_missing", "missing").collect())
    assert gaps == [(p, *g) for p in (0, 1) for g in ((2, 3, 2), (7, 16, 10), (19, 39, 21))]


def test_delivery_audit(spark):
    accepted = spark.createDataFrame([(k,) for k in "abc"], "payment_id string")
    delivered = spark.createDataFrame([(k,) for k in "aabx"], "payment_id string")
    issues = {r.payment_id: r.issue for r in progress.delivery_audit(accepted, delivered).collect()}
    assert issues == {"a": "duplicated", "c": "lost", "x": "not_accepted"}


def test_twenty_accepted_twenty_delivered(spark):
    twenty = spark.range(20).select(F.col("id").cast("string").alias("payment_id"))
    assert progress.delivery_audit(twenty, twenty).count() == 0


def test_order_inversions(spark):
    df = deliveries(spark, ("a", D + "00:00:05"), ("a", D + "00:00:04"), ("b", D + "00:00:01"), ("a", D + "00:00:06"))
    assert [r.offset for r in progress.order_inversions(df, "key", block_offsets=1).collect()] == [1]
