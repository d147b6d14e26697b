from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from spendwatch.operators import late, ordered, partitioning, windows
from spendwatch.operators.alerts import risk_alerts, risk_summary

D = "2026-01-01 "
FLUSH = ("other", "1.00", D + "01:00:00")


def alerts_of(payments, **options):
    closed = options.pop("closed_only", False)
    blocks = windows.spend_blocks(payments, block_offsets=2, **options)
    spend = windows.spend_of_blocks(blocks)
    graded = risk_alerts(windows.closed_windows(spend, payments) if closed else spend)
    return windows.with_payment_ids(graded, windows.payment_id_blocks(graded, blocks)).collect()


def test_two_payments_make_one_alert(make_payments):
    rows = alerts_of(make_payments(
        ("user-1", "6000", D + "00:00:00"), ("user-1", "9500", D + "00:01:00"), FLUSH), closed_only=True)
    assert len(rows) == 1
    alert = rows[0]
    assert alert.total_amount == Decimal("15500.00") and alert.risk_level == "MEDIUM"
    assert str(alert.window_start) == D + "00:00:00" and str(alert.window_end) == D + "00:05:00"
    assert alert.triggering_payment_ids == ["p0", "p1"]


def test_ids_keep_arrival_order_and_duplicates(make_payments):
    five = [("fraud-test-user", "3200", D + f"00:00:0{i}") for i in range(5)]
    rows = alerts_of(make_payments(*five, FLUSH, ids=["e", "d", "a", "a", "b", "f"]))
    assert [r.triggering_payment_ids for r in rows] == [["e", "d", "a", "a", "b"]]
    assert rows[0].total_amount == Decimal("16000.00") and rows[0].payments == 5


def test_below_and_at_the_threshold_there_is_no_alert(make_payments):
    three = [("u", "3200", D + f"00:00:0{i}") for i in range(3)]
    assert alerts_of(make_payments(*three, ("v", "15000.00", D + "00:00:00"), FLUSH)) == []


def test_levels(make_payments):
    amounts = {"a": "22499.99", "b": "22500.00", "c": "29999.99", "d": "30000.00"}
    payments = make_payments(*[(u, a, D + "00:00:00") for u, a in amounts.items()], FLUSH)
    alerts = risk_alerts(windows.window_spend(payments))
    assert {r.user_id: r.risk_level for r in alerts.collect()} == {
        "a": "MEDIUM", "b": "HIGH", "c": "HIGH", "d": "CRITICAL"}
    assert {r.risk_level: r.alerts for r in risk_summary(alerts).collect()} == {
        "MEDIUM": 1, "HIGH": 2, "CRITICAL": 1}


def test_window_end_is_exclusive(make_payments):
    assert alerts_of(make_payments(
        ("u", "9000", D + "00:04:59.999"), ("u", "9000", D + "00:05:00"), FLUSH)) == []


def test_split_partitions_hide_an_alert_from_partition_scoped_sums(make_payments):
    payments = make_payments(("user-1", "12000", D + "00:00:00"), ("user-1", "4000", D + "00:01:00"), FLUSH)
    routed = partitioning.assign_partition(payments)
    assert len(alerts_of(routed)) == 1
    audit = partitioning.partition_split_audit(routed).collect()
    assert [(r.user_id, r.total, r.largest_partial, r.user_alert, r.split_alert) for r in audit] == [
        ("user-1", Decimal("16000.00"), Decimal("12000.00"), True, False)]


def test_late_rule_at_the_grace_boundary(make_payments):
    within = make_payments(
        ("u", "8000", D + "00:01:00"), ("v", "1", D + "00:05:29.999"), ("u", "8000", D + "00:04:59"))
    exact = make_payments(
        ("u", "8000", D + "00:01:00"), ("v", "1", D + "00:05:30"), ("u", "8000", D + "00:04:59"))
    assert len(alerts_of(within, drop_late=True)) == 1
    assert [r.late for r in late.flag_late(exact).orderBy("offset").collect()] == [False, False, True]
    assert risk_alerts(windows.window_spend(exact, drop_late=True)).count() == 0


def test_lateness_is_judged_per_partition(make_payments):
    payments = make_payments(
        ("u", "8000", D + "00:01:00", 0), ("v", "1", D + "00:30:00", 1), ("u", "8000", D + "00:04:59", 0))
    assert late.late_drop(payments).count() == 3


def test_duplicate_deliveries_count_unless_dedup_is_on(make_payments):
    payments = make_payments(
        ("u", "8000", D + "00:01:00"), ("u", "8000", D + "00:02:00"), FLUSH, ids=["x", "x", "f"])
    assert len(alerts_of(payments)) == 1
    assert risk_alerts(windows.window_spend(payments, dedup=True)).count() == 0


def test_open_windows_are_held_back(make_payments):
    payments = make_payments(("u", "16000", D + "00:01:00"), ("v", "1", D + "00:05:29.999"))
    assert windows.window_spend(payments, closed_only=True).count() == 0
    flushed = make_payments(("u", "16000", D + "00:01:00"), ("v", "1", D + "00:05:30"))
    assert windows.window_spend(flushed, closed_only=True).count() == 1


def test_hopping_windows(make_payments):
    spend = windows.window_spend(make_payments(("u", "5", D + "00:07:30")), slide="1 minute").collect()
    assert sorted(str(r.window_start)[11:] for r in spend) == [f"00:0{m}:00" for m in range(3, 8)]


def test_event_time_column_is_a_parameter(make_payments):
    payments = make_payments(("u", "16000", D + "00:01:00")).withColumn(
        "initiated_ts", F.col("record_ts") + F.expr("INTERVAL 1 HOUR"))
    assert str(windows.window_spend(payments, ts="initiated_ts").first().window_start)[11:] == "01:00:00"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 3000 rows belongs to one user, ids scattered, times jumping back and forth."""
    return spark.range(3000).select(
        F.concat(F.lit("p"), "id").alias("payment_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
            F.concat(F.lit("u"), F.col("id") % 40)).alias("user_id"),
        ((F.col("id") * 7919) % 1000 / 10).cast("decimal(18,2)").alias("amount"),
        F.timestamp_seconds(F.lit(1767225600) + F.col("id") + (F.col("id") * 31) % 700).alias("record_ts"),
        (F.col("id") % 2).cast("int").alias("partition"),
        F.floor(F.col("id") / 2).alias("offset"))


@pytest.mark.parametrize("how,exclusive", [("sum", False), ("max", False), ("max", True), ("sum", True)])
@pytest.mark.parametrize("block", [1, 7, 1000, 10**6])
def test_blocked_running_value_equals_plain_window(skewed, how, exclusive, block):
    window = Window.partitionBy("user_id").orderBy("offset", "partition").rowsBetween(
        Window.unboundedPreceding, -1 if exclusive else 0)
    plain = skewed.dropna(subset=["user_id"]).withColumn("r", getattr(F, how)("amount").over(window)).select("payment_id", "r")
    blocked = ordered.running(
        skewed, ["user_id"], "amount", "r", how, exclusive=exclusive, block_offsets=block)
    assert sorted(plain.collect(), key=lambda r: r.payment_id) == sorted(
        blocked.select("payment_id", "r").collect(), key=lambda r: r.payment_id)


def test_early_signal_marks_each_payment(make_payments):
    rows = windows.early_signal(make_payments(
        ("u", "9000", D + "00:00:00"), ("v", "20000", D + "00:00:30"), ("u", "7000", D + "00:01:00"),
        ("u", "1", D + "00:05:00")), block="10 seconds").orderBy("offset").collect()
    assert [(r.running_total, r.over_threshold) for r in rows] == [
        (Decimal("9000.00"), False), (Decimal("20000.00"), True), (Decimal("16000.00"), True),
        (Decimal("1.00"), False)]


def test_blocks_hold_every_id_once_whatever_their_size(skewed):
    spend = windows.window_spend(skewed, size="1 hour")
    lists = {}
    for block in (1, 100, 10**6):
        blocks = windows.spend_blocks(skewed, size="1 hour", block_offsets=block)
        assert sorted(windows.spend_of_blocks(blocks, "1 hour").collect()) == sorted(spend.collect())
        ids = windows.payment_id_blocks(spend, blocks).collect()
        assert max(len(r.ids) for r in ids) <= 2 * block  # offsets on 2 partitions
        whole = windows.with_payment_ids(spend, windows.payment_id_blocks(spend, blocks)).collect()
        assert len(whole) == spend.count()
        lists[block] = {(r.user_id, r.window_start): r.triggering_payment_ids for r in whole}
    assert lists[1] == lists[100] == lists[10**6]
    assert sum(map(len, lists[1].values())) == skewed.where("user_id IS NOT NULL").count()


def test_ids_follow_the_rows_that_were_summed(make_payments):
    payments = make_payments(("u", "8000", D + "00:00:00"), ("u", "8000", D + "00:00:01"), ("u", "9000", D + "00:00:02"),
                             FLUSH, ids=["p1", "p1", "p2", "f"])
    (alert,) = alerts_of(payments, dedup=True)
    assert (alert.total_amount, alert.triggering_payment_ids) == (Decimal("17000.00"), ["p1", "p2"])
    late_one = make_payments(("u", "16000", D + "00:00:00"), ("v", "1", D + "00:05:30"), ("u", "5", D + "00:00:01"))
    (alert,) = alerts_of(late_one, drop_late=True)
    assert alert.triggering_payment_ids == ["p0"]


def test_every_hop_keeps_its_ids(make_payments):
    payments = make_payments(("u", "16000", D + "00:04:30"))
    assert [r.triggering_payment_ids for r in alerts_of(payments, slide="1 minute")] == [["p0"]] * 5


def test_order_is_time_then_partition_then_offset(make_payments):
    payments = make_payments(("u", "9000", D + "00:00:04", 0), ("u", "9000", D + "00:00:01", 3), ("u", "1", D + "00:00:01", 1))
    (alert,) = alerts_of(payments)
    assert alert.triggering_payment_ids == ["p2", "p1", "p0"]
    running = windows.early_signal(payments, block="1 second").orderBy("record_ts", "partition").collect()
    assert [str(r.running_total) for r in running] == ["1.00", "9001.00", "18001.00"]


def plain_running(rows):
    total, want = {}, {}
    for r in sorted(rows, key=lambda r: (r.record_ts, r.partition, r.offset)):
        key = r.user_id, r.record_ts.timestamp() // 300
        total[key] = want[r.payment_id] = total.get(key, 0) + r.amount
    return want


@pytest.mark.parametrize("instants", [1, 20, 5000])
def test_running_totals_of_a_crowded_minute(spark, instants):
    """A third of all payments is one user's, in one minute and down to one instant: no block is large."""
    rows = spark.range(9000).select(
        F.format_string("p%d", "id").alias("payment_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("u%d", F.col("id") % 40)).alias("user_id"),
        (F.col("id") % 97 + 1).cast("decimal(18,2)").alias("amount"),
        F.timestamp_micros(F.lit(1_735_689_600_000_000) + F.when(F.col("id") % 3 == 0, F.col("id") % instants)
                           .otherwise(F.pmod(F.col("id") * 7919, F.lit(600)) * 1_000_000)).alias("record_ts"),
        (F.col("id") % 5).cast("int").alias("partition"), F.col("id").alias("offset"))
    want = plain_running(rows.collect())
    for block_rows in (16, 160, 10**6):
        done = windows.early_signal(rows, block_rows=block_rows)
        assert done.columns == [*rows.columns, "window_start", "running_total", "over_threshold"]
        assert {r.payment_id: r.running_total for r in done.collect()} == want
    keyed = windows.with_window_start(rows)
    order = ("record_ts", "partition", "offset")
    cut = ordered.even_blocks(keyed, windows.GROUP, order, 160, "cut")
    sizes = [r["count"] for r in cut.groupBy(*windows.GROUP, "cut").count().where("user_id = 'hot'").collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 4 * 160 and 3000 / 160 / 2 < len(sizes) < 3000 / 160 * 2
    numbers = [r.cut for r in cut.where("user_id = 'hot'").orderBy(*order).collect()]
    assert numbers == sorted(numbers)


def test_even_blocks_of_nulls_and_copies(make_payments):
    rows = make_payments(("u", "1", D + "00:00:00"), ("u", "2", D + "00:00:01"), ("u", "4", D + "00:00:02"))
    rows = rows.unionAll(rows).withColumn("offset", F.when(F.col("offset") != 1, F.col("offset")))
    cut = ordered.even_blocks(rows, ["user_id"], ("record_ts", "offset"), 1, "cut")
    assert cut.count() == 6 and cut.columns == [*rows.columns, "cut"]
    assert ordered.even_blocks(rows.limit(0), ["user_id"], ("offset",), 5, "cut").collect() == []


def test_topics_have_their_own_stream_time(make_payments):
    payments = make_payments(("u", "1", D + "00:00:00"), ("u", "1", D + "01:00:00"), ("u", "1", D + "00:00:02")).withColumn(
        "topic", F.when(F.col("offset") == 1, "a").otherwise("b"))
    assert not late.flag_late(payments).where("late").collect()


@pytest.mark.parametrize("block", [3, 10**6])
def test_late_flag_equals_brute_force(skewed, block):
    newest, expected = {}, {}
    for r in skewed.orderBy("offset").collect():
        seen = newest[r.partition] = max(newest.get(r.partition, r.record_ts), r.record_ts)
        end = r.record_ts.timestamp() // 300 * 300 + 300
        expected[r.payment_id] = end <= seen.timestamp() - 30
    flagged = late.flag_late(skewed, block_offsets=block).collect()
    assert {r.payment_id: r.late for r in flagged} == expected
    assert 0 < sum(expected.values()) < 3000


def test_payments_without_a_user_take_no_part(make_payments):
    payments = make_payments((None, "20000", D + "00:00:00"), ("u", "20000", D + "00:00:00"))
    assert [r.user_id for r in windows.window_spend(payments).collect()] == ["u"]
    assert [r.user_id for r in windows.early_signal(payments).collect()] == ["u"]


def test_partition_skew_counts(make_payments):
    payments = make_payments(("u", "20000", D + "00:00:00", 0), ("v", "5", D + "00:00:00", 0), ("w", "7", D + "00:00:00", 3))
    assert sorted(partitioning.partition_skew(payments).collect()) == [
        (0, 2, 1, Decimal("20005.00")), (3, 1, 0, Decimal("7.00"))]
