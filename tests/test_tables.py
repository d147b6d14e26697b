from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import ts
from spendwatch import schemas
from spendwatch.operators import compatibility, evolution, intake, landing, outbox, quarantine, upkeep
from spendwatch.plans import views
from spendwatch.plans.queries import QUERIES
from spendwatch.sinks import topics as topic_sink, transactional
from spendwatch.sources import requests as request_source, tables, topics as topic_source

D = "2026-01-01 "


def checked(spark, *bodies):
    df = spark.createDataFrame([(b,) for b in bodies], "value string")
    return [(r.accepted, r.reject_reasons) for r in intake.check_payments(intake.parse_intake(df)).collect()]


@pytest.mark.parametrize("body,reasons", [
    ('{"userId":"user-42","merchantId":"merchant-7","amount":249.99,"currency":"USD"}', []),
    ('{"userId":"user-999","merchantId":"merchant-1","amount":25000.00,"currency":"USD"}', []),
    ('{"userId":"user-1","merchantId":"m","amount":-50.00,"currency":"USD"}', ["amount:not_positive"]),
    ('{"merchantId":"m","amount":100.00,"currency":"USD"}', ["userId:blank"]),
    ('{"userId":"u","merchantId":"m","amount":0,"currency":"USD"}', ["amount:not_positive"]),
    ('{"userId":"u","merchantId":"m","currency":"USD"}', ["amount:missing"]),
    ('{"userId":"u","merchantId":" \\t","amount":1,"currency":""}', ["merchantId:blank", "currency:blank"]),
    ('{"userId":"u","merchantId":"m","amount":1,"currency":"USDX"}', ["currency:too_long"]),
    ('{"userId":"%s","merchantId":"m","amount":1,"currency":"USD"}' % ("u" * 65), ["userId:too_long"]),
    ('{"userId":"%s","merchantId":"m","amount":1,"currency":"USD"}' % ("u" * 64), []),
    ('{"userId":"u","merchantId":"m","amount":1,"currency":"USD","paymentMethod":"CASH"}', ["paymentMethod:unknown"]),
    ('{"userId":"u","merchantId":"m","amount":1,"currency":"USD","paymentMethod":"UPI"}', []),
    ("garbage-payload", ["body:unreadable"]),
])
def test_intake_rules(spark, body, reasons):
    assert checked(spark, body) == [(not reasons, reasons)]


def test_validate_splits_without_losing_rows(spark):
    df = spark.createDataFrame([("u", "m", "5", "USD"), ("", "m", "5", "USD")],
                               "user_id string, merchant_id string, amount string, currency string")
    good, bad = intake.validate_payments(df.withColumn("amount", F.col("amount").cast("decimal(18,2)")))
    assert good.count() == 1 and bad.first().reject_reasons == ["userId:blank"]


def test_poison_records_do_not_stop_the_next_one(spark):
    df = spark.createDataFrame(
        [("poison-key", "garbage-payload"), ("k", '{"paymentId":"p","userId":"u"}'), ("k", '{"paymentId":"p"'),
         ("k", None), ("k", '{"paymentId":"p"}'), ("k", '{"paymentId":"p","userId":"u","initiatedTimestamp":"x"}')],
        "key string, value string")
    good, bad = quarantine.split_poison(df, schemas.EVENT_JSON, required=("userId",))
    assert [r.paymentId for r in good.collect()] == ["p"]
    assert [r.poison_reason for r in bad.collect()] == [
        "undecodable", "undecodable", "empty", "missing:userId", "undecodable"]


def test_both_encodings_land_in_one_table(spark):
    binary = spark.createDataFrame(
        [("a", "u", "m", None, "CARD", bytearray.fromhex("16E360"), 1767225600000, {"k": "v"}),
         ("b", "u", "m", "EUR", "CARD", bytearray(), 1767225600000, None),
         ("c", "u", "m", "EUR", "CARD", bytearray(9), 1767225600000, None)],
        "payment_id string, user_id string, merchant_id string, currency string, payment_method string, "
        "amount_bytes binary, initiated_millis long, metadata map<string,string>")
    json = spark.createDataFrame(
        [('{"paymentId":"d","userId":"u","merchantId":"m","amount":1.50,"currency":"USD","initiatedTimestamp":1767225600000}',),
         ("nope",), ('{"paymentId":"e","merchantId":"m","amount":1.50,"initiatedTimestamp":1}',)], "value string")
    good, bad = landing.typed_landing(binary, json)
    rows = {r.payment_id: r for r in good.collect()}
    assert good.schema.fieldNames() == schemas.PAYMENTS_INITIATED.fieldNames()
    assert rows["a"].amount == Decimal("15000.00") and rows["a"].currency == "USD" and rows["a"].metadata == {"k": "v"}
    assert rows["d"].payment_method is None and rows["d"].initiated_ts == ts(D + "00:00:00")
    assert sorted((r.payment_id or "", r.poison_reason) for r in bad.collect()) == [
        ("", "undecodable"), ("b", "amount:undecodable"), ("c", "amount:undecodable"), ("e", "missing:user_id")]


def test_outbox_row_mirrors_the_payment(spark):
    request = spark.createDataFrame(
        [("r1", "u", "m", Decimal("12.50"), "USD", ts(D + "00:00:00.123"))],
        "request_id string, user_id string, merchant_id string, amount decimal(18,2), currency string, record_ts timestamp")
    payments = outbox.payment_rows(request, "request_id")
    row = outbox.outbox_rows(payments)
    assert row.schema.fieldNames() == schemas.OUTBOX.fieldNames()
    assert payments.schema.fieldNames() == schemas.PAYMENTS.fieldNames()
    event = row.select("*", F.from_json("payload", schemas.EVENT_JSON).alias("e")).first()
    payment = payments.first()
    assert event.aggregate_id == event.e.paymentId == payment.id != event.id
    assert event.e.amount == Decimal("12.50") and event.e.initiatedTimestamp == 1767225600123
    assert (event.status, event.kafka_key, payment.status) == ("PENDING", "u", "INITIATED")


def outbox_table(spark, count, status="PENDING"):
    return spark.range(count).select(
        F.format_string("id-%04d", "id").alias("id"), F.lit(status).alias("status"),
        F.timestamp_seconds(F.lit(2000) - F.col("id")).alias("created_at"),
        F.lit(None).cast("timestamp").alias("published_at"))


def test_a_poll_takes_the_oldest_hundred(spark):
    page = [r.id for r in outbox.next_page(outbox_table(spark, 150)).collect()]
    assert page == [f"id-{i:04}" for i in range(149, 49, -1)]


def test_published_rows_leave_the_queue_and_failed_sends_stay(spark):
    table = outbox_table(spark, 3)
    marks = outbox.published_marks(table.where("id <> 'id-0001'"), F.lit(D + "00:00:00").cast("timestamp"))
    current = outbox.current_outbox(table, marks)
    assert [r.id for r in outbox.pending(current).collect()] == ["id-0001"]
    assert outbox.signalled(current, table).count() == 1


def test_reconcile(spark):
    table = outbox_table(spark, 3, "PUBLISHED").unionByName(
        outbox_table(spark, 5).where("id IN ('id-0003', 'id-0004')"))
    sent = spark.createDataFrame([(i,) for i in ("id-0000", "id-0001", "id-0001", "id-0004", "id-9999")], "id string")
    rows = outbox.reconcile(table, sent, F.timestamp_seconds(F.lit(2000))).collect()
    assert {r.id: (r.issue, r.copies, r.pending_seconds) for r in rows} == {
        "id-0001": ("published_twice", 2, None), "id-0002": ("missing_on_topic", 0, None),
        "id-0003": ("pending", 0, 3), "id-0004": ("sent_not_marked", 1, 4), "id-9999": ("not_in_outbox", 1, None)}


def balances(spark, *rows):
    return spark.createDataFrame(
        [(u, v and Decimal(v), 0, i, ts(at)) for i, (u, v, at) in enumerate(rows)],
        "user_id string, balance decimal(18,2), partition int, offset long, record_ts timestamp")


def test_latest_balance_and_tombstones(spark):
    log = balances(spark, ("user-1", "100.00", D + "00:00:00"), ("user-1", "250.00", D + "00:01:00"),
                   ("user-2", "5.00", D + "00:01:00"), ("user-1", "999.00", D + "00:02:00"),
                   ("user-2", None, D + "00:03:00"), ("user-3", None, "2025-12-30 00:00:00"))
    latest = upkeep.latest_by_key(log, "user_id", "balance").collect()
    assert [(r.user_id, r.balance) for r in latest] == [("user-1", Decimal("999.00"))]
    kept = upkeep.compact(log, "user_id", "balance", F.lit(D + "12:00:00").cast("timestamp"))
    assert {r.user_id: r.balance for r in kept.collect()} == {"user-1": Decimal("999.00"), "user-2": None}
    assert kept.columns == log.columns


def test_time_retention_bounds(spark):
    log = balances(spark, ("a", "1", "2025-12-25 00:00:00"), ("b", "1", "2025-12-24 23:59:59"))
    as_of = F.lit(D + "00:00:00").cast("timestamp")
    assert [r.user_id for r in upkeep.retain_time(log, as_of).collect()] == ["a"]
    assert upkeep.retain_time(log, as_of, max_age="30 days").count() == 2


def test_time_retention_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    balances(spark, ("a", "1", D + "00:00:00")).write.parquet(path)
    df = upkeep.retain_time(spark.read.parquet(path), F.lit(D + "00:00:00").cast("timestamp"))
    assert "GreaterThanOrEqual(record_ts" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block", [1, 10, 10**6])
@pytest.mark.parametrize("limit", [0, 1, 57, 400, 10**9])
def test_size_retention_equals_brute_force(spark, block, limit):
    log = spark.range(120).select(
        F.lit("t").alias("topic"), F.when(F.col("id") % 3 == 0, 0).otherwise(1).alias("partition"),
        F.col("id").alias("offset"), (F.col("id") * 7 % 11).cast("int").alias("bytes"))
    expected, used = set(), {0: 0, 1: 0}
    for r in log.orderBy(F.desc("offset")).collect():
        used[r.partition] += r.bytes
        if used[r.partition] <= limit:
            expected.add(r.offset)
    kept = upkeep.retain_bytes(log, "bytes", limit, block_offsets=block)
    assert sorted(r.offset for r in kept.collect()) == sorted(expected)


def test_size_retention_of_shared_offsets_null_sizes_and_null_partitions(spark):
    log = spark.createDataFrame(
        [("t", None, 0, 5), ("t", None, 1, 5), ("t", None, 2, None), ("t", 1, 7, 4), ("t", 1, 7, 4), ("t", 1, 8, 3)],
        "topic string, partition int, offset long, bytes int")

    def kept(limit, block=1):
        rows = upkeep.retain_bytes(log, "bytes", limit, block_offsets=block).collect()
        return sorted((r.partition or 0, r.offset) for r in rows)
    for block in (1, 100):
        assert kept(7, block) == [(0, 1), (0, 2), (1, 8)]  # one row of offset 7 would fit, two do not
        assert kept(11, block) == [(0, 0), (0, 1), (0, 2), (1, 7), (1, 7), (1, 8)]
    assert upkeep.retain_bytes(log.limit(0), "bytes", 1).collect() == []


def test_size_retention_shuffles_no_kept_row(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.range(50).selectExpr("'t' AS topic", "0 AS partition", "id AS offset", "1 AS bytes", "'x' AS payload").write.parquet(path)
    plan = upkeep.retain_bytes(spark.read.parquet(path), "bytes", 10)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Scan parquet" in line]
    assert len(shuffles) == 3 and sum("payload" in line for line in shuffles) == 1
    assert "payload" not in plan[plan.index("Exchange"):]


def test_uncommitted_batches_are_invisible(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = spark.createDataFrame([("u", Decimal("1.00"))], schemas.BALANCES)
    transactional.create_tables(spark, root, {"a": schemas.BALANCES, "b": schemas.BALANCES})
    for name in ("a", "b"):  # a batch that dies before its marker
        rows.write.parquet(f"{root}/{name}/batch_id=0/try_id=dead")
    visible = lambda name: tables.read_table(spark, root, name, schemas.BALANCES).count()
    assert (visible("a"), visible("b")) == (0, 0)
    for _ in range(2):  # the replay, and a replay of the replay
        transactional.write_batch(spark, root, 0, {"a": rows, "b": rows})
    assert (visible("a"), visible("b")) == (1, 1)


def test_a_replay_of_a_committed_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = spark.createDataFrame([("u", Decimal("1.00"))] * 3, schemas.BALANCES)
    transactional.write_batch(spark, root, 0, {"a": rows, "b": rows})
    broken = rows.select("user_id", F.raise_error(F.lit("dies")).cast("decimal(18,2)").alias("balance"))
    for other in (rows.limit(1), broken):  # a replay that would write less, and one that dies midway
        transactional.write_batch(spark, root, 0, {"a": rows.limit(1), "b": other})
    assert [tables.read_table(spark, root, n, schemas.BALANCES).count() for n in ("a", "b")] == [3, 3]
    with pytest.raises(Exception):  # noqa: B017  dies before its marker, then runs again
        transactional.write_batch(spark, root, 1, {"a": rows, "b": broken})
    transactional.write_batch(spark, root, 1, {"a": rows, "b": rows})
    assert [tables.read_table(spark, root, n, schemas.BALANCES).count() for n in ("a", "b")] == [6, 6]


def test_compaction_keeps_maps(spark):
    log = balances(spark, ("a", "1", D + "00:00:00"), ("a", "2", D + "00:00:01")).withColumn(
        "metadata", F.create_map(F.lit("k"), F.col("balance").cast("string")))
    kept = upkeep.compact(log, "user_id", "balance", F.lit(D + "12:00:00").cast("timestamp")).collect()
    assert [(r.balance, r.metadata) for r in kept] == [(Decimal("2.00"), {"k": "2.00"})]


BASE = [("paymentId", "string", False, None), ("amount", "bytes", False, None),
        ("metadata", "map", True, None), ("method", "enum", False, ["CARD", "ACH"])]


def changed(**changes):
    fields = {f[0]: f for f in BASE}
    fields.update(changes)
    return [f for f in fields.values() if f]


@pytest.mark.parametrize("new,strict,backward,forward", [
    (changed(device=("device", "string", True, None)), False, True, True),
    (changed(amount=("amount", "string", False, None), metadata=None), False, True, True),
    (changed(amount=("amount", "string", False, None), metadata=None), True, False, False),
    (changed(amount=("amount", "long", False, None)), False, False, False),
    (changed(extra=("extra", "string", False, None)), False, False, True),
    (changed(paymentId=None), False, True, False),
    (changed(method=("method", "enum", False, ["CARD", "ACH", "UPI"])), False, True, False),
    (changed(method=("method", "enum", False, ["CARD"])), False, False, True),
    (changed(), False, True, True),
])
def test_schema_changes(spark, new, strict, backward, forward):
    rows = [("s", v, *f, None) for v, fields in ((1, BASE), (2, new)) for f in fields]
    verdicts = compatibility.schema_verdict(spark.createDataFrame(rows, schemas.FIELD_CATALOG), strict).collect()
    assert [(r.version, r.backward, r.forward) for r in verdicts] == [(2, backward, forward)]


def test_deleted_versions_and_enum_defaults(spark):
    symbols = [["CARD", "ACH"], ["CARD"], ["CARD", "UPI"]]
    rows = [("s", v, "method", "enum", False, s, default) for v, s, default in zip((1, 3, 7), symbols, (None, "CARD", None))]
    verdicts = compatibility.schema_verdict(spark.createDataFrame(rows, schemas.FIELD_CATALOG)).orderBy("version").collect()
    # 1 -> 3 drops a symbol, but version 3 has a default for it; 3 -> 7 adds one, which version 3 reads as its default.
    assert [(r.version, r.backward, r.forward) for r in verdicts] == [(3, True, True), (7, True, True)]


def lineitem(spark, folder, orders=100):
    """Four versions of each order, two fields each; returns the folder of the tables."""
    spark.range(orders * 8).selectExpr(
        "id div 8 AS l_orderkey", "id AS l_partkey", "id * 7 AS l_suppkey", "CAST(id % 4 + 1 AS int) AS l_linenumber",
        "CAST(id % 50 AS double) AS l_quantity", "IF(id % 3 = 0, 'N', 'R') AS l_returnflag",
        "IF(id % 2 = 0, 'O', 'F') AS l_linestatus", "TIMESTAMP '2024-01-01 00:00:00' AS l_shipdate",
    ).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_a_field_catalog_has_as_many_partitions_as_its_rows_ask_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("spendwatch.settings.CATALOG_TASK_ROWS", 20, raising=False)
    assert views.field_catalog(spark, lineitem(spark, tmp_path)).rdd.getNumPartitions() == 40


@pytest.mark.parametrize("name", ["q23_schema_compat", "q23_schema_compat_strict", "q23_deleted_versions"])
def test_verdicts_sort_the_catalog_twice_after_one_shuffle(spark, tmp_path, name):
    plan = QUERIES[name](spark, lineitem(spark, tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("Exchange "), plan.count("Sort [")) == (1, 2)


def test_a_version_without_a_number_comes_first_and_copies_count_once(spark):
    rows = [
        ("s", None, "a", "int", False, None, None),
        ("s", 1, "a", "long", False, None, None), ("s", 1, "a", "int", True, None, None),  # the greater one holds
        ("s", 4, None, "int", None, None, None), ("s", 4, None, "int", None, None, None),
        ("t", 2, "a", "int", False, None, None),
    ]
    catalog = spark.createDataFrame(rows, schemas.FIELD_CATALOG)
    for given in ({}, {"gathered": True}):
        found = compatibility.schema_verdict(catalog.repartition(3, "subject"), **given).orderBy("version").collect()
        # At 4, `a` is dropped (and had no default), and a field is new of which nobody knows whether it has one.
        assert [(r.subject, r.version, r.backward, r.forward, r.verdict) for r in found] == [
            ("s", 1, True, False, "BACKWARD"), ("s", 4, True, False, "BACKWARD")]


def test_versions_read_as_one_table(spark, tmp_path):
    old, new = str(tmp_path / "v1"), str(tmp_path / "v2")
    spark.sql("SELECT 'a' AS payment_id, 'u' AS user_id").write.parquet(old)
    spark.sql("SELECT 'b' AS payment_id, 'u' AS user_id, 'EUR' AS currency, 1 AS unknown_field").write.parquet(new)
    rows = tables.read_versions(spark, [old, new], schemas.PAYMENTS_INITIATED).orderBy("payment_id").collect()
    assert [(r.payment_id, r.currency, r.metadata) for r in rows] == [("a", "USD", None), ("b", "EUR", None)]


def test_declared_defaults(spark):
    empty = spark.range(1)
    processed = evolution.conform(empty, schemas.PAYMENTS_PROCESSED).first()
    alert = evolution.conform(empty, schemas.ALERTS).first()
    assert (processed.currency, processed.risk_score, alert.risk_level) == ("USD", 0.0, "HIGH")


def test_records_are_written_by_partition(spark, tmp_path, make_payments):
    path = str(tmp_path / "topic")
    payments = make_payments(("u", "1", D + "00:00:00", 0), ("v", "2", D + "00:00:00", 4))
    topic_sink.write_by_partition(
        topic_sink.initiated_records(payments, "t", F.col("payment_id")), path)
    back = topic_source.read_topic(spark, path)
    assert sorted((r.topic, r.partition, r.offset, str(r.record_ts), r.key, r.value) for r in back.collect()) == [
        ("t", 0, 0, D + "00:00:00", "u", "p0"), ("t", 4, 1, D + "00:00:00", "v", "p1")]


def test_requests_are_read_as_text(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"userId":"u"}\nbroken\n')
    assert sorted(r.value for r in request_source.read_requests(spark, str(tmp_path / "in")).collect()) == [
        "broken", '{"userId":"u"}']
