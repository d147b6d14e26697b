from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendwatch.functions.amounts import decode_amount, encode_amount, to_cents
from spendwatch.functions.hashing import key_partition, murmur2
from spendwatch.functions.identifiers import dedup_key, derived_uuid
from spendwatch.functions.risk import risk_level
from spendwatch.functions.times import from_millis, to_millis
from spendwatch.operators.partitioning import assign_partition

AMOUNTS = [
    ("16E360", "15000.00"), ("01", "0.01"), ("00", "0.00"), ("80", "-1.28"), ("FF", "-0.01"),
    ("0DE0B6B3A763FFFF", "9999999999999999.99"), ("F21F494C589C0001", "-9999999999999999.99"),
    ("0080", "1.28"), ("FF7F", "-1.29"),
]


@pytest.mark.parametrize("digits,expected", AMOUNTS)
def test_decode_amount(spark, digits, expected):
    row = spark.range(1).select(decode_amount(F.unhex(F.lit(digits))).alias("a")).first()
    assert row.a == Decimal(expected)


@pytest.mark.parametrize("digits", ["", "00112233445566778899", "7FFFFFFFFFFFFFFF"])
def test_undecodable_amounts_are_null(spark, digits):
    assert spark.range(1).select(decode_amount(F.unhex(F.lit(digits))).alias("a")).first().a is None


def test_encode_gives_the_shortest_form(spark):
    rows = spark.createDataFrame(AMOUNTS, "digits string, amount string").select(
        "digits", F.hex(encode_amount(F.col("amount").cast("decimal(18,2)"))).alias("encoded")).collect()
    assert all(r.digits == r.encoded for r in rows)


def test_to_cents_rounds_half_up(spark):
    rows = spark.sql("SELECT * FROM VALUES (1.005BD), (1.004BD), (-1.005BD) AS t(x)")
    assert [r[0] for r in rows.select(to_cents(F.col("x"))).collect()] == [
        Decimal("1.01"), Decimal("1.00"), Decimal("-1.01")]


def test_millis_round_trip(spark):
    row = spark.range(1).select(to_millis(from_millis(F.lit(1767225600123))).alias("m")).first()
    assert row.m == 1767225600123


MURMUR = {
    "21": -973932308, "foobar": -790332482, "a-little-bit-long-string": -985981536,
    "a-little-bit-longer-string": -1486304829, "lkjh234lh9fiuh90y23oiuhsafujhadof229phr9h19h89h8": -58897971,
    "abc": 479470107, "user-1": 1404122828, "user-42": 1459644460, "user-999": -1467781202,
    "fraud-test-user": 509698423, "retry-test-user": 685584192,
}


def test_murmur2_vectors(spark):
    df = spark.createDataFrame([(k,) for k in MURMUR], "k string")
    assert {r.k: r.h for r in df.select("k", murmur2(F.col("k")).alias("h")).collect()} == MURMUR


def _murmur2_bytes(data: bytes) -> int:
    m, mask = 0x5BD1E995, 0xFFFFFFFF
    h = 0x9747B28C ^ len(data)
    for i in range(0, len(data) - 3, 4):
        k = int.from_bytes(data[i:i + 4], "little") * m & mask
        k = (k ^ k >> 24) * m & mask
        h = (h * m & mask) ^ k
    tail = data[len(data) // 4 * 4:]
    if tail:
        h = (h ^ int.from_bytes(tail, "little")) * m & mask
    h = (h ^ h >> 13) * m & mask
    h ^= h >> 15
    return h - 2**32 if h >= 2**31 else h


def test_murmur2_against_brute_force(spark):
    keys = [chr(97 + i % 26) * i for i in range(70)] + ["é€x", "ключ-7", "日本語テキスト", "𝄞clef"]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", murmur2(F.col("k")).alias("h"))
    assert {r.k: r.h for r in df.collect()} == {k: _murmur2_bytes(k.encode()) for k in keys}


ASSIGNED = [
    ("user-1", "15000.00", 0, 0), ("user-1", "50.00", 2, 2), ("user-42", "249.99", 4, 4),
    ("user-999", "25000.00", 0, 0), ("user-999", "50.00", 2, 0), ("fraud-test-user", "3200.00", 1, 1),
    ("retry-test-user", "50.00", 0, 0), ("user-1", "10000.00", 2, 2), ("user-1", None, 2, 2),
]


def test_partition_assignment(spark):
    df = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(ASSIGNED)],
        "payment_id int, user_id string, amount string, coded int, kafka int",
    ).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    df = assign_partition(df, into="a")
    df = assign_partition(df, mode="kafka", into="b")
    assert all((r.a, r.b) == (r.coded, r.kafka) for r in df.collect())


def test_rows_without_key_are_spread_and_stable(spark):
    df = spark.range(1000).select(
        F.col("id").alias("payment_id"), F.lit(None).cast("string").alias("user_id"),
        F.lit(1).cast("decimal(18,2)").alias("amount"))
    first = assign_partition(df).select("payment_id", "partition").collect()
    assert sorted(first) == sorted(assign_partition(df).select("payment_id", "partition").collect())
    assert {r.partition for r in first} == set(range(6))


def test_hash_of_the_smallest_int_goes_to_partition_0(spark, monkeypatch):
    monkeypatch.setattr("spendwatch.functions.hashing.murmur2", lambda key: F.lit(-(2**31)).cast("int"))
    assert spark.range(1).select(key_partition(F.lit("k"), 6).alias("p")).first().p == 0


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        key_partition(F.lit("k"), 6, "other")


def test_derived_ids_are_stable_and_separate(spark):
    row = spark.range(1).select(
        derived_uuid("payment", F.lit(7)).alias("a"), derived_uuid("payment", F.lit("7")).alias("b"),
        derived_uuid("outbox", F.lit(7)).alias("c"), dedup_key(F.lit("x")).alias("d")).first()
    assert row.a == row.b != row.c and len(row.a) == 36 and row.d == "payment-event:x"


def test_risk_level_bounds_are_inclusive(spark):
    rows = spark.createDataFrame(
        [("22499.99", "MEDIUM"), ("22500.00", "HIGH"), ("29999.99", "HIGH"), ("30000.00", "CRITICAL")],
        "total string, expected string")
    level = risk_level(F.col("total").cast("decimal(28,2)"), "15000")
    assert all(r.expected == r.level for r in rows.withColumn("level", level).collect())
