"""Payment-shaped views of the test tables.

The tables hold no payments, so `events` stands for the initiated topic, `orders` for the outbox and
`lineitem` for what its relay sent. Disorder, copies and losses are derived from ids by fixed rules.
Amounts average 50, so the thresholds are scaled down: alert above 150, high value above 100.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spendwatch import settings
from spendwatch.functions.amounts import encode_amount
from spendwatch.functions.times import to_millis
from spendwatch.operators.partitioning import assign_partition
from spendwatch.session import configure

THRESHOLD = "150"
HIGH = "100"
METHODS = {"click": "CARD", "view": "ACH", "signup": "WIRE", "purchase": "WALLET", "error": "UPI"}


# Declared shapes: no schema inference job, and event times load as instants, so that time filters
# reach the scan without a cast in the way.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def every(n: int, column: str = "event_id") -> Column:
    return F.col(column) % n == 0


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The initiated topic with typed amounts; each user's records sit on one of six partitions."""
    method = F.lit(None)
    for event_type, name in METHODS.items():
        method = F.when(F.col("event_type") == event_type, name).otherwise(method)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("p-"), "event_id").alias("payment_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("m-"), F.col("event_id") % 50).alias("merchant_id"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.lit("USD").alias("currency"),
        method.alias("payment_method"),
        F.col("ts").alias("record_ts"),
        F.from_json("props", "map<string,string>").alias("metadata"),
        F.lit(settings.TOPIC_INITIATED).alias("topic"),
        (F.col("user_id") % settings.PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        "event_id", "event_type", "props",
    )


def routed_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same topic with partitions assigned by value and key hash."""
    return assign_partition(payments(spark, sf_dir), high=HIGH)


def disordered(rows: DataFrame, places: int = 40) -> DataFrame:
    """Every 17th record arrives some places later, on a topic with one partition."""
    place = F.col("event_id") * 2 + F.when(every(17), 2 * places + 1).otherwise(0)
    return rows.withColumn("offset", place).withColumn("partition", F.lit(0))


def redelivered(rows: DataFrame) -> DataFrame:
    """Every 11th record once more an hour later, and the first one again with every 3rd record:
    its copies make up about a fourth of all rows."""
    columns = rows.columns
    again = rows.where(every(11)).withColumn("record_ts", F.col("record_ts") + F.expr("INTERVAL 1 HOUR"))
    copies = rows.where(every(3)).withColumn("payment_id", F.lit("p-0"))
    return rows.unionByName(again.select(columns)).unionByName(copies.select(columns))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request bodies as JSON, some broken by rule."""
    def unless(n: int, broken: Column, good: Column) -> Column:
        return F.when(every(n), broken).otherwise(good)

    missing = F.lit(None).cast("string")
    user = unless(23, missing, unless(29, F.lit("   "), unless(31, F.repeat(F.lit("u"), F.lit(65)), F.col("user_id"))))
    body = F.to_json(F.struct(
        user.alias("userId"),
        unless(43, missing, F.col("merchant_id")).alias("merchantId"),
        unless(19, -F.col("amount"), F.col("amount")).alias("amount"),
        unless(37, F.lit(""), unless(41, F.lit("USDX"), F.lit("USD"))).alias("currency"),
        unless(47, F.lit("CASH"), F.col("payment_method")).alias("paymentMethod"),
    ))
    return payments(spark, sf_dir).select(
        F.col("payment_id").alias("request_id"),
        unless(53, F.lit("garbage-payload"), body).alias("value"))


def raw_records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The initiated topic in its two encodings: even ids binary, odd ids JSON; amounts of both signs."""
    rows = payments(spark, sf_dir).withColumn("amount", (F.col("amount") - 40).cast("decimal(18,2)"))
    amount_bytes = (
        F.when(every(26), F.unhex(F.lit("")))
        .when(every(34), F.unhex(F.lit("00112233445566778899")))
        .otherwise(encode_amount(F.col("amount"))))
    binary = rows.where(every(2)).select(
        "payment_id", "user_id", "merchant_id", "currency", "payment_method", "metadata", "offset",
        amount_bytes.alias("amount_bytes"), to_millis(F.col("record_ts")).alias("initiated_millis"))
    body = F.to_json(F.struct(
        F.col("payment_id").alias("paymentId"), F.col("user_id").alias("userId"),
        F.col("merchant_id").alias("merchantId"), "amount",
        F.when(~every(15), F.col("currency")).alias("currency"),
        to_millis(F.col("record_ts")).alias("initiatedTimestamp")))
    json = rows.where(~every(2)).select("offset", body.alias("value"))
    return binary, json


def attempts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Failed attempts on the main topic and on its two retry topics."""
    error = F.when(every(35), "DeserializationException").otherwise("RuntimeException")
    failed = payments(spark, sf_dir).select(
        "payment_id", "event_id", "record_ts", error.alias("error_class"),
        F.concat(F.lit("cannot process "), "event_type").alias("exception_message"),
        F.concat(F.col("topic"), F.lit("."), "event_type").alias("original_topic"))

    def topic(attempt: int, waited: int) -> DataFrame:
        return failed.where(F.col("event_id") % 3 + 1 >= attempt).where(
            (F.lit(attempt) == 1) | ~every(35)
        ).select(
            "payment_id", F.lit(attempt).alias("attempt"),
            (F.col("record_ts") + F.expr(f"INTERVAL {waited} SECONDS")).alias("failed_at"),
            "error_class", "exception_message", "original_topic")

    return topic(1, 0), topic(2, 1), topic(3, 3)


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` as the outbox."""
    status = (
        F.when(F.col("o_orderstatus") == "O", "PENDING")
        .when(F.col("o_orderstatus") == "F", "PUBLISHED").otherwise("FAILED"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), status.alias("status"),
        F.concat(F.lit("topic."), "o_orderpriority").alias("kafka_topic"),
        F.col("o_custkey").cast("string").alias("kafka_key"),
        F.col("o_totalprice").cast("string").alias("payload"),
        F.col("o_orderdate").alias("created_at"),
        F.lit(None).cast("timestamp").alias("published_at"))


def field_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as a field catalog: an order is a subject, a line number a version. Partitioned by subject.

    The number of partitions follows the rows, so that what a task sorts does not grow with the table.
    """
    lines = table(spark, sf_dir, "lineitem")
    tasks = max(-(-lines.count() // settings.CATALOG_TASK_ROWS), spark.sparkContext.defaultParallelism)
    kind = F.element_at(
        F.array(*[F.lit(t) for t in ("int", "long", "string", "bytes", "enum")]),
        (F.col("l_suppkey") % 5 + 1).cast("int"))
    symbols = F.transform(
        F.sequence(F.lit(0), (F.col("l_quantity") % 4).cast("int")), lambda i: F.concat(F.lit("S"), i))
    rows = lines.repartition(tasks, "l_orderkey").select(
        F.col("l_orderkey").alias("subject"), F.col("l_linenumber").alias("version"),
        F.concat(F.lit("f"), F.col("l_partkey") % 3).alias("field"),
        kind.alias("type"), (F.col("l_returnflag") == "N").alias("has_default"),
        F.when(kind == "enum", symbols).alias("symbols"),
        F.when((kind == "enum") & (F.col("l_linestatus") == "O"), "S0").alias("enum_default"))
    # A field name occurs once per version: keep the smallest row.
    return (
        rows.groupBy("subject", "field", "version")
        .agg(F.min(F.struct("type", "has_default", "symbols", "enum_default")).alias("_f"))
        .select("subject", "version", "field", "_f.*"))


def committed_offsets(rows: DataFrame) -> DataFrame:
    """Offset commits of two consumer groups: every 20th record, one group stopping early."""
    slow = F.when(F.col("record_ts") < F.lit("2024-01-20 00:00:00").cast("timestamp"), F.lit("ledger"))
    groups = F.explode(F.array_compact(F.array(F.lit("fraud-monitor"), slow)))
    return rows.where(F.col("event_id") % 20 == 19).select(
        groups.alias("group_id"), "topic", "partition", (F.col("offset") + 1).alias("committed_offset"))
