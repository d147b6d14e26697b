"""What a consumer remembers between batches, laid out by time, so that a batch opens what it needs and no more.

* `processed_messages`: accepted keys by hour and key bucket. Once an hour is over, the next batch writes it again as
  `ledger_hours`, one file for each bucket, so the number of files does not follow the number of batches.
* `waiting`: payments that wait for a retry, by the minute they are due: a calendar queue. A batch opens the minutes since
  the batch before it; what is due later costs it nothing.
* `waiting_keys`: their keys by due hour and key bucket, for the look-up of second deliveries.
* `clock` and `tries`: one row with the batch's instant and the last hour rewritten, and the committed tries that the open
  folders may hold. Both are written whole by every batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from spendwatch import schemas
from spendwatch.functions.identifiers import dedup_key
from spendwatch.sinks.transactional import committed_try
from spendwatch.sources.tables import last_committed, read_calendar, read_snapshot

BUCKETS = 16
MICROS, MINUTE, HOUR = 1_000_000, 60_000_000, 3600_000_000

WAITING = StructType([*schemas.ATTEMPTS.fields, StructField("next_attempt_at", TimestampType(), True)])
WAITING_KEYS = StructType([
    StructField("message_key", StringType(), True), StructField("next_attempt_at", TimestampType(), True)])
CLOCK = StructType([
    StructField("at_micros", LongType(), True), StructField("closed_hour", LongType(), True),
    StructField("closes", BooleanType(), True)])
TRIES = StructType([
    StructField("tried_batch", LongType(), True), StructField("tried_id", StringType(), True),
    StructField("hour", LongType(), True), StructField("closes", BooleanType(), True)])

_HOUR, _BUCKET = StructField("hour", LongType(), True), StructField("bucket", IntegerType(), True)
KEYED = StructType([*schemas.PROCESSED_MESSAGES.fields, _HOUR, _BUCKET])
BY_MINUTE = StructType([*WAITING.fields, StructField("due_minute", LongType(), True)])
KEYS_BY_HOUR = StructType([*WAITING_KEYS.fields, _HOUR, _BUCKET])
CALENDAR = {
    "processed_messages": ["hour", "bucket"], "ledger_hours": ["hour", "bucket"], "waiting_keys": ["hour", "bucket"],
    "waiting": ["due_minute"]}
TABLES = {"processed_messages": KEYED, "ledger_hours": KEYED, "waiting": BY_MINUTE, "waiting_keys": KEYS_BY_HOUR,
          "clock": CLOCK, "tries": TRIES}


def bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


@dataclass
class Memory:
    """The state that the committed batch before left, and the instant of this one, in microseconds."""

    spark: SparkSession
    root: str
    at: int
    before: int | None
    closed_hour: int | None
    tries: DataFrame

    @classmethod
    def load(cls, spark: SparkSession, root: str, batch_id: int, now: int) -> "Memory":
        last = last_committed(spark, root, batch_id)
        clock = read_snapshot(spark, root, "clock", CLOCK, last).first()
        tries = read_snapshot(spark, root, "tries", TRIES, last)
        if clock is None:
            return cls(spark, root, now, None, None, tries)
        # The batch before is not in its own list; its marker names its try.
        own = spark.createDataFrame(
            [(last, committed_try(spark, root, last), clock.at_micros // HOUR, clock.closes)], TRIES)
        return cls(spark, root, max(now, clock.at_micros), clock.at_micros, clock.closed_hour, tries.unionByName(own))

    @property
    def hour(self) -> int:
        return self.at // HOUR

    @property
    def instant(self) -> Column:
        return F.timestamp_micros(F.lit(self.at))

    def _read(self, name: str, schema: StructType, column: str, low: int, high: int) -> DataFrame:
        rows = read_calendar(self.spark, self.root, name, schema, column, low, high)
        tried = self.tries.select(F.col("tried_batch").alias("batch_id"), F.col("tried_id").alias("try_id"))
        return rows.join(tried, ["batch_id", "try_id"], "left_semi")

    def processed(self, since: int, buckets: list[int]) -> DataFrame:
        """message_key of what was processed after `since`, in these key buckets."""
        low, closed = since // HOUR, -1 if self.closed_hour is None else self.closed_hour
        own = F.col("bucket").isin(buckets) & (F.col("processed_at") > F.timestamp_micros(F.lit(since)))
        old = self._read("ledger_hours", KEYED, "hour", low, closed).where(own)
        new = self._read("processed_messages", KEYED, "hour", max(low, closed + 1), self.hour).where(own)
        return old.select("message_key").unionByName(new.select("message_key"))

    def waiting_keys(self, longest_wait: int, buckets: list[int]) -> DataFrame:
        """message_key of payments that are due after this batch, in these key buckets."""
        rows = self._read("waiting_keys", KEYS_BY_HOUR, "hour", self.hour,
                          (self.at + longest_wait + 1) // HOUR)
        return rows.where(F.col("bucket").isin(buckets) & (F.col("next_attempt_at") > self.instant)).select("message_key")

    def due(self) -> DataFrame:
        """Waiting payments that have become due since the batch before."""
        if self.before is None:
            return self.spark.createDataFrame([], WAITING)
        rows = self._read("waiting", BY_MINUTE, "due_minute", self.before // MINUTE, self.at // MINUTE)
        after = F.col("next_attempt_at") > F.timestamp_micros(F.lit(self.before))
        return rows.where(after & (F.col("next_attempt_at") <= self.instant)).select(*WAITING.fieldNames())

    def tables(self, processed: DataFrame, again: DataFrame, ttl: int, longest_wait: int) -> dict[str, DataFrame]:
        """What this batch leaves: `processed` rows of the ledger, `again` payments that wait, clock and tries."""
        # A payment that fails now is due after this batch, whatever its delay.
        later = F.greatest("next_attempt_at", F.timestamp_micros(F.lit(self.at + 1)))
        again = again.withColumn("next_attempt_at", later)
        keys = again.select(dedup_key(F.col("payment_id")).alias("message_key"), "next_attempt_at")
        closed = self.hour - 1 if self.closed_hour is None else self.closed_hour
        closes = self.hour - 1 > closed
        over = self._read("processed_messages", KEYED, "hour", closed + 1, self.hour - 1)
        recent = F.col("hour") >= self.hour - 2 - longest_wait // HOUR
        remembered = F.col("closes") & (F.col("hour") >= self.hour - 2 - ttl // HOUR)
        return {
            "processed_messages": processed.withColumns({"hour": F.lit(self.hour), "bucket": bucket(F.col("message_key"))}),
            "ledger_hours": over.select(*KEYED.fieldNames()),
            "waiting": again.withColumn("due_minute", _unit("next_attempt_at", MINUTE)),
            "waiting_keys": keys.withColumns({
                "hour": _unit("next_attempt_at", HOUR), "bucket": bucket(F.col("message_key"))}),
            "clock": self.spark.createDataFrame([(self.at, self.hour - 1, closes)], CLOCK),
            "tries": self.tries.where(recent | remembered),
        }


def _unit(ts: str, micros: int) -> Column:
    return F.call_function("div", F.unix_micros(ts), F.lit(micros))
