"""Retry schedule and dead letters from a table of failed attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spendwatch import settings
from spendwatch.functions.maps import comparable, restored

# The failure class that is worth another attempt, and its public subclasses in the standard library
# that say the same. An illegal argument stays illegal, so it is not among them.
RETRYABLE = (
    "RuntimeException", "IllegalStateException", "UncheckedIOException", "ConcurrentModificationException",
    "RejectedExecutionException", "CompletionException",
)


def is_retryable(error_class: Column, retryable: tuple[str, ...] = RETRYABLE) -> Column:
    """Names match with or without their package. A table has no class hierarchy: subclasses worth a retry must be
    listed in `retryable`."""
    return F.element_at(F.split(error_class, r"[.$]"), -1).isin(*retryable)


def all_attempts(*topics: DataFrame) -> DataFrame:
    """Attempts from the main topic and its retry topics, handled alike."""
    union = topics[0]
    for other in topics[1:]:
        union = union.unionByName(other)
    return union


def retry_state(
    attempts: DataFrame,
    max_attempts: int = settings.MAX_ATTEMPTS,
    delay_seconds: int = settings.RETRY_DELAY_SECONDS,
    multiplier: int = settings.RETRY_MULTIPLIER,
    key: str = "payment_id",
    retryable: tuple[str, ...] = RETRYABLE,
) -> DataFrame:
    """Latest attempt per payment with its disposition and next due time.

    An attempt without an error class succeeded and closes the payment.
    The latest attempt is a map-side combined max, so a payment with many attempts stays cheap.
    """
    rest = [c for c in attempts.columns if c not in (key, "attempt", "failed_at")]
    latest = (
        attempts.groupBy(key)
        .agg(F.max(F.struct("attempt", "failed_at", *comparable(attempts, rest))).alias("_latest"))
        .select(key, *[restored(attempts, "_latest", c) for c in ("attempt", "failed_at", *rest)])
    )
    disposition = (
        F.when(F.col("error_class").isNull(), "done")
        .when(~is_retryable(F.col("error_class"), retryable), "not_retryable")
        .when(F.col("attempt") >= max_attempts, "exhausted")
        .otherwise("retry")
    )
    wait_millis = (delay_seconds * 1000 * F.pow(F.lit(multiplier), F.col("attempt") - 1)).cast("bigint")
    due = F.timestamp_millis(F.unix_millis("failed_at") + wait_millis)
    return (
        latest.withColumn("disposition", disposition)
        .withColumn("next_attempt_at", F.when(F.col("disposition") == "retry", due))
    )


def due_attempts(state: DataFrame, as_of: Column) -> DataFrame:
    return state.where((F.col("disposition") == "retry") & (F.col("next_attempt_at") <= as_of))


def dead_letters(state: DataFrame) -> DataFrame:
    """Rows for the dead-letter table: attempts used up, or an error that no retry will cure."""
    return (
        state.where(F.col("disposition").isin("exhausted", "not_retryable"))
        .withColumnRenamed("attempt", "attempts")
        .drop("next_attempt_at")
    )


COUNTED = ["window_start", "original_topic", "error_class"]


def dead_letter_counts(dead: DataFrame, size: str = "1 hour", ts: str = "failed_at") -> DataFrame:
    """Dead letters per time window, original topic and error: counts that add up over parts of the table."""
    return (
        dead.groupBy(F.window(ts, size).alias("_w"), "original_topic", "error_class")
        .agg(F.count(F.lit(1)).alias("dead_letters"), F.max("attempts").alias("max_attempts"))
        .withColumn("window_start", F.col("_w.start")).select(*COUNTED, "dead_letters", "max_attempts")
    )


def summed_counts(counts: DataFrame, burst: int = 10) -> DataFrame:
    """Partial counts added up; `burst` marks a systemic failure."""
    return (
        counts.groupBy(*COUNTED)
        .agg(F.sum("dead_letters").alias("dead_letters"), F.max("max_attempts").alias("max_attempts"))
        .withColumn("burst", F.col("dead_letters") >= burst)
    )


def dead_letter_monitor(
    dead: DataFrame,
    size: str = "1 hour",
    burst: int = 10,
    ts: str = "failed_at",
) -> DataFrame:
    """Dead letters per original topic, error and time window, with the mark of a burst."""
    return dead_letter_counts(dead, size, ts).withColumn("burst", F.col("dead_letters") >= burst)
