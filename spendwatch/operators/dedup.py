"""Idempotent delivery: first delivery wins, optionally with a time-limited memory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spendwatch import settings
from spendwatch.functions.identifiers import dedup_key
from spendwatch.functions.maps import comparable, restored
from spendwatch.functions.times import interval


def idempotent_first(df: DataFrame, key: str = "payment_id",
                     order: tuple[str, ...] = ("record_ts", "partition", "offset")) -> DataFrame:
    """The earliest delivery of each key plus its number of deliveries.

    `min` of a struct is combined map side, so copies of one key collapse before the shuffle; ranking
    them with row_number would move every copy to one task.
    """
    rest = [c for c in df.columns if c not in order and c != key]
    return (
        df.groupBy(key)
        .agg(F.min(F.struct(*order, *comparable(df, rest))).alias("_first"),
             F.count(F.lit(1)).alias("deliveries"))
        .select(*[F.col(key) if c == key else restored(df, "_first", c) for c in df.columns], "deliveries")
    )


def ledger_rows(winners: DataFrame, topic: str = settings.TOPIC_INITIATED,
                ts: str = "record_ts") -> DataFrame:
    """Rows of the processed-message ledger for accepted deliveries."""
    return winners.select(
        dedup_key(F.col("payment_id")).alias("message_key"),
        F.lit(topic).alias("topic"),
        F.col(ts).alias("processed_at"),
    )


# A ttl is cut into so many time slots, and each of these into as many again. A slot bounds what a step of the chain has to
# look at, and deals a hot key's rows out over that many join keys for each ttl; results do not depend on it.
SLOTS = 1024
# Cells of a ttl by which deliveries meet the claim that holds them: a claim is a row for each, a hot key is dealt by them.
CELLS = 4
# Claims of one key that a task folds as they are.
KEY_CLAIMS = 100_000


def idempotent_ttl(
    df: DataFrame,
    key: str,
    ts: str = "record_ts",
    position: str = "offset",
    failed: str | None = None,
    ttl: str = settings.DEDUP_TTL,
    slots: int = SLOTS,
    key_claims: int = KEY_CLAIMS,
) -> DataFrame:
    """Add `outcome`: 'processed', 'duplicate' or 'failed' for each delivery.

    A key is held from an accepted delivery for `ttl`; duplicates do not extend it, and a delivery whose processing fails
    (`failed` is true) releases it at once. One lazy plan for all keys, expressions only:

    1. of a key with more than `key_claims` claims, the first and last claim of each time slot, combined map side; a fold over
       its slots in order keeps the few for each ttl that may hold an accepted claim; the same once more over the
       claims of these slots, in slots finer by another factor of `slots`;
    2. a fold over the claims (that are left) of each key gives the exact chain: the first claim, then each first claim
       at least one ttl later;
    3. every delivery meets the accepted claim that holds it by key and cell of time, so a hot key is dealt out.
    """
    period = F.unix_micros(F.to_timestamp(F.lit("1970-01-01")) + interval(ttl))
    named = df.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null")))
    rows = named.withColumns({"_t": F.unix_micros(ts), "_pos": F.col(position).cast("bigint"), "_ttl": period})
    ok = ~F.coalesce(F.col(failed), F.lit(False)) if failed else F.lit(True)
    claims = rows.where(ok & F.col("_t").isNotNull()).select("_key", "_t", "_pos")

    # Keys with few claims are folded whole; the others, of which there are few, are narrowed before.
    heavy = claims.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > key_claims).select("_key")
    few = _narrowed(claims.join(heavy, "_key", "left_semi"), period, slots)
    accepted = _chain(claims.join(heavy, "_key", "left_anti"), period).unionByName(_chain(few, period))

    # An accepted claim covers [t, t + ttl): at most one holds a delivery. Both meet on coarse cells of a ttl / CELLS.
    cell = F.greatest(F.call_function("div", period, F.lit(CELLS)), F.lit(1))
    held = accepted.withColumn("_cell", F.explode(F.sequence(
        floor_div(F.col("_from"), cell), floor_div(F.col("_from") + period - 1, cell))))
    matched = rows.withColumn("_own_cell", floor_div(F.col("_t"), cell)).join(
        held,
        (F.col("_key") == F.col("_from_key")) & (F.col("_own_cell") == F.col("_cell"))
        & (F.col("_t") < F.col("_from") + F.col("_ttl"))
        & (F.struct("_t", "_pos") >= F.struct("_from", "_from_pos")),
        "left",
    )
    is_claim = (F.col("_t") == F.col("_from")) & (F.col("_pos") == F.col("_from_pos"))
    outcome = (
        F.when(is_claim, "processed").when(F.col("_from").isNotNull(), "duplicate").otherwise("failed"))
    return matched.withColumn("outcome", outcome).select(*df.columns, "outcome")


def floor_div(value: Column, by: Column) -> Column:
    """Rounds down on both sides of 1970."""
    return F.call_function("div", value - F.pmod(value, by), by)


def _narrowed(claims: DataFrame, ttl: Column, slots: int) -> DataFrame:
    """The claims that may be accepted. A slot's first claim by (time, position) is enough for each time."""
    claims = claims.groupBy("_key", "_t").agg(F.min("_pos").alias("_pos"))
    for level in (1, 2):
        width = F.greatest(F.call_function("div", ttl, F.lit(slots**level)), F.lit(1))
        claims = claims.withColumn("_slot", floor_div(F.col("_t"), width))
        spans = claims.groupBy("_key", "_slot").agg(F.min("_t").alias("low"), F.max("_t").alias("high"))
        claims = claims.join(_possible_slots(spans, ttl), ["_key", "_slot"], "left_semi").drop("_slot")
    return claims


def _possible_slots(spans: DataFrame, ttl: Column) -> DataFrame:
    """(key, slot) of slots that may hold an accepted claim, from each slot's first (`low`) and last (`high`) claim.

    Folded in order of slots: `low` to `high` is where the last accepted claim may lie, `next` the first time at which the
    one after it may. A slot with a claim at or after low + ttl may hold the next one, a slot with a claim at or after
    high + ttl does so at the latest.
    """
    # One text for the fold: the same in column objects takes seconds to build.
    entry = "struct<low: bigint, high: bigint, next: bigint, kept: array<bigint>>"
    after = "coalesce(seen.next, greatest(slot.low, seen.low + ttl))"
    # A slot as long as the ttl can hold its own next claim: then the last accepted one may be its last.
    fold = f"""aggregate(slots, cast(named_struct('low', null, 'high', null, 'next', null, 'kept', array()) AS {entry}),
        (seen, slot) -> CASE
            WHEN seen.low IS NULL THEN named_struct('low', slot.low,
                'high', if(slot.high >= slot.low + ttl, slot.high, slot.low),
                'next', cast(null AS bigint), 'kept', array(slot._slot))
            WHEN slot.high < seen.low + ttl THEN seen
            WHEN slot.high >= seen.high + ttl THEN named_struct('low', {after},
                'high', if(slot.low >= seen.high + ttl, slot.low, slot.high),
                'next', cast(null AS bigint), 'kept', concat(seen.kept, array(slot._slot)))
            ELSE named_struct('low', seen.low, 'high', seen.high, 'next', {after},
                'kept', concat(seen.kept, array(slot._slot))) END,
        seen -> seen.kept)"""
    lists = spans.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("_slot", "low", "high"))).alias("slots"))
    return lists.withColumn("ttl", ttl).select("_key", F.explode(F.expr(fold)).alias("_slot"))


def _chain(claims: DataFrame, ttl: Column) -> DataFrame:
    """The accepted claims of each key: the first, then each first one at least a ttl after the last accepted one."""
    fold = """aggregate(claims, cast(array() AS array<struct<_t: bigint, _pos: bigint>>), (taken, claim) ->
        if(size(taken) = 0 OR claim._t >= element_at(taken, -1)._t + ttl, concat(taken, array(claim)), taken))"""
    lists = claims.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("_t", "_pos"))).alias("claims"))
    taken = lists.withColumn("ttl", ttl).select(F.col("_key").alias("_from_key"), F.explode(F.expr(fold)).alias("_c"))
    return taken.select("_from_key", F.col("_c._t").alias("_from"), F.col("_c._pos").alias("_from_pos"))
