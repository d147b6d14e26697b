"""Running sum / max over rows in offset order, without putting a whole key into one task.

A plain window function sorts each key in a single task, which a key holding a third of the rows
(or a partition of a topic, of which there are only a few) would drown. Offsets give a cheap, value-based
cut: rows whose offset falls into the same block of `block_offsets` form one unit. Rows are ordered
inside their block only; one small row per (key, block) carries the value of all earlier blocks.
The result is the same as the plain window's, and a block never holds more than `block_offsets` rows
per topic partition. Where rows are not ordered by offset, `even_blocks` cuts them at some of the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spendwatch import settings

_COMBINE = {
    "sum": (F.sum, lambda carry, local: F.coalesce(carry + local, carry, local)),
    "max": (F.max, lambda carry, local: F.greatest(carry, local)),
}

_PER_BLOCK = 16


def offset_block(position: str | Column, block_offsets: int) -> Column:
    position = F.col(position) if isinstance(position, str) else position
    return F.call_function("div", position, F.lit(block_offsets))


def even_blocks(df: DataFrame, keys: list[str], order: tuple[str, ...], block_rows: int, into: str) -> DataFrame:
    """Add column `into`: the number of the row's block in its key, blocks of about `block_rows` rows in this order.

    The cuts are places of rows themselves: `_PER_BLOCK` for each block are drawn by a hash of their place, and each key's
    every `_PER_BLOCK`th of these cuts it. So a key has as many cuts as its size asks for, ties in the first columns are cut
    by the next ones, and wherever the rows crowd, a block holds more than four times `block_rows` places with a chance of
    e^-25 only. Rows of one place stay together. All cuts are one place in `block_rows` of the table, with the order's
    columns alone: that is the bound of the broadcast.
    """
    place = F.struct(*order)
    drawn = F.array_sort(F.collect_set(place))
    cuts = (
        df.where(F.pmod(F.xxhash64(*order), F.lit(max(1, block_rows // _PER_BLOCK))) == 0)
        .groupBy(*keys).agg(F.filter(drawn, lambda _, i: i % _PER_BLOCK == _PER_BLOCK - 1).alias("_cuts"))
        .where(F.size("_cuts") > 0)
    )

    def halve(state: Column, _: Column) -> Column:
        middle = F.call_function("div", state["low"] + state["high"], F.lit(2)).cast("int")
        after = F.get("_cuts", middle) <= place
        searching = state["low"] < state["high"]
        return F.struct(
            F.when(searching & after, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(searching & ~after, middle).otherwise(state["high"]).alias("high"))

    # How many cuts are not after the row, by binary search.
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size("_cuts") + 1)).cast("int") + 1)
    found = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size("_cuts").alias("high")), halve)["low"]
    return (
        df.join(F.broadcast(cuts), keys, "left")
        .withColumn(into, F.when(F.col("_cuts").isNull(), 0).otherwise(found))
        .select(*df.columns, into)
    )


def running(
    df: DataFrame,
    keys: list[str],
    value: str,
    into: str,
    how: str = "sum",
    position: str = "offset",
    ties: tuple[str, ...] = ("partition",),
    exclusive: bool = False,
    block_offsets: int = settings.BLOCK_OFFSETS,
    block: Column | None = None,
) -> DataFrame:
    """Add column `into`: `how` over the rows of `keys` up to this one, by `position` then `ties`.

    Rows are cut into blocks of offsets, or by `block`, which must not fall as `position` grows.

    `exclusive` leaves the row itself out, giving null at the first row of a key. Rows with a null
    key are left out, as keyed aggregation of a stream does.
    """
    aggregate, combine = _COMBINE[how]
    keyed = df.dropna(subset=keys)
    blocked = keyed.withColumn(
        "_block", offset_block(position, block_offsets) if block is None else block)
    inside = (
        Window.partitionBy(*keys, "_block").orderBy(position, *ties)
        .rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    )
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        blocked.groupBy(*keys, "_block").agg(aggregate(value).alias("_block_value"))
        .withColumn("_carry", aggregate("_block_value").over(earlier))
        .where(F.col("_carry").isNotNull())
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_block").alias("_k_block"), "_carry")
    )
    # Plain equality on the window's own keys: the join reuses its shuffle and its sort.
    same = F.col("_block") == F.col("_k_block")
    for key in keys:
        same = same & (F.col(key) == F.col(f"_k_{key}"))
    rows = blocked.withColumn("_local", aggregate(value).over(inside))
    return (
        rows.join(carry, same, "left")
        .withColumn(into, combine(F.col("_carry"), F.col("_local")))
        .select(*df.columns, into)
    )
