"""Keys minted from input keys, so that a replayed batch mints the same ones."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from spendwatch import settings


def derived_uuid(kind: str, key: Column) -> Column:
    """UUID-shaped id of a natural key; `kind` separates id spaces over the same key."""
    digest = F.md5(F.concat(F.lit(kind + ":"), key.cast("string")))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])


def dedup_key(payment_id: Column) -> Column:
    return F.concat(F.lit(settings.DEDUP_PREFIX), payment_id)
