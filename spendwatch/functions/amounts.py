"""Money columns: raw two's-complement bytes, rounding to cents."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def decode_amount(raw: Column, scale: int = 2, precision: int = 18) -> Column:
    """Unscaled two's-complement bytes -> decimal; null if empty, longer than 8 bytes or out of range."""
    digits = F.hex(raw)
    sign = F.when(F.substring(digits, 1, 1) >= "8", "F").otherwise("0")
    unscaled = F.conv(F.lpad(digits, 16, sign), 16, -10).cast("decimal(20,0)")
    amount = (unscaled * F.lit(Decimal(1).scaleb(-scale))).try_cast(f"decimal({precision},{scale})")
    return F.when(F.octet_length(raw).between(1, 8), amount)


def encode_amount(amount: Column, scale: int = 2) -> Column:
    """Decimal -> shortest two's-complement bytes of the unscaled value."""
    unscaled = (amount * F.lit(Decimal(10) ** scale)).cast("bigint")
    digits = F.lpad(F.hex(unscaled), 16, "0")
    # A leading 00 (FF) byte is redundant when the next byte already shows the same sign.
    positive = F.regexp_replace(digits, "^(00)+(?=[0-7])", "")
    negative = F.regexp_replace(digits, "^(FF)+(?=[89A-F])", "")
    return F.unhex(F.when(unscaled < 0, negative).otherwise(positive))


def to_cents(amount: Column) -> Column:
    """Round half up to cents, keeping the integer digits of a windowed sum."""
    return F.round(amount, 2).cast("decimal(28,2)")
