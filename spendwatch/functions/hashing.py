"""Key hashing compatible with the broker's keyed partitioner (murmur2, 32 bit), as a Spark expression.

Everything runs in bigint masked to 32 bits after each product: a factor below 2^32 times the
31-bit multiplier stays below 2^63, so ANSI arithmetic never overflows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Public murmur2 constants and the seed used for record keys.
SEED = 0x9747B28C
MULTIPLIER = 0x5BD1E995
SHIFT = 24
MASK = 0xFFFFFFFF


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`; a plain nested expression would be
    copied at each use, and the copies multiply from step to step."""
    return F.transform(F.array(value), body)[0]


def _mul(value: Column) -> Column:
    return (value * F.lit(MULTIPLIER)).bitwiseAND(F.lit(MASK))


def _xor_shift(value: Column, bits: int) -> Column:
    return value.bitwiseXOR(F.shiftright(value, bits))


def _reversed_hex(key: Column) -> Column:
    """Hex digits of the UTF-8 bytes, last byte first, so that a little-endian word is a plain substring."""
    octets = F.encode(key, "UTF-8")
    return F.hex(F.encode(F.reverse(F.decode(octets, "ISO-8859-1")), "ISO-8859-1"))


def murmur2(key: Column) -> Column:
    """Signed 32-bit murmur2 of the UTF-8 bytes of a string key; null for a null key."""
    return _bind(_reversed_hex(key), _murmur2_of_digits)


def _murmur2_of_digits(digits: Column) -> Column:
    length = F.length(digits)  # two digits per byte, eight per word
    rest = length % 8

    def unsigned(start: Column, count: Column) -> Column:
        return F.conv(F.substr(digits, start, count), 16, 10).cast("bigint")

    def mix(state: Column, start: Column) -> Column:
        word = _bind(_mul(unsigned(start, F.lit(8))), lambda w: _mul(_xor_shift(w, SHIFT)))
        return _mul(state).bitwiseXOR(word)

    def finish(state: Column) -> Column:
        tailed = F.when(rest > 0, _mul(state.bitwiseXOR(unsigned(F.lit(1), rest)))).otherwise(state)
        mixed = _bind(tailed, lambda h: _mul(_xor_shift(h, 13)))
        hashed = _bind(mixed, lambda h: _xor_shift(h, 15))
        return _bind(hashed, lambda h: F.when(h >= 2**31, h - F.lit(2**32)).otherwise(h).cast("int"))

    seeded = F.lit(SEED).bitwiseXOR(F.shiftright(length, 1).cast("bigint"))
    # The first word of the key is the last full one of the reversed digits.
    starts = F.when(length >= 8, F.sequence(length - 7, rest + 1, F.lit(-8))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(starts, seeded, mix, finish)


def key_partition(key: Column, partitions: int, mode: str = "coded") -> Column:
    """Partition of a key. 'coded' takes |hash| mod n, 'kafka' clears the sign bit as the broker does."""
    if mode == "coded":
        # |-2^31| does not fit 32 bits in the original arithmetic; such keys go to partition 0.
        def positive(h: Column) -> Column:
            return F.when(h == -(2**31), F.lit(0)).otherwise(F.abs(h))
    elif mode == "kafka":
        def positive(h: Column) -> Column:
            return h.bitwiseAND(F.lit(0x7FFFFFFF))
    else:
        raise ValueError(f"unknown mode {mode!r}: use 'coded' or 'kafka'")
    return _bind(murmur2(key), lambda h: (positive(h) % partitions).cast("int"))
