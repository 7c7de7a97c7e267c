"""Expressions over series keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_series_id(series_id: Column) -> dict[str, Column]:
    """``CAT_DEPT_NUM_ST_K[_suffix]`` -> item = first three parts, store = next two."""
    parts = F.split(series_id, "_")
    return {
        "item_id": F.concat_ws("_", F.slice(parts, 1, 3)),
        "store_id": F.concat_ws("_", F.slice(parts, 4, 2)),
    }


def category_of(item_id: Column) -> Column:
    return F.split_part(item_id, F.lit("_"), F.lit(1))


def category_by_pattern(item_id: Column, pattern: str = "^[A-Z]+") -> Column:
    return F.regexp_substr(item_id, F.lit(pattern))


def hash_key(keys: list[Column], salt: str) -> Column:
    """Reproducible pseudo-random order of keys: md5 of the joined key and a salt."""
    return F.md5(F.concat_ws("_", *keys, F.lit(salt)).cast("binary"))


#: Fixed values of the public Farm fingerprint: three primes, named as in its publication.
K0 = 0xC3A5C85C97CB3127
K1 = 0xB492B66FBE98F273
K2 = 0x9AE16A3B2F90404F
LOW = 0xFFFFFFFF


def signed(x: int) -> int:
    """The 64 bits of ``x`` as a signed integer."""
    return x - (1 << 64) if x >> 63 else x


def _with(value: Column | dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it; a dict becomes a struct."""
    if isinstance(value, dict):
        value = F.struct(*[v.alias(k) for k, v in value.items()])
    return F.transform(F.array(value), body)[0]


def wrapping_add(a: Column, b: Column) -> Column:
    """a + b modulo 2^64; the plain sum of two longs fails under ANSI rules where it overflows."""

    def halves(v: Column) -> Column:
        low = v["a"].bitwiseAND(F.lit(LOW)) + v["b"].bitwiseAND(F.lit(LOW))
        high = F.shiftrightunsigned(v["a"], 32) + F.shiftrightunsigned(v["b"], 32) + F.shiftrightunsigned(low, 32)
        return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(F.lit(LOW)))

    return _with({"a": a, "b": b}, halves)


def wrapping_multiply(a: Column, b: Column) -> Column:
    """a * b modulo 2^64, from products of 16 and 32 bits, none of which leaves 48."""

    def limbs(v: Column) -> Column:
        a, low, high = v["a"], v["b"].bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(v["b"], 32)
        limb = [F.shiftrightunsigned(a, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
        return _with(
            {
                "low": limb[0] * low,
                "middle": limb[1] * low,
                "high": limb[2] * low + limb[0] * high,
                "top": (limb[3] * low + limb[1] * high).bitwiseAND(F.lit(0xFFFF)),
            },
            carried,
        )

    def carried(p: Column) -> Column:
        low = p["low"] + F.shiftleft(p["middle"].bitwiseAND(F.lit(LOW)), 16)
        top = F.shiftleft(p["top"] + F.shiftrightunsigned(p["middle"], 32), 16)
        high = p["high"] + top + F.shiftrightunsigned(low, 32)
        return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(F.lit(LOW)))

    return _with({"a": a, "b": b}, limbs)


def _rotated(x: Column, bits: int) -> Column:
    return _with(x, lambda v: F.shiftrightunsigned(v, bits).bitwiseOR(F.shiftleft(v, 64 - bits)))


def _folded(x: Column) -> Column:
    return _with(x, lambda v: v.bitwiseXOR(F.shiftrightunsigned(v, 47)))


def _sum(first: Column, *others: Column) -> Column:
    for other in others:
        first = wrapping_add(first, other)
    return first


def _mixed_pair(u: Column, v: Column, by: Column) -> Column:
    def second(w: Column) -> Column:
        a = _folded(wrapping_multiply(w["u"].bitwiseXOR(w["v"]), w["by"]))
        b = _folded(wrapping_multiply(w["v"].bitwiseXOR(a), w["by"]))
        return wrapping_multiply(b, w["by"])

    return _with({"u": u, "v": v, "by": by}, second)


def farm_fingerprint(text: Column) -> Column:
    """The public 64-bit Farm fingerprint of a text's UTF-8 bytes, signed, in column expressions.

    NULL gives NULL, the empty text the constant of its own; texts of more than 64 bytes are an error, as the
    fingerprint takes another course for them.
    """
    k0, k1, k2 = (F.lit(signed(k)) for k in (K0, K1, K2))
    text = text.cast("string")

    def of(v: Column) -> Column:
        n, by = v["n"], v["by"]

        def number(start: Column, size: int) -> Column:
            """``size`` bytes from byte ``start`` on, lowest first: digits read backwards, then swapped in pairs."""
            digits = F.substr(v["digits"], 2 * (n - start - size) + 1, F.lit(2 * size))
            low = F.lit(0x0F0F0F0F0F0F0F0F)
            return _with(
                F.conv(digits, 16, -10).cast("long"),
                lambda x: F.shiftleft(x.bitwiseAND(low), 4).bitwiseOR(F.shiftright(x, 4).bitwiseAND(low)),
            )

        def from_start(at: int, size: int = 8) -> Column:
            return number(F.lit(at), size)

        def from_end(at: int, size: int = 8) -> Column:
            return number(n - at, size)

        def few() -> Column:
            y = from_start(0, 1) + F.shiftleft(number(F.shiftright(n, 1), 1), 8)
            z = n + F.shiftleft(from_end(1, 1), 2)
            both = wrapping_multiply(y, k2).bitwiseXOR(wrapping_multiply(z, k0))
            return wrapping_multiply(_folded(both), k2)

        def upto_7() -> Column:
            return _mixed_pair(n + F.shiftleft(from_start(0, 4), 3), from_end(4, 4), by)

        def upto_16() -> Column:
            def ends(w: Column) -> Column:
                c = wrapping_add(wrapping_multiply(_rotated(w["b"], 37), by), w["a"])
                d = wrapping_multiply(wrapping_add(_rotated(w["a"], 25), w["b"]), by)
                return _mixed_pair(c, d, by)

            return _with({"a": wrapping_add(from_start(0), k2), "b": from_end(8)}, ends)

        def outer(first: Column, then: Callable[[Column, Column, Column], Column]) -> Column:
            """Two sums of the first 16 and the last 16 bytes, ``first`` multiplying the first eight."""
            parts = {
                "a": wrapping_multiply(from_start(0), first),
                "b": from_start(8),
                "c": wrapping_multiply(from_end(8), by),
                "d": wrapping_multiply(from_end(16), k2),
            }

            def sums(w: Column) -> Column:
                y = _sum(_rotated(wrapping_add(w["a"], w["b"]), 43), _rotated(w["c"], 30), w["d"])
                z = _sum(w["a"], _rotated(wrapping_add(w["b"], k2), 18), w["c"])
                return _with({"a": w["a"], "y": y, "z": z}, lambda s: then(s["a"], s["y"], s["z"]))

            return _with(parts, sums)

        def inner(a: Column, y: Column, z: Column) -> Column:
            parts = {
                "e": wrapping_multiply(from_start(16), by),
                "f": from_start(24),
                "g": wrapping_multiply(wrapping_add(y, from_end(32)), by),
                "h": wrapping_multiply(wrapping_add(_mixed_pair(y, z, by), from_end(24)), by),
            }

            def sums(w: Column) -> Column:
                u = _sum(_rotated(wrapping_add(w["e"], w["f"]), 43), _rotated(w["g"], 30), w["h"])
                return _mixed_pair(u, _sum(w["e"], _rotated(wrapping_add(w["f"], a), 18), w["g"]), by)

            return _with(parts, sums)

        return (
            F.when(n == 0, k2)
            .when(n < 4, few())
            .when(n < 8, upto_7())
            .when(n <= 16, upto_16())
            .when(n <= 32, outer(k1, lambda a, y, z: _mixed_pair(y, z, by)))
            .when(n <= 64, outer(k2, inner))
            .otherwise(F.raise_error(F.lit("farm_fingerprint: more than 64 bytes")).cast("long"))
        )

    size = F.octet_length(text).cast("long")
    found = _with(
        {"n": size, "by": wrapping_add(k2, 2 * size), "digits": F.reverse(F.hex(text))}, of
    )
    return F.when(text.isNotNull(), found)


def farm_key(keys: list[Column], salt: str) -> Column:
    """The order of keys by the Farm fingerprint of the joined key and a salt: 16 hexadecimal digits that sort as the
    signed fingerprints do. Takes the place of ``hash_key`` where samples must be those that the fingerprint draws."""
    lifted = farm_fingerprint(F.concat_ws("_", *keys, F.lit(salt))).bitwiseXOR(F.lit(signed(1 << 63)))
    return F.lpad(F.hex(lifted), 16, "0")
