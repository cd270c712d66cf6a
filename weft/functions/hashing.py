"""Hashes that samples and folds are drawn by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_M = 1 << 64


def _whole(number: int, digits: int = 20) -> Column:
    return F.lit(str(number)).cast(f"decimal({digits},0)")


def _let(x: Column, f) -> Column:
    """f(x) with x evaluated once, however often f mentions it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _xor_shift(x: Column, bits: int) -> Column:
    """x ^ (x >>> bits) of an unsigned 64-bit number kept in a signed bigint."""
    return _let(x, lambda v: v.bitwiseXOR(F.shiftrightunsigned(v, bits)))


def _signed(x: Column) -> Column:
    """The bigint of the same 64 bits as a non-negative decimal."""
    rest = F.pmod(x, _whole(_M))
    return _let(rest, lambda v: F.when(v >= _whole(1 << 63), v - _whole(_M)).otherwise(v).cast("bigint"))


def _times(x: Column, factor: int) -> Column:
    """Product modulo 2^64 of a bigint and an unsigned constant. Decimals hold the partial products exactly, so ANSI overflow checks stay on."""
    f_low, f_high = _whole(factor & 0xFFFFFFFF, 10), _whole(factor >> 32, 10)

    def product(v: Column) -> Column:
        low, high = F.pmod(v, F.lit(1 << 32)).cast("decimal(20,0)"), F.shiftrightunsigned(v, 32).cast("decimal(20,0)")
        return low * f_low + F.pmod(low * f_high + high * f_low, _whole(1 << 32, 10)) * _whole(1 << 32, 10)

    return _signed(_let(x, product))


def splitmix64(number: Column) -> Column:
    """SplitMix64 of a bigint; the unsigned result in a signed bigint. The published constants."""
    x = _signed(number.cast("decimal(38,0)") + _whole(0x9E3779B97F4A7C15))
    x = _times(_xor_shift(x, 30), 0xBF58476D1CE4E5B9)
    x = _times(_xor_shift(x, 27), 0x94D049BB133111EB)
    return _xor_shift(x, 31)


def unsigned_mod(x: Column, m: int) -> Column:
    """Remainder of the unsigned 64-bit number that a bigint holds."""
    return _let(x, lambda v: F.when(v >= 0, F.pmod(v, F.lit(m))).otherwise(F.pmod(F.pmod(v, F.lit(m)) + F.lit(_M % m), F.lit(m))))


def validation_fold(number: Column, folds: int = 5) -> Column:
    """1 for about one entity in ``folds``, else 0."""
    return (unsigned_mod(splitmix64(number), folds) == 0).cast("int")


def crc_slot(text: Column, slots: int | Column) -> Column:
    return F.pmod(F.crc32(text.cast("binary")), slots if isinstance(slots, Column) else F.lit(slots))
