"""Column expressions shared by the operators: exact money arithmetic, counts, bit sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(condition: Column) -> Column:
    """``COUNT(*) FILTER (WHERE condition)``: a NULL condition does not count."""
    return F.count(F.when(condition, F.lit(1)))


def as_cents(amount: Column) -> Column:
    """A two-decimal amount as a whole number of cents, which sums as a plain long."""
    return (amount * 100).cast("bigint")


def from_cents(cents: Column, precision: int) -> Column:
    """Whole cents back to ``decimal(precision, 2)``; raises when the value does not fit."""
    return scaled(cents, 2, precision)


def scaled(units: Column, scale: int, precision: int) -> Column:
    """A whole number of 10^-scale units as ``decimal(precision, scale)``, without rounding."""
    unit = F.lit("0." + "0" * (scale - 1) + "1").cast(f"decimal({scale},{scale})")
    return (units.cast("decimal(18,0)") * unit).cast(f"decimal({precision},{scale})")


def half_up_quotient(numerator: Column, denominator: Column, shift: int) -> Column:
    """``numerator / denominator`` in units of 10^-shift, rounded once, half away from zero.

    Decimal operands hold the doubled and shifted numerator where a long could overflow.
    A NULL or zero denominator gives NULL.
    """
    wide = F.abs(numerator).cast("decimal(20,0)") * F.lit(2 * 10**shift).cast(
        f"decimal({shift + 1},0)"
    )
    count = F.nullif(denominator, F.lit(0)).cast("decimal(19,0)")
    doubled = (count * F.lit(2).cast("decimal(1,0)")).cast("decimal(20,0)")
    rounded = F.call_function("div", wide + count, doubled)
    return F.when(numerator < 0, -rounded).otherwise(rounded)


def exact_average(cents: Column, count: Column, scale: int, precision: int) -> Column:
    """Average of amounts given as summed cents, rounded once to ``scale`` decimals."""
    return scaled(half_up_quotient(cents, count, scale - 2), scale, precision)


def exact_ratio(part: Column, whole: Column, scale: int, precision: int) -> Column:
    """Ratio of two counts, rounded once to ``scale`` decimals."""
    return scaled(half_up_quotient(part, whole, scale), scale, precision)


def percent(part: Column, whole: Column, decimals: int) -> Column:
    """``ROUND(100 * part / whole, decimals)`` in exact whole-number form."""
    return scaled(half_up_quotient(part * 100, whole, decimals), decimals, 7 + decimals)


# Values that one long of a bitmap tells apart.
BITMAP_BITS = 63


def bitmap_bucket(value: Column) -> Column:
    """Number of the long of a bitmap in which a whole number has its bit, NULL for NULL.

    Rows are grouped by it, so a bitmap is as many rows as it needs and the numbers have no range:
    :func:`bitmap` combines on the map side, and the distinct values are the bits of all buckets.
    """
    wide = value.cast("bigint")
    return F.call_function("div", wide - F.pmod(wide, F.lit(BITMAP_BITS)), F.lit(BITMAP_BITS).cast("bigint"))


def bitmap(value: Column) -> Column:
    """Aggregate: the values of a bucket as bits."""
    place = F.pmod(value.cast("bigint"), F.lit(BITMAP_BITS)).cast("int")
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))


def bitmap_values(bits: Column | str) -> Column:
    """Aggregate over the buckets of one bitmap: how many distinct values it holds."""
    return F.coalesce(F.sum(F.bit_count(bits)), F.lit(0)).cast("bigint")
