"""Numbers: reading them from text, rounding them, adding them up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WIDE_SPACE

_PLAIN = r"^-?\d+(\.\d+)?\z"


def parse_number(c: Column) -> Column:
    """Text to double, ignoring ``$``, ``,`` and white space; anything else is null.

    Any number of digits is read; a number too large for a double is null.
    """
    bare = F.translate(c, "$," + WIDE_SPACE, "")
    value = F.when(c.rlike(_PLAIN), c.cast("double")).when(
        bare.rlike(_PLAIN), bare.cast("double")
    )
    return F.nullif(F.nullif(value, F.lit(float("inf"))), F.lit(float("-inf")))


def half_up(c: Column, places: int) -> Column:
    """Round half up with plain double arithmetic.

    ``round`` is not used: it works on the decimal text of the double and so
    differs from other engines on values such as 0.285. From 9e15 upwards the
    product holds no fraction, so there is nothing to round.
    """
    k = float(10**places)
    moved = c * k
    whole = F.when(F.abs(moved) < 9e15, F.floor(moved + 0.5).cast("double")).otherwise(moved)
    return whole / k


def exact_sum(c: Column) -> Column:
    """Sum doubles as decimals, so the result does not depend on task order.

    Whole parts and fractions are added apart, as decimal(38,0) and
    decimal(37,20), and put together once at the end. Limits of the decimals:
    fractions are kept to 20 places, and a whole sum of 38 digits or more is an
    error and not a wrong number.
    """
    part = c % 1.0  # exact in doubles, like the difference
    zero = F.lit(0)
    whole = F.coalesce(F.sum((c - part).cast("decimal(38,0)")), zero).cast("decimal(38,0)")
    rest = F.coalesce(F.sum(part.cast("decimal(21,20)")), zero).cast("decimal(37,20)")
    carry = F.floor(rest).cast("decimal(17,0)")  # so that the difference keeps its places
    whole = (whole + carry).cast("decimal(38,0)")
    rest = (rest - carry).cast("decimal(21,20)")  # from 0 to below 1
    # A negative number with a fraction is written from the other side: -3 + 0.25 = -(2 + 0.75).
    below = (whole < 0) & (rest > 0)
    whole = F.when(below, -whole - 1).otherwise(whole).cast("decimal(38,0)")
    rest = F.when(below, 1 - rest).otherwise(rest).cast("decimal(21,20)")
    text = F.concat(
        F.when(below, "-").otherwise(""),
        whole.cast("string"),
        F.substr(F.format_number(rest, 20), F.lit(2)),
    )
    return text.cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division giving 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def number_text(c: Column) -> Column:
    """A double as people write it: no exponent, no trailing zeros, no ``.0``."""
    whole = F.abs(c) < 9e15
    plain = F.regexp_replace(c.cast("decimal(38,12)").cast("string"), r"\.?0+$", "")
    return (
        F.when(whole & (c == F.floor(c)), F.floor(c).cast("string"))
        .when(whole, plain)
        .otherwise(c.cast("string"))
    )


def money_text(c: Column) -> Column:
    """``$1,234.50``; no decimals when the amount is whole."""
    return F.concat(
        F.lit("$"),
        F.when(c == F.floor(c), F.format_number(c, 0)).otherwise(
            F.format_number(half_up(c, 2), 2)
        ),
    )


def per_mile_text(c: Column) -> Column:
    return F.format_string("$%.2f", c)
