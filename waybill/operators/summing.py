"""Exact sums of doubles of any size, the same in every partitioning.

A double is cut into pieces of 16 bits, its limbs: those below its leading
range. Rows are added up by (group, leading range), so that limbs of the same
weight meet, in plain 64-bit counters with partial aggregation. Of a group only
the ranges that occur are left, at most some 130, and one expression puts them
together: it carries from limb to limb and rounds once, to the nearest double.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.extracts import named

LIMB = 16  # bits; 2**46 rows fit into a limb's counter
_PIECES = 5  # the leading limb, and four for the 53 bits behind its first
_LOWEST = -67  # leading range of the smallest doubles
_HEADROOM = 4  # limbs above the leading one, for what is carried


def _range_of(c: Column) -> Column:
    """The limb in which a double begins; 0 for zero and null."""
    limb = F.floor(F.log2(F.abs(c)) / LIMB)
    return F.coalesce(F.when(c != 0, F.greatest(limb, F.lit(_LOWEST))), F.lit(0)).cast("int")


def _pieces(c: Column, limb: Column) -> list[Column]:
    """The limbs of a double from ``limb`` down; multiplying by powers of two loses nothing."""
    rest = c / F.pow(F.lit(2.0), limb * LIMB)
    found = []
    for _ in range(_PIECES):
        whole = rest.cast("bigint")
        found.append(whole)
        rest = (rest - whole) * float(1 << LIMB)
    return found


def _with_nearest(df: DataFrame, parts: str, out: str) -> DataFrame:
    """``out``: the double nearest to the sum of ``parts``, (limb, counters from that limb down)."""
    zero = F.lit(0).cast("bigint")
    limbs = F.transform(parts, lambda p: p["limb"])
    low, high = F.array_min(limbs) - (_PIECES - 1), F.array_max(limbs) + _HEADROOM

    def total(at: Column) -> Column:
        return F.aggregate(
            parts,
            zero,
            lambda all_, p: all_ + F.coalesce(F.get(p["counters"], p["limb"] - at), zero),
        )

    def step(state: Column, value: Column) -> Column:
        moved = state["carry"] + value
        digit = moved.bitwiseAND(F.lit((1 << LIMB) - 1).cast("bigint"))
        return F.struct(
            F.shiftright(moved, LIMB).alias("carry"),
            F.array_append(state["digits"], digit).alias("digits"),
        )

    def carried(values: Column) -> Column:
        none = F.struct(zero.alias("carry"), F.array().cast("array<bigint>").alias("digits"))
        return F.aggregate(values, none, step)

    # The first of the digits that is not 0, five of them, and whether any comes after.
    lead = F.aggregate(
        F.sequence(F.lit(0), F.size("__digits") - 1),
        F.lit(-1),
        lambda at, i: F.when((at < 0) & (F.get("__digits", i) != 0), i).otherwise(at),
    )
    shown = F.aggregate(
        F.sequence(F.lit(0), F.lit(4)),
        F.lit(0).cast("decimal(38,0)"),
        lambda value, j: (
            value * (1 << LIMB) + F.coalesce(F.get("__digits", F.col("__lead") + j), zero)
        ).cast("decimal(38,0)"),
    )
    more = F.exists(F.slice("__digits", F.col("__lead") + 6, F.size("__digits")), lambda d: d != 0)
    whole = (shown * 2 + F.when(more, 1).otherwise(0)).cast("decimal(38,0)").cast("double")
    bits = (F.col("__high") - F.col("__lead") - 4) * LIMB - 1
    half = F.floor(bits / 2)
    size = whole * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), bits - half)
    return (
        df.withColumn("__high", high)
        .withColumn("__totals", F.transform(F.sequence(low, high), total))
        # A carry below zero at the top means a negative sum, whose digits come from the
        # negated limbs.
        .withColumn("__sign", F.when(carried(F.col("__totals"))["carry"] < 0, -1).otherwise(1))
        .withColumn("__digits", carried(F.transform("__totals", lambda v: v * F.col("__sign"))))
        .withColumn("__digits", F.reverse(F.col("__digits")["digits"]))
        .withColumn("__lead", lead)
        .withColumn(out, F.when(F.col("__lead") < 0, 0.0).otherwise(size * F.col("__sign")))
        .drop("__high", "__totals", "__sign", "__digits", "__lead")
    )


def exact_sums(
    df: DataFrame,
    by: Sequence[str],
    sums: dict[str, Column],
    counts: dict[str, Column] | None = None,
    firsts: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per group of ``by``, or one in all: ``by``, then a column for each entry.

    ``sums``: doubles, added up exactly and rounded once; null counts as nothing, a
    sum of nothing is 0, and NaN or infinite values give what they give as doubles.
    ``counts``: whole numbers to add up. ``firsts``: of these the smallest is kept.
    """
    counts, firsts = counts or {}, firsts or {}
    keys = [f"key{i}" for i in range(len(by))]
    columns = [named(c).alias(k) for c, k in zip(by, keys)]
    numbers = list(range(len(sums)))
    for i, c in enumerate(sums.values()):
        finite = F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
        columns += [
            finite.alias(f"value{i}"),
            F.when(finite.isNull(), c).alias(f"odd{i}"),
            _range_of(finite).alias(f"limb{i}"),
        ]
    columns += [c.alias(f"count{i}") for i, c in enumerate(counts.values())]
    columns += [c.alias(f"first{i}") for i, c in enumerate(firsts.values())]
    rows = df.select(*columns)
    limbs = [f"limb{i}" for i in numbers]
    partial = rows.groupBy(*keys, *limbs).agg(
        *[
            F.sum(piece).alias(f"piece{i}_{j}")
            for i in numbers
            for j, piece in enumerate(_pieces(F.col(f"value{i}"), F.col(f"limb{i}")))
        ],
        *[F.sum(f"odd{i}").alias(f"odd{i}") for i in numbers],
        *[F.sum(f"count{i}").alias(f"count{i}") for i in range(len(counts))],
        *[F.min(f"first{i}").alias(f"first{i}") for i in range(len(firsts))],
    )

    def part(i: int) -> Column:
        counters = [F.coalesce(f"piece{i}_{j}", F.lit(0)).cast("bigint") for j in range(_PIECES)]
        return F.struct(F.col(f"limb{i}").alias("limb"), F.array(*counters).alias("counters"))

    whole = partial.groupBy(*keys).agg(
        *[F.collect_list(part(i)).alias(f"parts{i}") for i in numbers],
        *[F.sum(f"odd{i}").alias(f"odd{i}") for i in numbers],
        *[F.coalesce(F.sum(f"count{i}"), F.lit(0)).alias(f"count{i}") for i in range(len(counts))],
        *[F.min(f"first{i}").alias(f"first{i}") for i in range(len(firsts))],
    )
    for i in numbers:
        whole = _with_nearest(whole, f"parts{i}", f"sum{i}")
    return whole.select(
        *[F.col(k).alias(c) for c, k in zip(by, keys)],
        *[
            F.coalesce(f"odd{i}", f"sum{i}", F.lit(0.0)).alias(name)
            for i, name in enumerate(sums)
        ],
        *[F.col(f"count{i}").alias(name) for i, name in enumerate(counts)],
        *[F.col(f"first{i}").alias(name) for i, name in enumerate(firsts)],
    )
