"""Column clean-up jobs over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions import (
    EnumRules,
    canonical_value,
    date_format_of,
    parse_date,
    parse_number,
    title_case_place,
    upper_code,
    wide_trim,
)
from ..sources.extracts import named


def standardize_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_value`` (DATE) and ``<column>_format`` for each date column."""
    return df.withColumns(
        {
            name: expr
            for c in columns
            for name, expr in (
                (f"{c}_value", parse_date(named(c))),
                (f"{c}_format", date_format_of(named(c))),
            )
        }
    )


def standardize_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_value`` (DOUBLE) for each column of number texts."""
    return df.withColumns({f"{c}_value": parse_number(named(c)) for c in columns})


def canonicalize_enum(df: DataFrame, column: str, rules: EnumRules) -> DataFrame:
    """Add ``<column>_value``: the listed value that the text stands for."""
    return df.withColumn(f"{column}_value", canonical_value(named(column), rules))


def normalize_places(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace place names by their title-cased form."""
    return df.withColumns({c: title_case_place(wide_trim(named(c))) for c in columns})


def upper_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: upper_code(named(c)) for c in columns})


def trim_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: wide_trim(named(c)) for c in columns})
