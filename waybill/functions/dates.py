"""Dates written in the four formats found in operational extracts."""

from __future__ import annotations

from string import ascii_letters

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WIDE_SPACE, WIDE_SPACE_CLASS, wide_trim

# The format tags, and the month names that are understood
# (in full or by their first three letters).
DATE_FORMATS = ("ISO", "US", "Long", "D-Mon-Y")
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

_SPACE = f"[{WIDE_SPACE_CLASS}]"
_ANY_MONTH = "(?i:" + "|".join(f"{m[:3]}(?:{m[3:]})?" for m in MONTHS) + ")"
_SHORT_MONTH = "(?i:" + "|".join(m[:3] for m in MONTHS) + ")"
_DAY_TO_31 = r"(?:[0-2]?\d|3[01])"
_PATTERNS = {
    "ISO": r"^\d{4}-\d{2}-\d{2}\z",
    "US": rf"^(?:0?\d|1[0-2])/{_DAY_TO_31}/\d{{4}}\z",
    "Long": rf"^{_ANY_MONTH}{_SPACE}+\d{{1,2}}{_SPACE}+\d{{4}}\z",
    "D-Mon-Y": rf"^{_DAY_TO_31}-{_SHORT_MONTH}-\d{{4}}\z",
}


def _by_format(v: Column, result: dict[str, Column]) -> Column:
    """The result for the format in which a trimmed text is written, else null.

    Two cheap looks at the text - has it a slash, does it start with a letter -
    leave one or two patterns to test per row.
    """

    def if_written(fmt: str) -> Column:
        return F.when(v.rlike(_PATTERNS[fmt]), result[fmt])

    return (
        F.when(v.contains("/"), if_written("US"))
        .when(v >= "A", if_written("Long"))
        .when(v.rlike(_PATTERNS["ISO"]), result["ISO"])
        .otherwise(if_written("D-Mon-Y"))
    )


def date_format_of(c: Column, trimmed: bool = False) -> Column:
    """The format tag of a date text, or null.

    This looks at the writing only: ``2026-02-31`` is tagged ISO although no
    such day exists (``parse_date`` gives null for it). ``trimmed`` says that
    the text has no white space around it.
    """
    v = c if trimmed else wide_trim(c)
    return _by_format(v, {fmt: F.lit(fmt) for fmt in DATE_FORMATS})


def _day(year: Column, month_name: Column | None, month: Column | None, day: Column) -> Column:
    """The DATE of parts that a pattern has let through; null if there is no such day."""
    if month is None:
        at = F.position(F.lower(month_name), F.lit("".join(m[:3].lower() for m in MONTHS)))
        month = F.floor((at + 2) / 3).cast("string")
    return F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date")


def parse_date(c: Column, trimmed: bool = False) -> Column:
    """A date text in any known format as DATE; null if unreadable or impossible."""
    v = c if trimmed else wide_trim(c)
    year = F.substring(v, -4, 4)
    # Between the first three letters of the month and the year: letters, white space, the day.
    middle = F.substr(v, F.lit(4), F.length(v) - 7)
    return _by_format(
        v,
        {
            "ISO": v.try_cast("date"),
            "US": _day(
                year,
                None,
                F.substring_index(v, "/", 1),
                F.substring_index(F.substring_index(v, "/", 2), "/", -1),
            ),
            "Long": _day(
                year, F.left(v, F.lit(3)), None, F.translate(middle, ascii_letters + WIDE_SPACE, "")
            ),
            "D-Mon-Y": _day(year, F.substring(v, -8, 3), None, F.substring_index(v, "-", 1)),
        },
    )
