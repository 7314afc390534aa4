"""Column-level building blocks; everything here is a Spark expression."""

from .dates import DATE_FORMATS, date_format_of, parse_date
from .enums import EnumRules, canonical_value
from .numbers import (
    exact_sum,
    half_up,
    money_text,
    number_text,
    parse_number,
    per_mile_text,
    ratio,
)
from .text import name_key, name_tokens, title_case_place, upper_code, wide_trim

__all__ = [
    "DATE_FORMATS",
    "EnumRules",
    "canonical_value",
    "date_format_of",
    "exact_sum",
    "half_up",
    "money_text",
    "name_key",
    "name_tokens",
    "number_text",
    "parse_date",
    "parse_number",
    "per_mile_text",
    "ratio",
    "title_case_place",
    "upper_code",
    "wide_trim",
]
