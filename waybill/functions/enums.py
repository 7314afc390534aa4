"""Bringing free spellings back to a closed list of values."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WIDE_SPACE


@dataclass(frozen=True)
class EnumRules:
    """How to read one enumerated column.

    ``spellings`` are compared in order: the first one exactly, then the
    ``prefixes``, then every spelling again within ``max_edits`` edits.
    """

    values: tuple[str, ...]
    spellings: tuple[tuple[str, str], ...]
    prefixes: tuple[tuple[str, str], ...] = field(default=())
    max_edits: int = 2


def canonical_value(c: Column, rules: EnumRules) -> Column:
    """The listed value a text stands for, or null."""
    v = F.translate(F.lower(c), "-_" + WIDE_SPACE, "")
    first_key, first_value = rules.spellings[0]
    out = F.when(v == "", F.lit(None).cast("string")).when(v == first_key, first_value)
    for start, value in rules.prefixes:
        out = out.when(v.startswith(start), value)
    for key, value in rules.spellings:
        out = out.when(F.levenshtein(v, F.lit(key), rules.max_edits) >= 0, value)
    return out
