"""Text clean-up as Column expressions: trimming, name keys, place casing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the source format counts as white space.
# Spark's own trim() strips only U+0020 and Java's \s covers only ASCII.
WIDE_SPACE = (
    "\t\n\x0b\f\r \u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# The same set as the inside of a Java regex character class.
WIDE_SPACE_CLASS = (
    r"\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
)


def wide_trim(c: Column) -> Column:
    """Strip every kind of white space from both ends, without a regex.

    A text that begins and ends with printable ASCII is left as it is, which is
    much quicker to see.
    """
    last = F.substring(c, -1, 1)
    bare = (c >= "!") & (c < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(bare, c).otherwise(F.btrim(c, F.lit(WIDE_SPACE)))


def name_key(c: Column) -> Column:
    """Lower-case letters and digits only: the form in which names are compared."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def name_tokens(c: Column) -> Column:
    """Distinct lower-case words of a name in camelCase, snake_case or free text."""
    spaced = F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2")
    parts = F.split(F.lower(spaced), "[^a-z0-9]+")
    return F.array_distinct(F.filter(parts, lambda p: p != ""))


def title_case_place(c: Column) -> Column:
    """Capitalise the purely alphabetic parts of a place name.

    Parts are separated by white space, full stops and hyphens, which are kept.
    A part holding anything else (an apostrophe, a digit) is left as it is.
    """
    # Words separated by spaces, with or without a full stop: by far the most
    # names, and there initcap does the same without the array expression.
    plain = r"^[A-Za-z]+(?:\.? +[A-Za-z]+)*\z"
    letters = r"^[A-Za-z]+\z"

    def cap(p: Column) -> Column:
        return F.concat(F.upper(F.left(p, F.lit(1))), F.lower(F.substr(p, F.lit(2))))

    pieces = F.regexp_extract_all(
        c,
        F.lit(rf"[^{WIDE_SPACE_CLASS}.\-]+|[{WIDE_SPACE_CLASS}]+|[.\-]"),
        F.lit(0),
    )
    by_part = F.array_join(
        F.transform(pieces, lambda p: F.when(p.rlike(letters), cap(p)).otherwise(p)), ""
    )
    return F.when(c.rlike(plain), F.initcap(c)).otherwise(by_part)


def upper_code(c: Column) -> Column:
    return F.upper(wide_trim(c))
