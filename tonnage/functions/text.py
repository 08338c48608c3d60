"""Column expressions for text cells: blanks, widths, numbers, dates, vocabularies.

All are built-in expressions, so they stay inside generated code and a scan reads only what they use.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Text that is read as a number; Java's suffixes, NaN and infinities are not.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


#: The characters of Unicode's White_Space.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without Unicode white space at either end (``trim`` alone knows only the blank)."""
    return F.btrim(c, F.lit(BLANKS))


def collapse(c: Column) -> Column:
    """Runs of white space as one blank; text that has none but single blanks is not rewritten."""
    return F.when(c.rlike(r"(?U)\s\s|[^\S ]"), F.regexp_replace(c, r"(?U)\s+", " ")).otherwise(c)


def normalized_key(c: Column) -> Column:
    """Lower case, white space collapsed; absent text is empty."""
    return F.lower(strip(collapse(F.coalesce(c, F.lit("")))))


def blank_to_null(c: Column) -> Column:
    """Null for absent or blank text, otherwise the text as it is."""
    return F.when(strip(c) != "", c)


def fit(c: Column, limit: int) -> Column:
    """Null for blank text and for text longer than ``limit``: never cut."""
    text = blank_to_null(c)
    return F.when(F.length(text) <= limit, text)


def too_long(c: Column, limit: int) -> Column:
    return F.coalesce(F.length(blank_to_null(c)) > limit, F.lit(False))


def number(c: Column) -> Column:
    """The number that stripped text says, else null."""
    text = strip(c)
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def day(c: Column) -> Column:
    """Midnight UTC of ``yyyy-MM-dd`` text, else null; text is not stripped."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))


def unreadable(c: Column, read: Column) -> Column:
    """Text that is there but that ``read`` (an expression of it) makes nothing of."""
    return blank_to_null(c).isNotNull() & read.isNull()


def mapped(c: Column, values: Mapping[str, object]) -> Column:
    """Stripped text looked up in a vocabulary; null where it has no entry."""
    table = F.create_map(*(F.lit(x) for pair in values.items() for x in pair))
    return table[strip(F.coalesce(c, F.lit("")))]


def flags(*names: str) -> Column:
    """A sorted list literal of quality flags."""
    return F.array(*(F.lit(x) for x in sorted(set(names)))).cast("array<string>")


def sorted_flags(c: Column) -> Column:
    return F.array_sort(F.array_distinct(c))
