"""Text functions as Column expressions (JVM-side, inside whole-stage codegen).

Fixed values that must equal the reference's behaviour:
  - a word is a maximal run of the ASCII characters A-Z, a-z, 0-9; every
    other character (each non-ASCII character included) separates words;
  - lower-casing maps only A-Z to a-z (C locale), nothing else changes;
  - query lines are split on the C white-space set: space, \\t, \\n, \\v, \\f, \\r.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
WORD_PATTERN = "[A-Za-z0-9]+"
NON_WORD_CHAR = "[^A-Za-z0-9]"
# Java regex: \x0B is the vertical tab (\v means something else in Java).
QUERY_SPACE = "[ \\t\\n\\x0B\\f\\r]+"

_PY_LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower_ascii(c: Column | str) -> Column:
    """A-Z to a-z only. ``lower`` would also fold e.g. the Kelvin sign to k."""
    return F.translate(_col(c), ASCII_UPPER, ASCII_LOWER)


def lower_ascii_py(s: str) -> str:
    """The same mapping for driver-side literals (query parameters)."""
    return s.translate(_PY_LOWER)


def alnum_count(c: Column | str) -> Column:
    """Number of ASCII letters and digits in a text."""
    return F.length(F.regexp_replace(_col(c), NON_WORD_CHAR, "")).cast("bigint")


def tokens(c: Column | str) -> Column:
    """Lower-cased words of a text, in order, repeats kept (ARRAY<STRING>).

    Words are extracted from the raw text, then lower-cased together as one
    space-joined string: every word is pure ASCII, so ``lower`` is exactly
    A-Z -> a-z on it, and lower-casing only the words is cheaper than
    translating the whole text. No lambdas: it stays in whole-stage codegen.
    ``array_remove`` drops the single empty piece a text without words gives.
    """
    words = F.regexp_extract_all(_col(c), F.lit(WORD_PATTERN), 0)
    return F.array_remove(F.split(F.lower(F.array_join(words, " ")), " "), "")


def distinct_tokens(c: Column | str) -> Column:
    """Words of a text without repeats, in order of first occurrence.

    Dedups inside the row, so exploding it needs no shuffle to reach a set.
    """
    return F.array_distinct(tokens(c))


def query_tokens(c: Column | str) -> Column:
    """White-space split of a request line, empty pieces dropped (raw case).

    Lambda-free (``array_remove``), so it stays in codegen and identical
    plans canonicalise equal, which lets Spark reuse their exchanges."""
    return F.array_remove(F.split(_col(c), QUERY_SPACE), "")
