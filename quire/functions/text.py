"""Column expressions for text handling.

All functions return ``Column`` expressions so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes (``str.isspace``),
# in code-point order. Spark's ``trim`` only removes ' ' and ``\s`` differs, so
# stripping uses exactly this set.
PY_WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d"
    "\u001c\u001d\u001e\u001f\u0020"
    "\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


# The same set as a Java regex class: Unicode White_Space plus U+001C..U+001F
# (checked equal to ``str.isspace`` over the whole BMP). Use under ``(?U)``.
PY_WHITESPACE_CLASS = "(?U)[\\s\\x{1c}-\\x{1f}]"
PY_NON_WHITESPACE_CLASS = "(?U)[^\\s\\x{1c}-\\x{1f}]"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: str | Column) -> Column:
    """``str.strip()`` with no argument."""
    return F.btrim(col_of(c), F.lit(PY_WHITESPACE))


def is_blank(c: str | Column) -> Column:
    return py_strip(c) == F.lit("")


def has_content(c: str | Column) -> Column:
    """True when the text has a non-whitespace character (stops at the first one)."""
    return col_of(c).rlike(PY_NON_WHITESPACE_CLASS)


def clean_text(c: str | Column) -> Column:
    """Stripped text, or null when the value is missing or blank.

    Non-string inputs are rejected by the schema at scan time (see
    ``quire.sources.corpus``), so this only handles null and blank.
    """
    s = py_strip(c)
    return F.when(s != F.lit(""), s)


def truncate_at_stops(c: str | Column, stops: list[str]) -> Column:
    """Cut text at each stop string in turn (text before the first occurrence).

    An empty stop string is skipped (in Python it would raise on ``split('')``).
    """
    out = col_of(c)
    for stop in stops:
        if stop == "":
            continue
        out = F.substring_index(out, stop, 1)
    return out


def prompt_strip(c: str | Column) -> Column:
    """Raw prompt for base models: stripped, no chat template."""
    return py_strip(c)


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))
