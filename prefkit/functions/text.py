"""String columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spelled out because Java and RE2 disagree on what \s covers.
BLANKS = r"[\t\n\x0B\f\r \p{Z}]+"


def words(text: Column) -> Column:
    """Whitespace-separated words of a text; an empty array for blank text."""
    return F.array_remove(F.split(text, BLANKS), "")


def strip_all(text: Column) -> Column:
    """Trim any Unicode whitespace (Spark's ``trim`` removes spaces only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_stop_word(text: Column, stop: str = "exit") -> Column:
    return F.lower(strip_all(text)) == stop


def or_default(value: Column, default: str) -> Column:
    """``value``, or ``default`` where it is empty or null."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))
