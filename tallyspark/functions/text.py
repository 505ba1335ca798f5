"""String helpers with Python string semantics, as JVM column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pystrip(c: Column) -> Column:
    """``str.strip()``: remove leading and trailing Unicode whitespace.

    ``F.trim`` removes spaces only; ``(?U)\\s`` also covers tabs, NBSP and the
    wide spaces. The separator controls ``\\x1c-\\x1f`` are stripped too, as
    Python does.
    """
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def has(c: Column, needle: str) -> Column:
    """``needle in c`` with NULL read as 'not contained'."""
    return F.coalesce(c.contains(needle), F.lit(False))


def part(arr: Column, i: int) -> Column:
    """0-based element, NULL when out of range (``arr[i]`` raises under ANSI)."""
    return F.get(arr, i)


def py_split(c: Column, sep: str) -> Column:
    """``str.split(sep)`` on a literal separator, empty pieces kept."""
    import re
    return F.split(c, re.escape(sep), -1)
