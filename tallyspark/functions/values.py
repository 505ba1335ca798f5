"""Metric value parsing and formatting, as JVM column expressions.

A value cell is read like Python's ``float(text)`` after the CSV reader has
turned missing-value tokens into NaN. Spark's own string->double cast is both
wider (``1.0d``, ``0x1p3``) and narrower (``1_000``) than Python's grammar, so
the text is checked against Python's grammar first and cast only then.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.constants import NA_TOKENS
from tallyspark.functions.text import pystrip

# Python float() grammar (ASCII digits): digit groups may hold single
# underscores between digits; inf / infinity / nan in any case.
_DIGITS = r"[0-9](?:_?[0-9])*"
FLOAT_RE = (rf"^[+-]?(?:(?:{_DIGITS})?\.{_DIGITS}|{_DIGITS}\.?)(?:[eE][+-]?{_DIGITS})?$")
SPECIAL_RE = r"(?i)^[+-]?(?:inf|infinity|nan)$"
INT_RE = rf"^[+-]?{_DIGITS}$"


def is_missing(raw: Column) -> Column:
    """Cell the CSV reader turns into NaN: absent, empty or a missing token."""
    return raw.isNull() | raw.isin(NA_TOKENS)


# The common cell: plain digits with an optional sign and fraction. Spark's
# cast and Python agree on it, so it skips the full grammar check.
PLAIN_RE = r"^-?[0-9]+(\.[0-9]+)?$"


def odd_cell(raw: Column) -> Column:
    """The stripped text of a cell that is neither missing nor plain digits;
    NULL for the usual ones. Put into a projection of its own before
    ``parse_value`` it is read three times and stripped once."""
    return F.when(~is_missing(raw) & ~raw.rlike(PLAIN_RE), pystrip(raw))


def parse_value(raw: Column, odd: Column | None = None) -> Column:
    """``float(cell)``; NaN for missing cells; NULL when Python would raise.
    ``odd``: ``odd_cell(raw)`` where that is already there."""
    t = odd_cell(raw) if odd is None else odd
    numeric = F.replace(t, F.lit("_"), F.lit("")).cast("double")
    special = (F.when(F.lower(raw).contains("nan"), F.lit(float("nan")))
               .when(raw.contains("-"), F.lit(float("-inf")))
               .otherwise(F.lit(float("inf"))))
    return (F.when(is_missing(raw), F.lit(float("nan")))
            .when(t.isNull(), raw.cast("double"))
            .when(t.rlike(FLOAT_RE), numeric)
            .when(t.rlike(SPECIAL_RE), special)
            .otherwise(F.lit(None).cast("double")))


def value_ok(raw: Column) -> Column:
    """True when ``parse_value`` succeeds (reject rule for bad values)."""
    t = pystrip(raw)
    # CASE, not OR: the strip runs only for cells the cheap tests leave open
    return (F.when(is_missing(raw) | raw.rlike(PLAIN_RE), F.lit(True))
            .otherwise(t.rlike(FLOAT_RE) | t.rlike(SPECIAL_RE)))


def parse_int(raw: Column) -> Column:
    """``int(text)``: surrounding whitespace, sign and digit underscores allowed."""
    t = pystrip(raw)
    return F.when(t.rlike(INT_RE), F.regexp_replace(t, "_", "").try_cast("int"))


def format_value(v: Column) -> Column:
    """Python ``str(float)`` text of a double.

    Java prints scientific notation below 1e-3 and from 1e7; Python does so
    below 1e-4 and from 1e16, with a signed, at least two-digit exponent.
    Between those bounds the value goes through a decimal (built from Java's
    shortest digits) and loses its trailing zeros; beyond them Java's exponent
    form is rewritten. Kept compact on purpose: the generated code stays small
    enough to be compiled. Java 17 is not always shortest (e.g. 2e23,
    denormals); such values keep Java's digits.
    """
    s = v.cast("string")
    mag = F.abs(v)

    # between the bounds: decimal digits without trailing zeros
    wide = mag >= F.lit(1e7)
    digits = F.rtrim(F.when(wide, v.cast("decimal(38,18)").cast("string")).otherwise(v.cast("decimal(38,25)").cast("string")),
                     F.lit("0"))
    plain = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    # beyond them: mantissa without ".0", explicit sign, two exponent digits
    exponent = F.substring_index(s, "E", -1)
    places = F.replace(exponent, F.lit("-"), F.lit(""))
    py_sci = F.concat(F.replace(F.concat(F.substring_index(s, "E", 1), F.lit("e")), F.lit(".0e"), F.lit("e")),
                      F.when(F.startswith(exponent, F.lit("-")), F.lit("-")).otherwise(F.lit("+")),
                      F.when(F.length(places) == 1, F.lit("0")).otherwise(F.lit("")), places)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(v), F.lit("nan"))
            .when(mag == float("inf"), F.when(v > 0, F.lit("inf")).otherwise(F.lit("-inf")))
            .when((wide & (mag < F.lit(1e16))) | ((mag >= F.lit(1e-4)) & (mag < F.lit(1e-3))), plain)
            .when((mag >= F.lit(1e16)) | ((mag < F.lit(1e-4)) & (mag > F.lit(0.0))), py_sci)
            .otherwise(s))
