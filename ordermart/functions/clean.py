"""Column -> Column cleaning expressions (all JVM-side, no Python UDF).

They reproduce Python text handling of the source pipeline with built-in
functions so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes by default
# (str.isspace): U+0009..U+000D, U+001C..U+0020, U+0085, U+00A0, U+1680,
# U+2000..U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Number grammars accepted by Python int() / float(), with single '_' between
# digits (without nan and inf, see README "Known divergences").
_DIGITS = r"[0-9]+(_[0-9]+)*"
INT_PATTERN = rf"\A[+-]?{_DIGITS}\z"
FLOAT_PATTERN = rf"\A[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?\z"
# strptime('%Y-%m-%d'): four-digit year, one- or two-digit month, and a
# one- or two-digit day or a space and one digit (``%d`` accepts " 5").
DATE_PATTERN = r"\A(?!0000)[0-9]{4}-[0-9]{1,2}-([0-9]{1,2}| [1-9])\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """``s.strip()``: remove leading and trailing whitespace (NULL stays NULL).

    ``btrim`` with an explicit character set (no regex), run only when the
    first or last character is whitespace other than a space -- most values
    need no more than the plain ``trim``.
    """
    x = _col(c)
    ws = list(PY_WHITESPACE)
    trimmed = F.trim(x)
    edge = F.substring(trimmed, 1, 1).isin(ws) | F.substring(trimmed, -1, 1).isin(ws)
    return F.when(edge, F.btrim(x, F.lit(PY_WHITESPACE))).otherwise(trimmed)


def strip_or_empty(c: Column | str) -> Column:
    """``(s or "").strip()``: NULL becomes the empty string."""
    return F.coalesce(strip(c), F.lit(""))


def to_int(c: Column | str) -> Column:
    """``int(s.strip())`` or NULL."""
    s = strip(c)
    return F.when(s.rlike(INT_PATTERN), _plain(s).try_cast("int"))


def to_double(c: Column | str) -> Column:
    """``float(s.strip())`` or NULL; NULL too where it is too large for a double."""
    s = strip(c)
    x = _plain(s).try_cast("double")
    # short plain digits need no look at their value
    small = (F.length(s) <= 100) & ~s.contains("e") & ~s.contains("E")
    return F.when(s.rlike(FLOAT_PATTERN) & (small | (F.abs(x) < float("inf"))), x)


def _plain(s: Column) -> Column:
    """Digit separators removed."""
    return F.replace(s, F.lit("_"), F.lit(""))


def to_date(c: Column | str, first_token: bool = True) -> Column:
    """Parse ``yyyy-m-d`` strictly, NULL on anything else.

    ``first_token`` keeps only the text before the first space (batch rule:
    ``2024-01-05 10:00:00`` is accepted); order entry parses the whole value.
    Year 0000 is rejected like Python's datetime does.
    """
    s = strip(c)
    if first_token:
        s = F.substring_index(s, " ", 1)
    return F.when(s.rlike(DATE_PATTERN), F.replace(s, F.lit(" "), F.lit("")).try_cast("date"))


def default_unknown(c: Column | str) -> Column:
    """``s.strip() or "Unknown"``."""
    return F.coalesce(F.nullif(strip(c), F.lit("")), F.lit("Unknown"))


def to_active_flag(c: Column | str) -> Column:
    """1 only for the text ``true`` in any case, else 0."""
    return F.when(F.lower(strip(c)) == "true", 1).otherwise(0).cast("smallint")


def flag(cond: Column) -> Column:
    """0/1 SMALLINT flag; an unknown (NULL) condition counts as 0."""
    return F.when(cond, 1).otherwise(0).cast("smallint")
