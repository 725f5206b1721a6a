"""Reusable column expressions.

Everything here returns a ``Column`` made of Spark built-ins so it stays inside
whole-stage codegen.  Semantics follow the pandas operations they replace.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's ``str.isspace`` set: ASCII \t..\r, the file/group/record/unit
# separators, NEL and every Unicode separator (Zs, Zl, Zp).  Java's ``\s`` alone
# misses U+001C-U+001F, U+0085 and NBSP.
WS_CLASS = r"[\x09-\x0D\x1C-\x1F\x85\p{Z}]"

# Strings pandas' ``to_numeric`` accepts: decimal / scientific numbers and the
# inf / nan spellings, with surrounding whitespace.  Spark's cast also accepts
# Java suffixes such as ``1d``, so the cast sits behind this guard.
_NUMERIC_RE = (
    r"^" + WS_CLASS + r"*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))"
    + WS_CLASS + r"*$"
)

# Timestamps that begin with a year: blank or T between date and time, a fraction of up
# to nine digits (read to the microsecond), and Z or an offset, which is taken to UTC.
_ISO_RE = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?\s?(Z|[+-]\d{1,2}(:?\d{2})?)?)?$"

# Tried in order on what the expression above does not match.
DEFAULT_TIMESTAMP_FORMATS = (
    "yyyy-MM-dd h:mm[:ss] a",
    "yyyy/M/d[ H:mm[:ss]]",
    "M/d/yyyy[ H:mm[:ss]]",
    "M/d/yyyy h:mm[:ss] a",
    "MMM d, yyyy[ H:mm[:ss]]",
    "MMM d, yyyy h:mm[:ss] a",
)


#: The same with the day first in slashed dates.
DAY_FIRST_FORMATS = tuple(f.replace("M/d/yyyy", "d/M/yyyy") for f in DEFAULT_TIMESTAMP_FORMATS)
#: A slashed date that ends with its year; its first two numbers tell the order if one is above 12.
SLASHED_RE = r"^(\d{1,2})/(\d{1,2})/\d{4}(?!\d)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace; NULL stays NULL."""
    return F.regexp_replace(_col(c), f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def clean_text(c: str | Column) -> Column:
    """NULL -> '', every whitespace run -> one space, then strip."""
    collapsed = F.regexp_replace(F.coalesce(_col(c).cast("string"), F.lit("")), f"{WS_CLASS}+", " ")
    return F.trim(collapsed)


def nan_to_null(c: str | Column) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def parse_number(c: str | Column) -> Column:
    """Coercing numeric parse: bad text -> NULL, NaN -> NULL (never NaN)."""
    c = _col(c)
    s = c.cast("string")
    parsed = F.when(s.rlike(_NUMERIC_RE), strip_ws(s).try_cast("double"))
    return nan_to_null(parsed)


def parse_timestamp(c: str | Column, formats: Sequence[str] = DEFAULT_TIMESTAMP_FORMATS) -> Column:
    """Coercing timestamp parse to TIMESTAMP_NTZ, else NULL: ISO spellings, then the first matching format.

    A value with a zone becomes its UTC time; the session's zone must be UTC, as
    :func:`caseflow.session.get_spark` sets it.
    """
    s = strip_ws(_col(c).cast("string"))
    offset = F.regexp_replace(s, r"([+-]\d{2})(\d{2})$", "$1:$2")
    iso = F.when(s.rlike(_ISO_RE), F.when(s.rlike(r":.*[+-]\d{4}$"), offset).otherwise(s).try_cast("timestamp"))
    tries = [F.when(~s.rlike(_ISO_RE), F.try_to_timestamp(s, F.lit(fmt))) for fmt in formats]
    return F.coalesce(iso, *tries).cast("timestamp_ntz")


def _micros(start: str | Column, end: str | Column) -> Column:
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """(end - start) in fractional minutes, exact from microseconds; NULL if either is NULL."""
    return _micros(start, end) / 1e6 / 60


def hours_between(start: str | Column, end: str | Column) -> Column:
    return _micros(start, end) / 1e6 / 3600


def days_between(start: str | Column, end: str | Column) -> Column:
    return _micros(start, end) / 1e6 / 86400


def week_start(c: str | Column) -> Column:
    """Monday 00:00 of the timestamp's week, as TIMESTAMP_NTZ (time-zone free)."""
    return F.trunc(F.to_date(_col(c)), "week").cast("timestamp_ntz")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den with a zero or NULL denominator giving NULL (ANSI-safe)."""
    return F.try_divide(_col(num).cast("double"), F.nullif(_col(den), F.lit(0)).cast("double"))


def true_or_false(c: Column) -> Column:
    """A predicate whose NULL outcome counts as False."""
    return F.coalesce(c, F.lit(False))
