"""Parsers of source text values: a value in the accepted form, or null.

None of them raises on any input. Patterns are anchored with \\A and \\z, because `$` also
matches before a trailing line feed.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MAX = 2147483647
BIGINT_MAX = 9223372036854775807


def _trimmed(s: Column) -> Column:
    """Without the spaces (only spaces) around it."""
    return F.trim(s)


# Each parser is one pattern and one cast of a cell, with every part written once: what stands several times in an expression is
# generated several times, and the JVM does not compile the method of a row that grows too long by it.
#
# The quick_ forms give the same values. Cells in the plainest spelling, which are nearly all, don't reach the pattern in them: a
# number is so spelled if it gives the same text again. They hold their cell several times, so they are for projections that are wide
# anyway and that Spark cuts into methods (`operators/clean.py`).


def source_date_text(s: Column) -> Column:
    """YYYYMMDD as text that casts to the date if it is a real calendar day in years 1 to 9999, and to none if not."""
    # another text gives the bare separators, which are no date
    return F.regexp_replace(s, r"\A(?: *(?!0000)([0-9]{4})([0-9]{2})([0-9]{2}) *\z|(?s:.*))", "$1-$2-$3")


def source_date(s: Column) -> Column:
    """YYYYMMDD of a real calendar day in years 1 to 9999."""
    return source_date_text(s).try_cast("date")


def source_timestamp_text(s: Column) -> Column:
    """YYYYMMDD HHMM as ISO text that casts to the time if there is such a time, and to none if not."""
    shaped = r"\A(?: *(?!0000)([0-9]{4})([0-9]{2})([0-9]{2}) ([0-9]{2})([0-9]{2}) *\z|(?s:.*))"
    return F.regexp_replace(s, shaped, "$1-$2-$3T$4:$5:00")


def source_timestamp(s: Column) -> Column:
    """YYYYMMDD HHMM, hours 0 to 23 and minutes 0 to 59, without a time zone."""
    return source_timestamp_text(s).try_cast("timestamp_ntz")


def _plain_day(s: Column) -> tuple[Column, list[Column]]:
    """(whether a text is a number of eight digits, the pieces of its date text)."""
    n, dash = s.try_cast("int"), F.lit("-")
    return n.between(10000000, 99999999) & (n.cast("string") == s), [F.substring(s, 1, 4), dash, F.substring(s, 5, 2), dash, F.substring(s, 7, 2)]


def quick_date_text(s: Column) -> Column:
    plain, pieces = _plain_day(s)
    return F.when(plain, F.concat(*pieces)).otherwise(source_date_text(s))


def quick_timestamp_text(s: Column) -> Column:
    plain, pieces = _plain_day(F.substring(s, 1, 8))
    # hours and minutes as one number behind their space; a longer rest differs
    clock = F.lpad(F.substring(s, 10, 4).try_cast("int").cast("string"), 5, " 000") == F.substring(s, 9, 6)
    iso = F.concat(*pieces, F.lit("T"), F.substring(s, 10, 2), F.lit(":"), F.substring(s, 12, 2), F.lit(":00"))
    return F.when(plain & clock, iso).otherwise(source_timestamp_text(s))


def _number(s: Column, digits: str) -> Column:
    """The digits of a number with an optional plus and zero decimals, without leading zeros; empty if it is none."""
    return F.regexp_extract(s, rf"\A *[+]?0*({digits})(?:[.]0+)? *\z", 1)


def nonnegative_integer(s: Column, maximum: int = INT_MAX) -> Column:
    """A number of at most `maximum`, as a bigint."""
    n = _number(s, f"[0-9]{{1,{len(str(maximum))}}}")
    if maximum == INT_MAX:
        return n.try_cast("int").cast("bigint")
    n = n.try_cast("decimal(20,0)")
    return F.when(n <= F.lit(maximum).cast("decimal(20,0)"), n.cast("bigint"))


def quick_integer(s: Column) -> Column:
    """nonnegative_integer up to INT_MAX."""
    own = s.try_cast("int")
    return F.when((own >= 0) & (own.cast("string") == s), own.cast("bigint")).otherwise(nonnegative_integer(s))


def positive_id(s: Column) -> Column:
    """A bigint above zero, spelled without sign, zeros or decimals."""
    return _number(s, "[1-9][0-9]{0,18}").try_cast("bigint").cast("string")


def quick_id(s: Column) -> Column:
    own = s.try_cast("bigint")
    return F.when((own > 0) & (own.cast("string") == s), s).otherwise(positive_id(s))


def report_time(s: Column) -> Column:
    """HHMM as a number, minutes at most 59."""
    return _number(s, "(?:(?:1[0-9]|2[0-3]|[1-9])?[0-5])?[0-9]").try_cast("bigint")


def quick_time(s: Column) -> Column:
    """report_time; zeros before the digits are plain as well."""
    own = s.try_cast("int")
    plain = own.between(0, 2359) & (F.pmod(own, F.lit(100)) < 60) & (F.lpad(own.cast("string"), F.length(s), "0") == s)
    return F.when(plain, own.cast("bigint")).otherwise(report_time(s))


def source_boolean(s: Column) -> Column:
    t = F.lower(_trimmed(s))
    return F.when(t.isin("y", "yes", "1", "true"), True).when(t.isin("n", "no", "0", "false"), False)


def request_usdot(s: Column) -> Column:
    """The stricter number of a lookup request: 1 to 19 digits after all white space is cut, above zero."""
    t = F.regexp_replace(s, r"\A\s+|\s+\z", "")
    value = F.when(t.rlike(r"\A[0-9]{1,19}\z"), t.try_cast("decimal(38,0)"))
    return F.when((value > 0) & (value <= F.lit(BIGINT_MAX).cast("decimal(38,0)")), value.cast("bigint").cast("string"))


def reasons(*checks: tuple[Column, str]) -> Column:
    """The names of the checks that failed, in their order."""
    # the list is made by an interpreted function, so only rows that fail some check get to it
    some = reduce(or_, [failed for failed, _ in checks])
    return F.when(some, F.array_compact(F.array(*[F.when(failed, F.lit(name)) for failed, name in checks]))).otherwise(F.array().cast("array<string>"))


def first_reason(found: Column) -> Column:
    return F.get(found, F.lit(0))


def lag_bucket(days: Column) -> Column:
    """The ten labelled ranges of report lags."""
    bounds = [(2, "01 1-2 days"), (7, "02 3-7 days"), (14, "03 8-14 days"), (30, "04 15-30 days"), (60, "05 31-60 days")]
    bounds += [(90, "06 61-90 days"), (180, "07 91-180 days"), (270, "08 181-270 days")]
    out = F.when(days == 0, "00 same day")
    for most, label in bounds:
        out = out.when(days <= most, label)
    return F.when(days.isNotNull(), out.otherwise("09 271+ days"))


LAG_BUCKETS = (
    "00 same day", "01 1-2 days", "02 3-7 days", "03 8-14 days", "04 15-30 days",
    "05 31-60 days", "06 61-90 days", "07 91-180 days", "08 181-270 days", "09 271+ days",
)
