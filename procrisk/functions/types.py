"""Typing of text columns. A value that does not fit becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dates that begin with the year, besides ISO: what is matched, and the same in ISO form.
_YEAR_FIRST = [
    (r"^(\d{4})/(\d{2})/(\d{2})(.*)$", "$1-$2-$3$4"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
]
# Dates that end with the year can be read in two ways. A column has one of them.
DAY_FIRST, MONTH_FIRST = "day_first", "month_first"
_YEAR_LAST = r"^(\d{1,2})[./-](\d{1,2})[./-](\d{4})(.*)$"
_READ = {DAY_FIRST: "$3-$2-$1$4", MONTH_FIRST: "$3-$1-$2$4"}
_NO_MONTH = r"^(1[3-9]|2\d|3[01])[./-](\d{1,2})[./-](\d{4})(.*)$"
_OFFSET = r"^(\d{4}-\d{2}-\d{2}[T ].*?\d)\s*([+-])(\d{2}):?(\d{2})$"


def to_number(column: Column) -> Column:
    """Text to double; ``NaN`` is a missing value."""
    number = column.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_whole(column: Column) -> Column:
    """Text to int; accepts ``6`` and ``6.0``."""
    return column.try_cast("double").try_cast("int")


def is_year_last(column: Column) -> Column:
    """Whether a text looks like a date that ends with the year."""
    return F.trim(column.cast("string")).rlike(_YEAR_LAST)


def to_moment(column: Column, layout: str | None = None) -> Column:
    """Text to timestamp without zone; a stamp with an offset is placed in UTC.

    ``layout`` tells how dates that end with the year are read. Without it each value is
    read by itself: month first, unless its first number cannot be one.
    """
    text = F.trim(column.cast("string"))
    if layout is None:
        text = F.regexp_replace(text, _NO_MONTH, _READ[DAY_FIRST])
    text = F.regexp_replace(text, _YEAR_LAST, _READ[layout or MONTH_FIRST])
    for form, iso in _YEAR_FIRST:
        text = F.regexp_replace(text, form, iso)
    local = F.regexp_replace(F.regexp_replace(text, _OFFSET, "$1"), "[Zz]$", "")
    part = lambda k: F.regexp_extract(text, _OFFSET, k)
    hours, minutes = part(3).try_cast("int"), part(4).try_cast("int")
    east = F.make_dt_interval(F.lit(0), F.coalesce(hours, F.lit(0)), F.coalesce(minutes, F.lit(0)))
    moment = local.try_cast("timestamp_ntz")
    return F.when(part(2) == "+", moment - east).when(part(2) == "-", moment + east).otherwise(moment)


def coerce(column: Column, kind: str, layout: str | None = None) -> Column:
    """Column typed as ``kind``, one of the flat column types; dates are read by ``layout``."""
    if kind == "double":
        return to_number(column)
    if kind == "int":
        return to_whole(column)
    if kind == "timestamp_ntz":
        return to_moment(column, layout)
    return column.cast(kind)


def money(column: Column) -> Column:
    """Exact decimal, so that sums do not depend on row order; NULL beyond 10^22."""
    return column.try_cast("decimal(28,6)")
