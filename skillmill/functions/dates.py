"""Date expressions for report cells that mix several spellings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from skillmill.functions.text import blank_to_null, let, strip

# The first and last day a nanosecond timestamp can hold.
FIRST_DAY = dt.date(1677, 9, 22)
LAST_DAY = dt.date(2262, 4, 11)

# Two-digit years are read near this year unless the caller names another.
THIS_YEAR = 2025

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = (
    "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|"
    "aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_WEEKDAY = "(?:(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?,? +)?"
_TIME = (
    r"[T ]+(?:[01]?\d|2[0-3]):[0-5]?\d(?::[0-5]?\d(?:\.\d+)?)?"
    r"(?: ?[AaPp][Mm])?(?: ?(?:Z|UTC|[+-]\d{2}:?\d{2}))?$"
)

# The plain form, in years that are always within the range above.
_PLAIN = r"^(?:1[7-9]|2[01])\d\d-\d{1,2}-\d{1,2}$"
_PLAIN_DAY_FIRST = r"^(\d{1,2})[-/.](\d{1,2})[-/.]((?:1[7-9]|2[01])\d\d)$"

_YEAR_FIRST = r"^(\d{4})-(\d{1,2})-(\d{1,2})$"
_YEAR_FIRST_OTHER = r"^(\d{4})[/. ](\d{1,2})[/. ](\d{1,2})$"
_DAY_FIRST = r"^(\d{1,2})[-/. ](\d{1,2})[-/. ](\d{4})$"
_SECOND_IS_MONTH = r"^\d{1,2}[-/. ](?:0?[1-9]|1[0-2])[-/. ]"
_SHORT_YEAR = r"^(\d{1,2})[-/. ](\d{1,2})[-/. ](\d{2})$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"
_YEAR_MONTH = r"^(\d{4})(?:[-/.](\d{1,2}))?$"
_MONTH_YEAR = r"^(\d{1,2})[-/.](\d{4})$"
_MONTH_DAY = rf"(?i)^{_WEEKDAY}{_MONTH} +(\d{{1,2}})(?:st|nd|rd|th)?,? +(\d{{4}}|\d\d)$"
_YEAR_MONTH_NAME = rf"(?i)^(\d{{4}})-{_MONTH}-(\d{{1,2}})$"
_DAY_MONTH = rf"(?i)^{_WEEKDAY}(\d{{1,2}})(?:st|nd|rd|th)?[- ]{_MONTH}[-, ]+(\d{{4}}|\d\d)$"


def _read(text: Column, pattern: str, order: str) -> Column:
    """The groups of ``pattern`` in the given order, as a date."""
    return F.regexp_replace(text, pattern, order).try_cast("date")


def _day_first(text: Column, pattern: str, year: str) -> Column:
    """The second number is the month unless it cannot be one."""
    order = F.when(text.rlike(_SECOND_IS_MONTH), F.lit(f"{year}-$2-$1")).otherwise(
        F.lit(f"{year}-$1-$2")
    )
    return F.regexp_replace(text, F.lit(pattern), order).try_cast("date")


def _nearest_century(d: Column, this_year: int) -> Column:
    return F.when(F.year(d) >= this_year + 50, F.add_months(d, -1200)).otherwise(d)


def _without_month_name(text: Column) -> Column:
    """Month names as numbers, day first."""
    day_first = F.regexp_replace(
        F.regexp_replace(text, _MONTH_DAY, "$2 $1 $3"), _YEAR_MONTH_NAME, "$3 $2 $1"
    )

    def numbered(t: Column) -> Column:
        word = F.lower(F.left(F.regexp_extract(t, _DAY_MONTH, 2), F.lit(3)))
        month = ((F.position(word, F.lit(_MONTHS)) + 2) / 3).cast("int").cast("string")
        return F.when(
            t.rlike(_DAY_MONTH),
            F.concat(
                F.regexp_replace(t, _DAY_MONTH, "$1 "), month, F.regexp_replace(t, _DAY_MONTH, " $3")
            ),
        ).otherwise(t)

    return let(day_first, numbered)


def _read_any(text: Column, strict_dates: bool, this_year: int) -> Column:
    year_day_month = _read(text, _YEAR_FIRST_OTHER, "$1-$3-$2")
    year_month_day = _read(text, _YEAR_FIRST_OTHER, "$1-$2-$3")
    return (
        F.when(text.rlike(_YEAR_FIRST), text.try_cast("date"))
        .when(text.rlike(_DAY_FIRST), _day_first(text, _DAY_FIRST, "$3"))
        .when(
            text.rlike(_SHORT_YEAR),
            _nearest_century(_day_first(text, _SHORT_YEAR, "20$3"), this_year),
        )
        .when(
            text.rlike(_YEAR_FIRST_OTHER),
            F.coalesce(year_day_month, year_month_day) if strict_dates else year_month_day,
        )
        .when(text.rlike(_COMPACT), _read(text, _COMPACT, "$1-$2-$3"))
        .when(text.rlike(_YEAR_MONTH), F.regexp_replace(text, "[/.]", "-").try_cast("date"))
        .when(text.rlike(_MONTH_YEAR), _read(text, _MONTH_YEAR, "$2-$1"))
    )


def iso_date(c: Column, strict_dates: bool = False, this_year: int = THIS_YEAR) -> Column:
    """Text to date.

    Four characters before the first dash mean year-month-day; other text is read
    day first, and month first only where day first is impossible.  A time of day
    is checked and dropped, and two-digit years fall within fifty years of
    ``this_year``.  Year-first text with other separators is read year-month-day,
    or year-day-month with ``strict_dates``.  The two plain forms take a short path.
    """

    def in_range(d: Column) -> Column:
        return F.when(d.between(F.lit(FIRST_DAY), F.lit(LAST_DAY)), d)

    def other(cell: Column) -> Column:
        def without_time(text: Column) -> Column:
            return F.when(text.contains(":"), F.regexp_replace(text, _TIME, "")).otherwise(text)

        def numbers_only(text: Column) -> Column:
            return F.when(text.rlike("[A-Za-z]{3}"), _without_month_name(text)).otherwise(text)

        day = let(let(strip(cell), without_time), numbers_only)
        return let(let(day, lambda text: _read_any(text, strict_dates, this_year)), in_range)

    return (
        F.when(c.rlike(_PLAIN), c.try_cast("date"))
        .when(c.rlike(_PLAIN_DAY_FIRST), _day_first(c, _PLAIN_DAY_FIRST, "$3"))
        .when(c.isNotNull(), other(c))
    )


def date_or_default(c: Column, default: dt.date | None, strict_dates: bool = False) -> Column:
    """Blank cells take ``default``; text that is no date stays null."""
    return F.when(blank_to_null(c).isNull(), F.lit(default).cast("date")).otherwise(
        iso_date(c, strict_dates)
    )


def open_ended(valid_from: Column, valid_to: Column) -> Column:
    """An end before its start is dropped, leaving the period open."""
    return F.when(~F.coalesce(valid_to < valid_from, F.lit(False)), valid_to)


def quarter_label(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.year(d).cast("string"))
