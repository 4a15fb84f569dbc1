"""Partial dates, calendar parts and day arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed


def extract_month_day(x: Column | str, tag: str) -> Column:
    """``Mon D`` fragment of a text that carries the tag (``ATD:``, ...)."""
    text = F.col(x) if isinstance(x, str) else x
    return F.when(text.contains(tag), F.regexp_substr(text, F.lit(fixed.MONTH_DAY_PATTERN)))


def try_month_day(month_day: Column, year: Column) -> Column:
    """Date of ``Mon D`` in the year, NULL when there is no such day."""
    text = F.regexp_replace(month_day, r"\s+", " ")
    return F.try_to_date(F.concat(text, F.lit(" "), year.cast("string")), "MMM d yyyy")


def resolve_past_date(month_day: Column, base_year: Column, reported: Column | None = None) -> Column:
    """Day in the base year, or the year before only where that does not exist.

    With ``reported`` given, a day after the report also moves back a year
    (the strict reading; the default keeps such future days).
    """
    this_year = try_month_day(month_day, base_year)
    last_year = try_month_day(month_day, base_year - 1)
    if reported is None:
        return F.coalesce(this_year, last_year)
    return F.coalesce(F.when(this_year <= F.to_date(reported), this_year), last_year)


def resolve_eta(month_day: Column, base_year: Column, reported: Column) -> Column:
    """Day in the base year unless more than a day before the report, else next year."""
    this_year = try_month_day(month_day, base_year)
    near = this_year >= F.date_sub(F.to_date(reported), 1)
    return F.coalesce(F.when(near, this_year), try_month_day(month_day, base_year + 1))


def date_sk(d: Column | str) -> Column:
    """Calendar key as a YYYYMMDD integer."""
    day = F.col(d) if isinstance(d, str) else d
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def days_between(start: Column, end: Column) -> Column:
    """Calendar-day boundaries crossed from start to end."""
    return F.datediff(F.to_date(end), F.to_date(start))


def stamp(as_of: str) -> Column:
    """A literal run time; replaces the wall clock so runs can be repeated."""
    return F.lit(as_of).cast("timestamp")
