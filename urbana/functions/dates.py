"""Dates and times as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_years(a: Column, b: Column) -> Column:
    """Difference of the calendar years, not of whole years."""
    return F.year(b) - F.year(a)


def business_offset(day: Column) -> Column:
    """Two working days on: Thursday and Friday add four days, Saturday three, other days two."""
    w = F.weekday(day)
    return F.date_add(day, F.when(w.isin(3, 4), 4).when(w == 5, 3).otherwise(2))


def weekend_shift(day: Column) -> Column:
    """Saturday and Sunday move to Monday."""
    return F.date_add(day, F.when(F.weekday(day) == 5, 2).when(F.weekday(day) == 6, 1).otherwise(0))


def business_days(a: Column, b: Column) -> Column:
    """Days from ``a`` to ``b``, both included, that are not on a weekend; 0 if ``b`` is before ``a``."""
    days = F.filter(F.sequence(F.least(a, b), b), lambda d: F.weekday(d) < 5)
    return F.when(b < a, 0).otherwise(F.size(days))


def month_floor(c: Column) -> Column:
    return F.trunc(c, "month")


def week_start(c: Column) -> Column:
    """The Monday of the week."""
    return F.date_trunc("week", c).cast("date")


def to_local(c: Column, zone: str = "America/Sao_Paulo") -> Column:
    """A UTC time on the clock of a zone."""
    return F.from_utc_timestamp(c.cast("timestamp"), zone)


def parse_any(c: Column, *formats: str) -> Column:
    """The first format that parses."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def whole_hours(a: Column, b: Column) -> Column:
    """Whole hours from ``a`` to ``b``, cut towards zero."""
    return F.timestamp_diff("HOUR", a, b)


def date_from_name(c: Column) -> Column:
    """The date in a file name: ``A`` + yymmdd, else yyyymmdd, else yyyymm (its first day)."""

    def first(pattern: str, form: str, prefix: str = "") -> Column:
        return F.try_to_date(F.nullif(F.concat(F.lit(prefix), F.regexp_extract(c, pattern, 1)), F.lit(prefix)), form)

    return F.coalesce(first(r"A([0-9]{6})(?![0-9])", "yyyyMMdd", "20"), first(r"(?<![0-9])([0-9]{8})(?![0-9])", "yyyyMMdd"), F.trunc(first(r"(?<![0-9])([0-9]{6})(?![0-9])", "yyyyMM"), "month"))
