"""Date expressions on a Monday-based week."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def week_start(d: Column) -> Column:
    """Monday of the week of ``d``."""
    return F.date_trunc("week", d).cast("date")


def week_closing_monday(d: Column) -> Column:
    """Monday that closes the Tuesday-to-Monday bin of ``d``; a Monday closes its own bin."""
    return F.next_day(F.date_sub(d, 1), "MON")


def week_closing_sunday(d: Column) -> Column:
    return F.date_add(week_start(d), 6)


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "quarter")


def semester(d: Column) -> Column:
    return F.when(F.month(d) <= 6, 1).otherwise(2)


def semester_start(d: Column) -> Column:
    """First day of the half-year (January or July), not of the month."""
    return F.make_date(F.year(d), F.when(F.month(d) <= 6, F.lit(1)).otherwise(F.lit(7)), F.lit(1))


def plus_weeks(d: Column, weeks: Column | int) -> Column:
    w = F.lit(weeks) if isinstance(weeks, int) else weeks
    return F.date_add(d, (w * 7).cast("int"))


def weeks_between(first: Column, last: Column) -> Column:
    """Whole weeks from ``first`` to ``last``."""
    return F.floor(F.datediff(last, first) / 7).cast("int")
