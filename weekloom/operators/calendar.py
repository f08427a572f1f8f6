"""Daily and weekly calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weekloom.functions import dates as D

WEEKDAY_CODES = ["MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN"]


def daily_calendar(dates: DataFrame, column: str = "date") -> DataFrame:
    """One row per day from the Monday of the first date through the last date.

    ``semester_date`` is the true half-year start.
    """
    span = dates.agg(D.week_start(F.min(column)).alias("lo"), F.max(column).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    d = F.col("date")
    return days.select(
        "date",
        F.year(d).alias("year"),
        D.semester(d).alias("semester"),
        D.semester_start(d).alias("semester_date"),
        F.concat(F.lit("H"), D.semester(d)).alias("semester_name"),
        F.quarter(d).alias("quarter"),
        D.quarter_start(d).alias("quarter_date"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("quarter_name"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        D.month_start(d).alias("month_date"),
        F.day(d).alias("day"),
        F.weekofyear(d).alias("week"),
        D.week_start(d).alias("week_date"),
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
    )


def weekly_calendar(daily: DataFrame) -> DataFrame:
    """One row per week with the attributes of its first day; day-level columns are dropped.

    The last week ends at the last calendar day, so it may be short.
    """
    kept = [c for c in daily.columns if "day" not in c and c not in ("date", "week_date")]
    out = daily.groupBy("week_date").agg(
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        *[F.min_by(c, "date").alias(c) for c in kept],
    )
    head = ["week_date", "week", "start_date", "end_date"]
    return out.select(*head, *[c for c in out.columns if c not in head])


def anchor_weekday(panel: DataFrame, date: str = "ds") -> DataFrame:
    """The most frequent weekday (lowest on ties) as one row ``(weekday, freq)`` such as ``W-MON``."""
    codes = F.array(*[F.lit(f"W-{c}") for c in WEEKDAY_CODES])
    return panel.agg(F.mode(F.weekday(date), True).alias("weekday")).select(
        "weekday", F.element_at(codes, F.col("weekday") + 1).alias("freq")
    )
