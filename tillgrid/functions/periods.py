"""Calendar expressions: days, week and month numbers, date ranges.

All of them are built-in expressions, so they stay inside generated code and
range filters reach the file scan.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WEEK = "week"
MONTH = "month"

# Sorts after every character a longer date string can continue with.
_AFTER_ANY_TEXT = "\U0010ffff"


def calendar_day(df: DataFrame, name: str) -> Column:
    """Day of a string, date or timestamp column; unreadable text gives NULL."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).substr(1, 10).try_cast("date")
    return F.col(name).cast("date")


def between_days(df: DataFrame, name: str, first_day: str, last_day: str) -> Column:
    """Both days included. Compares the raw column, so the scan can prune on it."""
    column, dtype = F.col(name), df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return (column >= first_day) & (column <= last_day + _AFTER_ANY_TEXT)
    if isinstance(dtype, T.DateType):
        return column.between(F.lit(first_day).cast(dtype), F.lit(last_day).cast(dtype))
    day_after = (date.fromisoformat(last_day) + timedelta(days=1)).isoformat()
    return (column >= F.lit(first_day).cast(dtype)) & (column < F.lit(day_after).cast(dtype))


def in_year(df: DataFrame, name: str, year: int) -> Column:
    return between_days(df, name, f"{year}-01-01", f"{year}-12-31")


def week_mode1(day: Column) -> Column:
    """Week 0-53, Monday start; week 1 is the first with four or more days.

    Days before week 1 are week 0 and the last days of December can be week 53,
    unlike the ISO week of ``weekofyear``, which borrows from the other year.
    """
    days_before = F.dayofyear(day) - 1
    new_year = F.pmod(F.weekday(day) - days_before, F.lit(7))
    full_weeks = F.call_function("div", days_before + new_year, F.lit(7)).cast("int")
    return full_weeks + F.when(new_year <= 3, 1).otherwise(0)


def period_of(day: Column, grain: str) -> Column:
    """Number of the week or month a day falls in."""
    if grain == WEEK:
        return week_mode1(day)
    if grain == MONTH:
        return F.month(day)
    raise ValueError(f"unknown grain {grain!r}, expected {WEEK!r} or {MONTH!r}")


def week_starts(first_monday: str, weeks: int) -> list[tuple[int, str, str]]:
    """(week, first day, last day) of consecutive weeks from a start date."""
    start = date.fromisoformat(first_monday)
    rows = []
    for number in range(1, weeks + 1):
        monday = start + timedelta(weeks=number - 1)
        rows.append((number, monday.isoformat(), (monday + timedelta(days=6)).isoformat()))
    return rows


def week_calendar(spark: SparkSession, first_monday: str, weeks: int) -> DataFrame:
    """One row per week: ``week, week_start, week_end``."""
    offset = ((F.col("week") - 1) * 7).cast("int")
    start = F.date_add(F.lit(first_monday).cast("date"), offset)
    return (
        spark.range(1, weeks + 1)
        .select(F.col("id").cast("int").alias("week"))
        .select("week", start.alias("week_start"), F.date_add(start, 6).alias("week_end"))
    )


def calendar_days(spark: SparkSession, first_monday: str, weeks: int) -> DataFrame:
    """The week calendar with one row per day, for equi joins on the day."""
    days = F.sequence("week_start", "week_end")
    return week_calendar(spark, first_monday, weeks).select("*", F.explode(days).alias("day"))
