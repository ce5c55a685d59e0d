"""Advertising figures: typed from the raw sheet, summed by week and month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrid.functions.periods import week_starts

# What a filled cell looks like, and the steps of cleaning one.
NOT_BLANK = r"(?U)\S"
AS_TEXT = "coalesce({cell}, '')"
WITHOUT_ERROR = "if(upper({cell}) = '#VALUE!' or {cell} = '#VALUE', '0', {cell})"
WITHOUT_SIGNS = "translate({cell}, ',%', '')"
AS_NUMBER = r"""coalesce(
    if({cell} rlike r'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$',
      try_cast({cell} as double), null),
    0D)"""


def ads_clean(grid: DataFrame) -> DataFrame:
    """``date`` text and numeric columns from a grid of strings.

    Blank rows go, error cells and empty cells become 0, separators and percent
    signs are dropped, and what still is no number becomes 0.
    """
    metrics = [name for name in grid.columns if name != "date"]

    def each(step: str, names: list[str]) -> list[str]:
        return [step.format(cell=f"`{name}`") + f" as `{name}`" for name in names]

    return (
        grid.selectExpr(*each(AS_TEXT, grid.columns))
        .filter(F.concat(*grid.columns).rlike(NOT_BLANK))
        .selectExpr(*each(WITHOUT_ERROR, ["date", *metrics]))
        .selectExpr("date", *each(WITHOUT_SIGNS, metrics))
        .selectExpr("date", *each(AS_NUMBER, metrics))
    )


def _figures(ads: DataFrame, *by: str) -> DataFrame:
    return ads.groupBy(*by).agg(
        F.sum("total_signups").cast("bigint").alias("signups"),
        F.sum("total_cost").cast("bigint").alias("cost"),
        F.sum("total_conversions").cast("bigint").alias("conversions"),
        F.avg("total_roas").cast("bigint").alias("avg_roas"),
    )


def ads_weekly(ads: DataFrame, first_monday: str, weeks: int) -> DataFrame:
    """Sums and unweighted mean ROAS by calendar week, cut to integers.

    Dates stay texts: a row is in the weeks between whose first and last day its
    date sorts. So a time after the date is fine on all days but the last, which
    it would sort behind, and ``2025-02-3`` is in the week that ``2025-02-30`` would
    be in.
    """
    calendar = F.array(
        *[
            F.struct(F.lit(week).alias("week"), F.lit(start).alias("start"), F.lit(end).alias("end"))
            for week, start, end in week_starts(first_monday, weeks)
        ]
    )
    fits = F.filter(
        calendar, lambda week: (week["start"] <= F.col("date")) & (F.col("date") <= week["end"])
    )
    in_week = ads.withColumn("period", F.explode(F.transform(fits, lambda week: week["week"])))
    return _figures(in_week, "period")


def ads_monthly(ads: DataFrame, year: int, last_month: int) -> DataFrame:
    """The same by month of one year; a text that is no date fails the job.

    Texts that are no dates form a group of their own and fail when the result
    is read. A failing cast would run on rows that a filter further down removes.
    """
    day = F.col("date").try_cast("date")
    in_year = (F.year(day) == year) & (F.month(day) <= last_month)
    unreadable = day.isNull() & (F.trim("date") != "")
    months = _figures(
        ads.filter(in_year | unreadable).withColumn("period", F.month(day)), "period"
    )
    failure = F.raise_error(F.lit("the advertising table holds a text that is no date"))
    return months.withColumn("period", F.coalesce(F.col("period"), failure))
