"""Rows with a day against periods that are a table, without comparing all with all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels of bins: one of level k is 2 to the power of k days wide.
LEVELS = 24


def _number(day: Column) -> Column:
    return F.datediff(day.cast("date"), F.lit("1970-01-01").cast("date"))


def _bin(number: Column, level: Column) -> Column:
    return F.call_function("shiftright", number, level)


def in_periods(rows: DataFrame, day: str, periods: DataFrame, start: str, end: str) -> DataFrame:
    """Every row with each period that its ``day`` lies in, first and last day included.

    A period goes to the bins of the lowest level whose bins are as wide as it is
    long, two at most. A row goes to one bin of every level that some period has. So both
    sides meet by equal level and bin, whatever the number of periods, and
    long periods cost no more than short ones. Rows and periods with a missing day,
    and periods that end before they start, have no partner; periods may overlap and repeat.
    """
    first, last = _number(F.col(start)), _number(F.col(end))
    wide = F.ceil(F.log2((last - first + 1).cast("double"))).cast("int")
    placed = (
        periods.filter(first <= last)
        .withColumn("_level", F.least(F.greatest(wide, F.lit(0)), F.lit(LEVELS)))
        .withColumn("_bin", F.explode(F.sequence(_bin(first, F.col("_level")), _bin(last, F.col("_level")))))
    )
    levels = placed.agg(F.collect_set("_level").alias("levels")).scalar()
    spread = rows.withColumn("_level", F.explode(levels)).withColumn("_bin", _bin(_number(F.col(day)), F.col("_level")))
    inside = _number(F.col(day)).between(first, last)
    return spread.join(placed, ["_level", "_bin"]).filter(inside).drop("_level", "_bin")
