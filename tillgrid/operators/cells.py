"""Report cells: measures placed on a sheet, merged and read back.

A cell is ``sheet, row_no, col_no, a1, value`` with the value as text.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.functions.a1 import address

CELL_COLUMNS = ["sheet", "row_no", "col_no", "a1", "value"]


def measures_long(df: DataFrame, measures: Sequence[str], block: str | Column) -> DataFrame:
    """``block, measure, period, value``: one row per measure and period.

    ``block`` names the part of the sheet, the same for all rows or a column.
    Numbers are cut to integers, texts stay; a missing value is 0.
    """

    def as_text(name: str) -> Column:
        kind = df.schema[name].dataType.typeName()
        value = F.col(name)
        if kind in ("double", "float", "decimal"):
            value = value.cast("bigint")
        return F.coalesce(value.cast("string"), F.lit("0")).alias(name)

    block_column = F.lit(block) if isinstance(block, str) else block
    return df.select(
        block_column.alias("block"),
        F.col("period").cast("int").alias("period"),
        *[as_text(name) for name in measures],
    ).unpivot(["block", "period"], list(measures), "measure", "value")


def earliest_year(df: DataFrame, *block: str) -> DataFrame:
    """One row per period and block: that of the earliest year.

    A period number that occurs in two years would fill the same cell twice.
    """
    rest = [name for name in df.columns if name not in ("period", "entering_year", *block)]
    return (
        df.groupBy("period", *block)
        .agg(F.min(F.struct("entering_year", *rest)).alias("first"))
        .select("period", *block, *[F.col(f"first.{name}").alias(name) for name in rest])
    )


def layout_table(
    spark: SparkSession, rows: Iterable[tuple[str, str, str, int, int]]
) -> DataFrame:
    """``sheet, block, measure, row_no, offset`` of a fixed list of places.

    The column of a period is ``period + offset``.
    """
    kinds = "array<struct<sheet string, block string, measure string, row_no int, offset int>>"
    names = ["sheet", "block", "measure", "row_no", "offset"]
    places = json.dumps([dict(zip(names, row)) for row in rows], ensure_ascii=False)
    return spark.range(1).select(F.inline(F.from_json(F.lit(places), kinds)))


def place_cells(
    measures: DataFrame, layout: DataFrame, first_period: int, last_period: int
) -> DataFrame:
    """Cells of the measures that have a place, for the emitted periods.

    The layout is a list written in code, so broadcasting it is safe.
    """
    column = F.col("period") + F.col("offset")
    return (
        measures.filter(F.col("period").between(first_period, last_period))
        .join(F.broadcast(layout), ["block", "measure"])
        .withColumn("col_no", column)
        .select(
            "sheet",
            "row_no",
            "col_no",
            address(F.col("row_no"), F.col("col_no")).alias("a1"),
            "value",
        )
    )


def merge_cells(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old cells overwritten by new ones at the same sheet, row and column.

    The maximum per cell combines before the shuffle. Two new values for one
    cell are settled by the greater text, so merging twice changes nothing.
    """
    both = old.select(*CELL_COLUMNS, F.lit(0).alias("age")).unionByName(
        new.select(*CELL_COLUMNS, F.lit(1).alias("age"))
    )
    return (
        both.groupBy("sheet", "row_no", "col_no")
        .agg(F.max(F.struct("age", "value", "a1")).alias("kept"))
        .select("sheet", "row_no", "col_no", "kept.a1", "kept.value")
    )


def compare_cells(before: DataFrame, after: DataFrame) -> DataFrame:
    """Cells that two reports do not share: ``sheet, row_no, col_no, change, before, after``.

    ``change`` is ``extra`` for a cell of ``after`` alone, ``lost`` for one of
    ``before`` alone, and ``changed`` where the values differ, a missing value
    being a value like any other. Both sides have a cell at most once.
    """
    place = ["sheet", "row_no", "col_no"]

    def side(cells: DataFrame, name: str) -> DataFrame:
        return cells.select(*[F.col(key).alias(f"{name}_{key}") for key in place], F.col("value").alias(name))

    same_place = [F.col(f"before_{key}").eqNullSafe(F.col(f"after_{key}")) for key in place]
    both = side(before, "before").withColumn("was", F.lit(True)).join(
        side(after, "after").withColumn("is", F.lit(True)), same_place, "full"
    )
    change = (
        F.when(F.col("was").isNull(), "extra")
        .when(F.col("is").isNull(), "lost")
        .when(~F.col("before").eqNullSafe(F.col("after")), "changed")
    )
    return both.withColumn("change", change).filter(F.col("change").isNotNull()).select(
        *[F.when(F.col("is").isNull(), F.col(f"before_{key}")).otherwise(F.col(f"after_{key}")).alias(key) for key in place],
        "change",
        "before",
        "after",
    )


def verify_points(cells: DataFrame, sheet: str, rows: dict[str, int]) -> DataFrame:
    """Point shares read back per column, and the new-member check sum.

    ``rows`` maps ``first_order``, ``joined`` and ``referral`` to their rows.
    Missing or empty cells count as 0; the check sum adds the first two.
    """
    share = F.coalesce(F.col("value").try_cast("decimal(20,2)"), F.lit(0))
    read = {
        name: F.sum(F.when(F.col("row_no") == row, share).otherwise(0)).cast("decimal(20,2)")
        for name, row in rows.items()
    }
    return (
        cells.filter((F.col("sheet") == sheet) & F.col("row_no").isin(list(rows.values())))
        .groupBy("sheet", "col_no")
        .agg(*[column.alias(name) for name, column in read.items()])
        .withColumn("check_sum", F.col("first_order") + F.col("joined"))
    )
