"""Spreadsheet addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column_letter(number: Column) -> Column:
    """A..Z, AA..ZZ for columns 1..702, NULL below; a larger number fails the job."""
    lead = F.floor((number - 1) / 26).cast("int")
    last = F.char(65 + (number - 1) % 26)
    letters = F.concat(F.when(lead > 0, F.char(64 + lead)).otherwise(""), last)
    outside = F.raise_error(F.concat(F.lit("no letters for column "), number.cast("string")))
    return F.when(number.between(1, 702), letters).when(number > 702, outside)


def address(row: Column, column: Column) -> Column:
    """A1 notation of a cell."""
    return F.concat(column_letter(column), row.cast("string"))
