"""Store of report cells: upsert, full replacement and range read-back.

A store is a folder of versions. A write adds a version, which counts once it is
complete, and never touches an earlier one that is read: so it can read the
store it extends, and a failed or repeated write does no harm. A version holds the
sheets that its write changed, a folder of Parquet files each, and a list
that tells for every sheet of the store in which version it lies. Sheets that a write
does not touch are neither read nor written. The last few versions, and what
they refer to, are kept for readers that have begun. There is one writer at a time:
another one is refused while the first is at work.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrid.operators.cells import compare_cells, merge_cells
from tillgrid.sources.folders import age_of, create_new, exists, literal, names_in, remove_folder

CELL_SCHEMA = (
    T.StructType()
    .add("sheet", T.StringType())
    .add("row_no", T.IntegerType())
    .add("col_no", T.IntegerType())
    .add("a1", T.StringType())
    .add("value", T.StringType())
)


SHEETS_SCHEMA = T.StructType().add("sheet", T.StringType()).add("version", T.IntegerType())

#: Complete versions that stay.
VERSIONS_KEPT = 3
#: Seconds after which an incomplete version is taken for one whose writer has died.
WRITER_SECONDS = 6 * 3600


class StoreBusy(RuntimeError):
    """Another writer is at work on the store."""


def _folder(store: str, version: int, name: str) -> str:
    return f"{store}/version={version}/{name}"


def _versions(spark: SparkSession, store: str) -> dict[int, bool]:
    """Numbers of the version folders, and whether each is complete."""
    numbers = [name.removeprefix("version=") for name in names_in(spark, store)]
    return {
        int(number): exists(spark, f"{_folder(store, int(number), 'sheets')}/_SUCCESS")
        for number in numbers
        if number.isdecimal()
    }


def latest_version(spark: SparkSession, store: str) -> int:
    """Number of the newest complete version, 0 for a store without any."""
    return max((number for number, done in _versions(spark, store).items() if done), default=0)


def complete_versions(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the complete versions that are still there, oldest first."""
    return sorted(number for number, done in _versions(spark, store).items() if done)


def sheets_of(spark: SparkSession, store: str, version: int) -> dict[str | None, int]:
    """Sheets of a complete version, and the version that each lies in; none for version 0.

    A workbook's sheets are few, so their list is read to the driver.
    """
    if not version:
        return {}
    listed = spark.read.schema(SHEETS_SCHEMA).parquet(literal(_folder(store, version, "sheets")))
    return {row.sheet: row.version for row in listed.collect()}


def _cells_of(spark: SparkSession, folder: str, sheets: list[str | None] | None = None) -> DataFrame:
    """Cells written to a folder, of some sheets alone if they are given."""
    kept = T.StructType([*CELL_SCHEMA.fields, T.StructField("sheet_folder", T.StringType())])
    cells = spark.read.schema(kept).parquet(literal(folder))
    if sheets is not None:
        named = F.col("sheet_folder").isin([name for name in sheets if name is not None])
        cells = cells.filter(F.coalesce(named, F.lit(False)) | (F.col("sheet_folder").isNull() & F.lit(None in sheets)))
    return cells.select(*CELL_SCHEMA.names)


def _read(spark: SparkSession, store: str, places: dict[str | None, int]) -> DataFrame:
    """Cells of sheets that lie in the given versions."""
    by_version: dict[int, list[str | None]] = {}
    for sheet, version in places.items():
        by_version.setdefault(version, []).append(sheet)
    parts = [
        _cells_of(spark, _folder(store, version, "cells"), sheets) for version, sheets in sorted(by_version.items())
    ]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], CELL_SCHEMA)


def read_cells(spark: SparkSession, store: str, version: int | None = None) -> DataFrame:
    """Cells of a version, the newest one if none is given; no cells where there is none."""
    if version is None:
        version = latest_version(spark, store)
    return _read(spark, store, sheets_of(spark, store, version))


def changes_of_last_write(spark: SparkSession, store: str) -> DataFrame:
    """What the newest version changed, lost or added; see :func:`compare_cells`."""
    before, after = [0, 0, *complete_versions(spark, store)][-2:]
    return compare_cells(read_cells(spark, store, before), read_cells(spark, store, after))


@contextmanager
def _new_version(spark: SparkSession, store: str) -> Iterator[int]:
    """Number of a version that only this writer writes."""
    versions = _versions(spark, store)
    for number, done in versions.items():
        age = None if done else age_of(spark, _folder(store, number, "_writer"))
        if age is not None and age < WRITER_SECONDS:
            raise StoreBusy(f"version {number} of {store} is being written")
    version = max(versions, default=0) + 1
    mark = _folder(store, version, "_writer")
    if not create_new(spark, mark):
        raise StoreBusy(f"version {version} of {store} is being written")
    try:
        yield version
    finally:
        remove_folder(spark, mark)


def _write(cells: DataFrame, folder: str) -> list[str | None]:
    """Write cells to a folder per sheet; gives the sheets."""
    spark = cells.sparkSession
    typed = cells.select(*[F.col(field.name).cast(field.dataType) for field in CELL_SCHEMA])
    typed.withColumn("sheet_folder", F.col("sheet")).write.mode("errorifexists").partitionBy("sheet_folder").parquet(folder)
    return [row.sheet for row in _cells_of(spark, folder).select("sheet").distinct().collect()]


def _finish(spark: SparkSession, store: str, version: int, places: dict[str | None, int]) -> None:
    """Complete a version by its list of sheets, and remove what no kept version refers to."""
    listed = spark.createDataFrame(list(places.items()), SHEETS_SCHEMA).coalesce(1)
    listed.write.mode("errorifexists").parquet(_folder(store, version, "sheets"))
    kept = complete_versions(spark, store)[-VERSIONS_KEPT:]
    needed = {*kept, *(place for number in kept for place in sheets_of(spark, store, number).values())}
    for number in _versions(spark, store):
        if number < kept[0] and number not in needed:
            remove_folder(spark, f"{store}/version={number}")


def replace_cells(cells: DataFrame, store: str) -> None:
    """Make ``cells`` the whole content of the store; none empty it."""
    spark = cells.sparkSession
    with _new_version(spark, store) as version:
        sheets = _write(cells, _folder(store, version, "cells"))
        _finish(spark, store, version, dict.fromkeys(sheets, version))


def upsert_cells(cells: DataFrame, store: str) -> None:
    """Write ``cells`` over those of the store; other cells stay, other sheets are not touched."""
    spark = cells.sparkSession
    with _new_version(spark, store) as version:
        places = sheets_of(spark, store, latest_version(spark, store))
        new_folder = _folder(store, version, "new")
        sheets = _write(cells, new_folder)
        old = _read(spark, store, {sheet: places[sheet] for sheet in sheets if sheet in places})
        _write(merge_cells(old, _cells_of(spark, new_folder)), _folder(store, version, "cells"))
        _finish(spark, store, version, {**places, **dict.fromkeys(sheets, version)})
        remove_folder(spark, new_folder)


def read_range(
    spark: SparkSession, store: str, sheet: str, rows: tuple[int, int], columns: tuple[int, int]
) -> DataFrame:
    """Stored cells of a rectangle, bounds included; other sheets are not read."""
    places = sheets_of(spark, store, latest_version(spark, store))
    own = {sheet: places[sheet]} if sheet in places else {}
    return _read(spark, store, own).filter(
        F.col("row_no").between(*rows) & F.col("col_no").between(*columns)
    )
