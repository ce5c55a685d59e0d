"""The raw advertising sheet, exported as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillgrid.sources.folders import literal, names_in

# The sheet's channels and the metrics of each.
CHANNELS = [
    "total",
    "powerlink",
    "brandsearch",
    "gfa",
    "meta",
    "google_keyword",
    "google_da",
    "criteo",
    "daangn",
    "mobion",
]
METRICS = [
    "impressions",
    "clicks",
    "ctr",
    "cost",
    "cpc",
    "conversions",
    "revenue",
    "signups",
    "roas",
]

# Rows above the data, and what is in the names of raw files.
HEADER_ROWS = 3
RAW_NAME = "raw"

#: Positions of lines that are numbered together.
BLOCK_LINES = 10_000


def ad_columns() -> list[str]:
    """``date`` and one column per channel and metric; ``total`` adds ``cpa``."""
    columns = ["date"]
    for channel in CHANNELS:
        for metric in METRICS:
            if channel == "total" and metric == "roas":
                columns.append("total_cpa")
            columns.append(f"{channel}_{metric}")
    return columns


def raw_sheet(spark: SparkSession, folder: str) -> str:
    """Path of the first file of ``folder``, by name, that is a raw sheet."""
    raw = [name for name in names_in(spark, folder) if RAW_NAME in name.lower() and name[0] not in "._"]
    if not raw:
        raise FileNotFoundError(f"no raw sheet in {folder}")
    return f"{folder}/{raw[0]}"


def read_ad_grid(spark: SparkSession, *files: str) -> DataFrame:
    """Data rows of raw sheet files, every cell a string; see :func:`grid_of_lines`.

    A file is read whole, since its cells may hold line breaks; the size of a
    spreadsheet bounds it.
    """
    sheets = spark.read.text([literal(file) for file in files], wholetext=True)
    lines = F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("position", "line")
    return grid_of_lines(sheets.select(F.col("_metadata.file_path").alias("file"), lines))


def numbered_rows(lines: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Lines with the number of the ``row`` they belong to, from 1 on in each file.

    A line begins a row where the quotes before it are even in number. Lines are numbered
    within blocks of positions, once for an even and once for an odd number of
    quotes before the block. The totals of the blocks, one row each, tell which of
    the two holds and how many rows come before. A file whose quotes are odd in
    number would be one long row from the stray quote on; it raises an error.
    """
    odd = (F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))) % 2
    in_block = Window.partitionBy("file", "block").orderBy("position")
    up_to_here = in_block.rowsBetween(Window.unboundedPreceding, 0)
    before = F.coalesce(F.sum("odd").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    placed = (
        lines.withColumns({"block": F.floor(F.col("position") / block_lines), "odd": odd})
        .withColumn("before", before)
        .withColumns({
            "rows_if_even": F.sum(1 - F.col("before")).over(up_to_here),
            "rows_if_odd": F.sum("before").over(up_to_here),
        })
    )
    totals = placed.groupBy("file", "block").agg(
        F.sum("odd").alias("quotes"), F.max("rows_if_even").alias("if_even"), F.max("rows_if_odd").alias("if_odd")
    )
    blocks_before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("starts_odd"), F.col("if_odd")).otherwise(F.col("if_even"))
    offsets = (
        totals.withColumn("starts_odd", F.coalesce(F.sum("quotes").over(blocks_before), F.lit(0)) % 2 == 1)
        .withColumn("rows_before", F.coalesce(F.sum(own).over(blocks_before), F.lit(0)))
        .withColumn("stray", F.sum("quotes").over(Window.partitionBy("file")) % 2 == 1)
        .select("file", "block", "starts_odd", "rows_before", "stray")
    )
    row = F.col("rows_before") + F.when(F.col("starts_odd"), F.col("rows_if_odd")).otherwise(F.col("rows_if_even"))
    message = F.concat(F.lit("a quote without its partner in "), F.col("file"))
    return placed.join(offsets, ["file", "block"]).select(
        "file", "position", "line", F.when(F.col("stray"), F.raise_error(message).cast("long")).otherwise(row).alias("row")
    )


def grid_of_lines(lines: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Data rows of sheets given as ``file``, ``position`` and ``line`` of their text.

    Lines are joined to rows where a quoted cell goes on over a line break. The
    rows above the data are skipped per file, empty ones counted. Short rows are
    filled with NULL and long rows cut; empty lines of the data are no rows.
    """
    numbered = numbered_rows(lines, block_lines)
    parts = F.sort_array(F.collect_list(F.struct("position", "line")))
    rows = (
        numbered.filter(F.col("row") > HEADER_ROWS)
        .groupBy("file", "row")
        .agg(F.array_join(F.transform(parts, lambda part: part["line"]), "\n").alias("text"))
        .filter(F.col("text") != "")
    )
    schema = ", ".join(f"{name} string" for name in ad_columns())
    cells = F.from_csv("text", schema, {"mode": "PERMISSIVE", "escape": '"', "multiLine": "true"})
    return rows.select(cells.alias("cells")).select("cells.*")
