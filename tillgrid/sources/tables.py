"""Input tables: declared schemas, Parquet and JDBC readers.

Money columns are declared as whole currency units. The operators look at the
actual type, so a table that holds decimals works without a change.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMAS: dict[str, T.StructType] = {
    "user_account": T.StructType()
    .add("base_user_id", T.LongType())
    .add("created_at", T.TimestampType())
    .add("recommender_username", T.StringType())
    .add("deleted_yn", T.StringType())
    .add("company_name", T.StringType()),
    "base_user": T.StructType().add("id", T.LongType()),
    "dashboard_user": T.StructType()
    .add("period_date", T.StringType())
    .add("period_type", T.StringType())
    .add("new_count", T.LongType())
    .add("ok_total_count", T.LongType())
    .add("ok_direct_count", T.LongType())
    .add("ok_parcel_count", T.LongType()),
    "direct_shipping": T.StructType()
    .add("created_at", T.TimestampType())
    .add("is_deleted", T.IntegerType()),
    "point": T.StructType()
    .add("user_id", T.LongType())
    .add("event_type", T.StringType())
    .add("reason_type", T.StringType())
    .add("amount", T.LongType())
    .add("created_at", T.TimestampType()),
    "shipment": T.StructType()
    .add("id", T.LongType())
    .add("user_id", T.LongType())
    .add("order_number", T.StringType())
    .add("status", T.StringType())
    .add("courier", T.StringType())
    .add("order_dated_at", T.TimestampType())
    .add("delivery_price", T.LongType()),
    "shipment_item": T.StructType()
    .add("shipment_id", T.LongType())
    .add("item_status", T.StringType())
    .add("tax_type", T.StringType())
    .add("price", T.LongType())
    .add("list_price", T.LongType())
    .add("quantity", T.LongType())
    .add("supply_price", T.LongType())
    .add("coupon_discount_amount", T.LongType())
    .add("use_point", T.LongType())
    .add("is_deleted", T.IntegerType())
    .add("entering_dated_at", T.TimestampType()),
    "user_business_type_code": T.StructType()
    .add("base_user_id", T.LongType())
    .add("business_type_codes", T.LongType()),
    "business_type": T.StructType().add("id", T.LongType()).add("name", T.StringType()),
}


def read_parquet_tables(
    spark: SparkSession, folder: str, names: Iterable[str] = tuple(SCHEMAS)
) -> dict[str, DataFrame]:
    """``folder/<table>`` for each table, with the declared schema."""
    return {name: spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}") for name in names}


def jdbc_options(
    url: str,
    table: str,
    connection: dict[str, str],
    partition_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    one_task: bool = False,
) -> dict[str, str]:
    """Options of a JDBC read; with a partition column the read is split.

    The bounds only place the splits, they filter nothing. ``connection`` holds
    user, password and driver as the caller got them. A table that is small
    enough for one task has to be named so by ``one_task``.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **connection}
    split = [partition_column, lower, upper, partitions]
    if one_task == any(part is not None for part in split):
        raise ValueError("a JDBC read needs either a split or one_task=True")
    if any(part is not None for part in split):
        if any(part is None for part in split):
            raise ValueError("a split JDBC read needs column, lower, upper and partitions")
        options["partitionColumn"] = partition_column
        options["lowerBound"] = str(lower)
        options["upperBound"] = str(upper)
        options["numPartitions"] = str(partitions)
    return options


def as_declared(df: DataFrame, table: str) -> DataFrame:
    """Declared columns of ``table`` in their declared types; money keeps its own.

    Drivers hand over flags as booleans and dates as they see fit.
    """
    kept = (T.DecimalType, T.FloatType, T.DoubleType)

    def typed(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.LongType) and isinstance(df.schema[field.name].dataType, kept):
            return column
        return column.cast(field.dataType).alias(field.name)

    return df.select(*[typed(field) for field in SCHEMAS[table]])


def read_jdbc_table(spark: SparkSession, table: str, **kwargs) -> DataFrame:
    """Table of a database as declared; see :func:`jdbc_options` for the arguments."""
    read = spark.read.format("jdbc").options(**jdbc_options(table=table, **kwargs)).load()
    return as_declared(read, table) if table in SCHEMAS else read
