"""Registered queries: each report over the demo tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.functions import codes
from tillgrid.functions.money import vat_net
from tillgrid.functions.periods import calendar_days, week_mode1
from tillgrid.operators import baskets, cells, members, points
from tillgrid.operators import buyers as buyer_operators
from tillgrid.operators.ads import ads_clean as clean_ads
from tillgrid.operators.intervals import in_periods
from tillgrid.operators.shipments import daily_rollup, order_facts_of_grains
from tillgrid.plans import dashboard, layouts
from tillgrid.plans.dashboard import Settings, monthly_settings, weekly_settings
from tillgrid.plans.demo_tables import DemoTables, given_table
from tillgrid.sources import cell_store
from tillgrid.sources.ad_grid import ad_columns, grid_of_lines
from tillgrid.sources.folders import kept, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

# What the demo tables cover: orders from 1995, events in January 2024.
DEMO = {
    "signup_year": 1995,
    "request_year": 2024,
    "ad_year": 2024,
    "point_year": 2024,
    "point_first_period": 1,
    "categories": tuple(f"NATION_{number}" for number in range(25)),
}
WEEKLY = weekly_settings(
    1996, "1996-08-08", first_monday="2024-01-01", point_periods=range(1, 6), **DEMO
)
MONTHLY = monthly_settings(1996, "1996-08-08", point_periods=range(1, 3), **DEMO)
GRAINS = {"weekly": WEEKLY, "monthly": MONTHLY}


def _signups(tables: DemoTables, at: Settings) -> DataFrame:
    return members.signups(
        tables["user_account"], at.grain, at.signup_year, at.last_period, at.strict_referral
    )


def _new_members(tables: DemoTables, at: Settings) -> DataFrame:
    return members.new_members(
        tables["dashboard_user"], at.grain, at.snapshot_year, at.last_period
    )


def _requests(tables: DemoTables, at: Settings) -> DataFrame:
    return members.requests(tables["direct_shipping"], at.grain, at.request_year, at.last_period)


def _snapshot(tables: DemoTables, at: Settings) -> DataFrame:
    return members.member_snapshot(
        tables["dashboard_user"], at.grain, at.snapshot_year, at.last_period
    )


def _growth(tables: DemoTables, at: Settings) -> DataFrame:
    return members.member_growth(_snapshot(tables, at))


def _share_as_double(shares: DataFrame) -> DataFrame:
    return shares.withColumn("share", F.col("share").cast("double"))


def _point_share(tables: DemoTables, at: Settings) -> DataFrame:
    return _share_as_double(dashboard.point_shares(tables, at))


def _point_share_filled(tables: DemoTables, at: Settings) -> DataFrame:
    return _share_as_double(points.point_share_filled(dashboard.point_shares(tables, at)))


def _sales_by_delivery(tables: DemoTables, at: Settings) -> DataFrame:
    return dashboard.delivery_sales(tables, at, dashboard.rollup_of(tables, at))


def _sales_by_category(tables: DemoTables, at: Settings) -> DataFrame:
    return dashboard.category_sales(tables, at, dashboard.rollup_of(tables, at))


def _sales_total(tables: DemoTables, at: Settings) -> DataFrame:
    return dashboard.total_sales(tables, at, dashboard.rollup_of(tables, at))


def _periods_as_text(bands: DataFrame) -> DataFrame:
    """Numbers with NULLs among them as text, which every client reads alike."""
    return bands.withColumns(
        {name: F.col(name).cast("string") for name in ("entering_year", "period")}
    )


def _basket_bands(tables: DemoTables, at: Settings) -> DataFrame:
    in_baskets = dashboard.basket_rows(tables, at, dashboard.rollup_of(tables, at))
    return _periods_as_text(baskets.basket_bands(in_baskets))


def _basket_bands_total(tables: DemoTables, at: Settings) -> DataFrame:
    rollup = dashboard.rollup_of(tables, at)
    in_baskets = dashboard.basket_rows(tables, at, rollup, by_delivery=False)
    return _periods_as_text(baskets.basket_bands_total(in_baskets))


def _report_cells(tables: DemoTables, at: Settings) -> DataFrame:
    return dashboard.report_cells(tables, at, dashboard.facts_of(tables, at))


def _report_cells_category(tables: DemoTables, at: Settings) -> DataFrame:
    return dashboard.report_cells_category(tables, at, dashboard.facts_of(tables, at))


def _with_first_orders(tables: DemoTables) -> DemoTables:
    tables[dashboard.FIRST_ORDERS] = kept(
        buyer_operators.first_valid_orders(tables["shipment"]), dashboard.FIRST_ORDERS
    )
    return tables


def _stored_report_cells(tables: DemoTables, at: Settings) -> DataFrame:
    facts = kept(dashboard.facts_of(tables, at), "facts")
    return dashboard.report_cells(_with_first_orders(tables), at, facts)


def report_cells_grains(spark: SparkSession, folder: str) -> DataFrame:
    """Sales cells of both grains, the categories included, from one reading of the items."""
    tables = DemoTables(spark, folder)
    orders = dashboard.orders_in_range(tables, WEEKLY)
    facts = kept(order_facts_of_grains(daily_rollup(tables["shipment_item"]), orders), "facts")
    tables = _with_first_orders(tables)
    parts = []
    for at in GRAINS.values():
        own = facts.filter(F.col("grain") == at.grain).drop("grain")
        parts.append(dashboard.sales_cells(tables, at, own))
        parts.append(dashboard.report_cells_category(tables, at, own))
    return reduce(DataFrame.unionByName, parts)


def _verify(tables: DemoTables, at: Settings) -> DataFrame:
    """Point shares read back from a store that they were written to."""
    store = scratch_folder(tables.spark, "cells")
    cell_store.upsert_cells(dashboard.point_cells(tables, at), store)
    checked = dashboard.check_points(tables.spark, at, store)
    shares = [*layouts.POINT_ROWS, "check_sum"]
    return checked.select(
        "sheet", "col_no", *[F.col(name).cast("double").alias(name) for name in shares]
    )


BY_GRAIN: dict[str, Callable[[DemoTables, Settings], DataFrame]] = {
    "signups": _signups,
    "new_members": _new_members,
    "requests": _requests,
    "member_snapshot": _snapshot,
    "member_growth": _growth,
    "point_share": _point_share,
    "point_share_filled": _point_share_filled,
    "sales_by_delivery": _sales_by_delivery,
    "sales_by_category": _sales_by_category,
    "sales_total": _sales_total,
    "basket_bands": _basket_bands,
    "basket_bands_total": _basket_bands_total,
    "report_cells": _stored_report_cells,
    "report_cells_category": _report_cells_category,
    "report_verify": _verify,
    "ads": dashboard.ad_figures,
}


def week_mode1_days(spark: SparkSession, folder: str) -> DataFrame:
    """Week number of every ship date, with the lines shipped that day."""
    day = F.col("l_shipdate").cast("date")
    return (
        given_table(spark, folder, "lineitem")
        .groupBy(day.alias("day"))
        .agg(F.count("*").alias("lines"))
        .select(F.col("day").cast("string").alias("day"), week_mode1(F.col("day")).alias("week"),
                "lines")
    )


def week_calendar_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events per calendar week, weeks without any included."""
    daily = (
        given_table(spark, folder, "events")
        .groupBy(F.col("ts").cast("date").alias("day"))
        .agg(F.count("*").alias("events"))
    )
    return (
        calendar_days(spark, WEEKLY.ad_first_monday, WEEKLY.last_period)
        .join(daily, "day", "left")
        .groupBy("week", "week_start", "week_end")
        .agg(F.coalesce(F.sum("events"), F.lit(0)).alias("events"))
        .select("week", F.col("week_start").cast("string").alias("week_start"),
                F.col("week_end").cast("string").alias("week_end"), "events")
    )


def status_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per label of the four code lists."""
    tables = DemoTables(spark, folder)
    lists = [
        ("shipment", "status", codes.SHIPMENT_STATUS, codes.SHIPMENT_STATUS_OTHER),
        ("shipment_item", "item_status", codes.ITEM_STATUS, codes.ITEM_STATUS_OTHER),
        ("point", "event_type", codes.POINT_EVENT, codes.POINT_EVENT_OTHER),
        ("point", "reason_type", codes.POINT_REASON, codes.POINT_REASON_OTHER),
    ]
    result = None
    for table, column, labels, other in lists:
        counted = (
            tables[table]
            .groupBy(codes.label(F.col(column), labels, other).alias("label"))
            .agg(F.count("*").alias("rows"))
            .select(F.lit(column).alias("code_list"), "label", "rows")
        )
        result = counted if result is None else result.unionByName(counted)
    return result


def vat_net_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Net of VAT of every line price, as cents and as whole units."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    by_price = (
        given_table(spark, folder, "lineitem")
        .groupBy(cents.alias("cents"))
        .agg(F.count("*").alias("lines"))
    )
    price = (F.col("cents").cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    units = F.floor(price).cast("bigint")
    return by_price.select(
        "cents",
        "lines",
        vat_net(price, whole=False).alias("net_of_cents"),
        vat_net(units, whole=True).alias("net_of_units"),
        vat_net(-units, whole=True).alias("net_of_refund"),
    )


def first_order(spark: SparkSession, folder: str) -> DataFrame:
    """First-order flag of every shipment."""
    return buyer_operators.first_order(DemoTables(spark, folder)["shipment"])


def first_orders_updated(spark: SparkSession, folder: str) -> DataFrame:
    """First valid order of each user, kept up to date over a change of the shipments.

    Stored are those of the shipments before 1997. Then every eleventh of these is
    cancelled, and the later shipments come in.
    """
    shipments = DemoTables(spark, folder)["shipment"]
    early = F.col("order_dated_at") < F.lit("1997-01-01").cast("timestamp")
    cancelled = early & (F.col("id") % 11 == 0)
    now = shipments.withColumn("status", F.when(cancelled, F.lit("CANCEL")).otherwise(F.col("status")))
    stored = kept(buyer_operators.first_valid_orders(shipments.filter(early)), "first_orders")
    return buyer_operators.updated_first_orders(
        stored, shipments.filter(cancelled), now.filter(~early | cancelled), now
    ).select("user_id", F.date_format("first_valid_at", "yyyy-MM-dd").alias("first_valid_at"), "valid_orders")


def lines_in_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Lines shipped within a period of its own of each order, from its day up to 120 days on."""
    orders, lines = (given_table(spark, folder, name) for name in ("orders", "lineitem"))
    start = F.col("o_orderdate").cast("date")
    periods = orders.select(
        F.col("o_orderkey").alias("period_id"), start.alias("first_day"),
        F.date_add(start, (F.col("o_custkey") % 121).cast("int")).alias("last_day"),
    )
    daily = lines.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(F.count("*").alias("lines"))
    return (
        in_periods(daily, "day", periods, "first_day", "last_day")
        .groupBy("period_id")
        .agg(F.sum("lines").alias("lines"), F.count("*").alias("days"))
    )


def ads_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Typed advertising table."""
    return DemoTables(spark, folder)["ads"]


#: Sheet columns shown, and columns of a short row.
SHEET_COLUMNS = ["total_impressions", "total_signups", "total_cost", "total_conversions", "total_roas",
                 "gfa_clicks", "mobion_roas"]
SHORT_ROW = 60


def ads_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Advertising figures by way of the raw sheet: its text lines, 92 columns each.

    Three header rows, one of them empty; blank rows; rows that are cut short
    every fifth day; a cell with a line break on odd days.
    """
    raw = DemoTables(spark, folder)["ad_raw"]
    day = F.col("date").cast("date")
    cells_of_row = []
    for number, name in enumerate(ad_columns()):
        if name == "date":
            cell = F.col("date")
        elif name in raw.columns:
            cell = F.concat(F.lit('"'), F.coalesce(name, F.lit("")), F.lit('"'))
        elif name == "gfa_clicks":
            cell = F.when(F.day(day) % 2 == 1, F.lit(f'"{number}\n0"')).otherwise(F.lit(str(number)))
        else:
            cell = F.lit(str(number))
        cells_of_row.append(cell)
    row = F.when(F.day(day) % 5 == 0, F.concat_ws(",", *cells_of_row[:SHORT_ROW])).otherwise(
        F.concat_ws(",", *cells_of_row)
    )
    blank = F.lit("," * (len(cells_of_row) - 1))
    data = raw.select(
        F.datediff(day, F.lit("2000-01-01")).alias("place"), F.concat_ws("\n", row, F.lit(""), blank).alias("text")
    )
    header = spark.range(1).select(F.lit(0).alias("place"), F.lit("title\n\ndate,figures").alias("text"))
    lines = header.union(data).select(
        F.lit("sheet").alias("file"), "place", F.posexplode(F.split("text", "\n")).alias("n", "line")
    )
    grid = grid_of_lines(lines.select("file", (F.col("place") * 10 + F.col("n")).alias("position"), "line"))
    return clean_ads(grid).select("date", *SHEET_COLUMNS)


def _member_reports(tables: DemoTables) -> tuple[DataFrame, DataFrame]:
    """Member cells of a year, and of the next one up to week 20."""
    weekly = {"order_to": "1996-08-08", "first_monday": "2024-01-01"}
    old = weekly_settings(1995, **weekly, **DEMO)
    new = weekly_settings(1996, **weekly, **{**DEMO, "signup_year": 1996, "last_period": 20})
    return dashboard.member_cells(tables, old), dashboard.member_cells(tables, new)


def report_merge(spark: SparkSession, folder: str) -> DataFrame:
    """An earlier member report, overwritten by that of the next year.

    The new report ends at week 20, so later cells are kept from the old one.
    """
    return cells.merge_cells(*_member_reports(DemoTables(spark, folder)))


def report_changes(spark: SparkSession, folder: str) -> DataFrame:
    """What replacing a stored member report by that of the next year changed, lost and added."""
    store = scratch_folder(spark, "cells")
    for report in _member_reports(DemoTables(spark, folder)):
        cell_store.replace_cells(report, store)
    return cell_store.changes_of_last_write(spark, store)


def all_queries() -> dict[str, Query]:
    """Every query by name; reports with two grains appear once per grain."""
    found: dict[str, Query] = {
        "week_mode1": week_mode1_days,
        "week_calendar": week_calendar_events,
        "status_labels": status_labels,
        "vat_net": vat_net_prices,
        "first_order": first_order,
        "first_orders_updated": first_orders_updated,
        "lines_in_periods": lines_in_periods,
        "ads_clean": ads_clean,
        "ads_sheet": ads_sheet,
        "report_merge": report_merge,
        "report_changes": report_changes,
        "report_cells_grains": report_cells_grains,
    }

    def bound(build: Callable[[DemoTables, Settings], DataFrame], at: Settings) -> Query:
        return lambda spark, folder: build(DemoTables(spark, folder), at)

    for name, build in BY_GRAIN.items():
        for suffix, at in GRAINS.items():
            found[f"{name}_{suffix}"] = bound(build, at)
    return found
