"""The dashboard: every report of one grain, ending in cells.

The builders below return lazy DataFrames. :func:`write_dashboard` runs them
all, computes the item rollup once and writes the cells in one go.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.functions import codes
from tillgrid.functions.periods import MONTH, WEEK
from tillgrid.operators import ads, baskets, cells, members, points, sales
from tillgrid.operators.buyers import buyers, first_valid_orders, hot_keys
from tillgrid.operators.shipments import (
    daily_rollup,
    is_order_facts,
    order_facts,
    order_facts_of_grains,
    shipment_rollup,
    shipped_orders,
)
from tillgrid.plans import layouts
from tillgrid.sources.ad_grid import raw_sheet, read_ad_grid
from tillgrid.sources.cell_store import read_range, upsert_cells
from tillgrid.sources.folders import remove_folder

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Settings:
    """Dates, periods and sheets of one dashboard.

    ``first_period`` and ``last_period`` bound what is shown. Reports are built
    up to ``last_period``; earlier periods still serve as the base of growth.
    ``strict_referral`` and ``buyers_by_company`` are where the two grains
    differ in more than the period.
    """

    grain: str
    sheet: str
    point_sheet: str
    signup_year: int
    snapshot_year: int
    request_year: int
    ad_year: int
    point_year: int
    order_from: str
    order_to: str
    first_period: int
    last_period: int
    point_periods: Sequence[int]
    point_first_period: int
    ad_first_monday: str
    strict_referral: bool
    buyers_by_company: bool
    categories: Sequence[str] = field(default=tuple(codes.BUSINESS_CATEGORIES))


def weekly_settings(year: int, order_to: str, first_monday: str, **changes) -> Settings:
    """Weeks 2 to 32 of a year; week 1 is only the base of growth.

    ``first_monday`` starts calendar week 1 of the advertising report.
    """
    values = {
        "grain": WEEK,
        "sheet": "weekly",
        "point_sheet": "points weekly",
        "first_period": 2,
        "last_period": 32,
        "point_periods": range(29, 33),
        "point_first_period": 29,
        "ad_first_monday": first_monday,
        "strict_referral": True,
        "buyers_by_company": False,
    }
    return Settings(**{**_one_year(year, order_to), **values, **changes})


def monthly_settings(year: int, order_to: str, **changes) -> Settings:
    """Months 1 to 8 of a year."""
    values = {
        "grain": MONTH,
        "sheet": "monthly",
        "point_sheet": "points monthly",
        "first_period": 1,
        "last_period": 8,
        "point_periods": range(7, 9),
        "point_first_period": 7,
        "ad_first_monday": "",
        "strict_referral": False,
        "buyers_by_company": True,
    }
    return Settings(**{**_one_year(year, order_to), **values, **changes})


def _one_year(year: int, order_to: str) -> dict:
    kinds = ("signup", "snapshot", "request", "ad", "point")
    return {
        **{f"{kind}_year": year for kind in kinds},
        "order_from": f"{year}-01-01",
        "order_to": order_to,
    }


def member_measures(tables: Tables, settings: Settings) -> DataFrame:
    """Long measures of the member block."""
    grain, last = settings.grain, settings.last_period
    daily = tables["dashboard_user"]
    signed = members.signups(
        tables["user_account"], grain, settings.signup_year, last, settings.strict_referral
    )
    by_type = signed.select(
        F.lit(layouts.MEMBERS).alias("block"),
        "period",
        F.when(F.col("referral_type") == codes.FRIEND_REFERRAL, "friend")
        .otherwise("agency")
        .alias("measure"),
        F.col("signups").cast("string").alias("value"),
    )
    snapshot = members.member_snapshot(daily, grain, settings.snapshot_year, last)
    parts = [
        members.new_members(daily, grain, settings.snapshot_year, last),
        snapshot,
        members.member_growth(snapshot),
        members.requests(tables["direct_shipping"], grain, settings.request_year, last),
    ]
    long = by_type
    for part in parts:
        names = [name for name in part.columns if name != "period"]
        long = long.unionByName(cells.measures_long(part, names, layouts.MEMBERS))
    return long


def refresh_ads(spark: SparkSession, raw_folder: str, target: str) -> DataFrame:
    """Replace the advertising table at ``target`` by the cleaned raw sheet."""
    grid = read_ad_grid(spark, raw_sheet(spark, raw_folder))
    ads.ads_clean(grid).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def ad_figures(tables: Tables, settings: Settings) -> DataFrame:
    if settings.grain == WEEK:
        return ads.ads_weekly(tables["ads"], settings.ad_first_monday, settings.last_period)
    return ads.ads_monthly(tables["ads"], settings.ad_year, settings.last_period)


def ad_measures(tables: Tables, settings: Settings) -> DataFrame:
    """Long measures of the advertising block."""
    return cells.measures_long(
        ad_figures(tables, settings), list(layouts.AD_ROWS), layouts.ADS
    )


def point_shares(tables: Tables, settings: Settings) -> DataFrame:
    return points.point_share(
        tables["point"],
        tables["user_account"],
        tables["base_user"],
        settings.grain,
        settings.point_year,
        settings.point_periods,
    )


#: Name, among the tables, of a stored result of :func:`first_valid_orders`.
FIRST_ORDERS = "first_orders"


def buyer_rows(tables: Tables, by_company: bool) -> DataFrame:
    first = tables[FIRST_ORDERS] if FIRST_ORDERS in tables else None
    return buyers(
        tables["shipment"], tables["user_account"], tables["base_user"], by_company, first
    )


def orders_in_range(tables: Tables, settings: Settings) -> DataFrame:
    return shipped_orders(tables["shipment"], settings.order_from, settings.order_to)


def rollup_of(tables: Tables, settings: Settings) -> DataFrame:
    return shipment_rollup(tables["shipment_item"], settings.grain)


def facts_of(tables: Tables, settings: Settings) -> DataFrame:
    """Order facts that the sales and basket reports take in place of a rollup."""
    return order_facts(rollup_of(tables, settings), orders_in_range(tables, settings))


def _bought(
    tables: Tables, settings: Settings, facts: DataFrame, buyer_rows: DataFrame
) -> DataFrame:
    if not is_order_facts(facts):
        return sales.sales_lines(facts, orders_in_range(tables, settings), buyer_rows)
    hot = None
    if FIRST_ORDERS in tables:
        hot = hot_keys(tables[FIRST_ORDERS], "user_id", "valid_orders")
    return sales.bought(facts, buyer_rows, hot)


def delivery_sales(tables: Tables, settings: Settings, facts: DataFrame) -> DataFrame:
    """Sales by delivery type; ``facts`` here and below are order facts or a rollup."""
    by_buyer = buyer_rows(tables, settings.buyers_by_company)
    return sales.sales_by_delivery(_bought(tables, settings, facts, by_buyer))


def total_sales(tables: Tables, settings: Settings, facts: DataFrame) -> DataFrame:
    by_user = buyer_rows(tables, by_company=False)
    return sales.sales_total(_bought(tables, settings, facts, by_user))


def category_sales(tables: Tables, settings: Settings, facts: DataFrame) -> DataFrame:
    in_category = sales.in_categories(
        buyer_rows(tables, by_company=False),
        tables["user_business_type_code"],
        tables["business_type"],
        settings.categories,
    )
    return sales.sales_by_category(
        _bought(tables, settings, facts, in_category), settings.categories
    )


def basket_rows(
    tables: Tables, settings: Settings, facts: DataFrame, by_delivery: bool = True
) -> DataFrame:
    if is_order_facts(facts):
        return baskets.baskets_of_facts(facts, by_delivery)
    return baskets.baskets(facts, orders_in_range(tables, settings), by_delivery)


def sales_measures(tables: Tables, settings: Settings, facts: DataFrame) -> DataFrame:
    """Long measures of the sales, total and band blocks."""
    delivery = delivery_sales(tables, settings, facts)
    total = total_sales(tables, settings, facts)
    in_baskets = basket_rows(tables, settings, facts)
    bands = list(codes.BASKET_BANDS)
    by_type = cells.earliest_year(baskets.basket_bands(in_baskets), "delivery_type")
    over_all = cells.earliest_year(baskets.basket_bands_total(in_baskets))
    type_block = F.col("delivery_type")
    return (
        cells.measures_long(delivery, list(layouts.DIRECT_ROWS), type_block)
        .unionByName(cells.measures_long(total, list(layouts.TOTAL_ROWS), layouts.TOTAL))
        .unionByName(cells.measures_long(by_type, bands, type_block))
        .unionByName(cells.measures_long(over_all, bands, layouts.TOTAL))
    )


def member_cells(tables: Tables, settings: Settings) -> DataFrame:
    """Cells of the member block alone."""
    return _on_main_sheet(member_measures(tables, settings), settings)


def ad_cells(tables: Tables, settings: Settings) -> DataFrame:
    """Cells of the advertising block alone."""
    return _on_main_sheet(ad_measures(tables, settings), settings)


def sales_cells(tables: Tables, settings: Settings, facts: DataFrame) -> DataFrame:
    """Cells of the sales, total and band blocks.

    Four reports read the facts, so they had better be stored ones.
    """
    return _on_main_sheet(sales_measures(tables, settings, facts), settings)


def report_cells(tables: Tables, settings: Settings, facts: DataFrame) -> DataFrame:
    """Cells of all blocks but the categories, point sheet included."""
    main = (
        member_measures(tables, settings)
        .unionByName(ad_measures(tables, settings))
        .unionByName(sales_measures(tables, settings, facts))
    )
    return _on_main_sheet(main, settings).unionByName(point_cells(tables, settings))


def report_cells_category(tables: Tables, settings: Settings, facts: DataFrame) -> DataFrame:
    """Cells of the category blocks."""
    by_category = category_sales(tables, settings, facts)
    long = cells.measures_long(
        by_category, layouts.CATEGORY_MEASURES, F.col("business_category")
    )
    return _placed(long, layouts.category_layout(settings.sheet, settings.categories), settings)


def point_cells(tables: Tables, settings: Settings) -> DataFrame:
    """Cells of the point sheet, one column per reported period."""
    filled = points.point_share_filled(point_shares(tables, settings))
    long = cells.measures_long(
        filled.withColumn("share", F.col("share").cast("string")), ["share"], F.col("reason")
    )
    layout = cells.layout_table(
        long.sparkSession, layouts.point_layout(settings.point_sheet, settings.point_first_period)
    )
    periods = list(settings.point_periods)
    return cells.place_cells(long, layout, min(periods), max(periods))


def _on_main_sheet(long: DataFrame, settings: Settings) -> DataFrame:
    return _placed(long, layouts.main_layout(settings.sheet), settings)


def _placed(long: DataFrame, places: list[layouts.Place], settings: Settings) -> DataFrame:
    layout = cells.layout_table(long.sparkSession, places)
    return cells.place_cells(long, layout, settings.first_period, settings.last_period)


@contextmanager
def stored(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Compute once what several reports read, for the time of a ``with`` block.

    The rows are written as a table to the session's checkpoint folder, which
    outlives lost executors and still lets every reader pick its columns, and
    removed afterwards.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    path = f"{folder}/{spark.conf.get('spark.app.id')}/{name}_{uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)


def pruned_rollup(tables: Tables, settings: Settings) -> DataFrame:
    """The rollup of shipments in the order range alone.

    For a rollup that is stored before it meets the shipments. The range is on
    the shipments only, as an item may enter at any time.
    """
    wanted = orders_in_range(tables, settings).select("shipment_id")
    return rollup_of(tables, settings).join(wanted, "shipment_id", "left_semi")


def _all_cells(tables: Tables, settings: Settings, facts: DataFrame) -> DataFrame:
    main = report_cells(tables, settings, facts)
    return main.unionByName(report_cells_category(tables, settings, facts))


def write_dashboard(tables: Tables, settings: Settings, store: str) -> None:
    """Build all reports of a grain and upsert their cells into the store."""
    write_dashboards(tables, [settings], store)


def write_dashboards(tables: Tables, dashboards: Sequence[Settings], store: str) -> None:
    """Build the reports of one or more grains and upsert their cells into the store at once.

    Items are read once for all grains, and shipments twice: for the facts of orders
    in range, and for the first order of every user. Both results are stored
    while the reports read them. The grains must have the same order dates.
    """
    first = dashboards[0]
    if any((at.order_from, at.order_to) != (first.order_from, first.order_to) for at in dashboards):
        raise ValueError("dashboards of one reading need the same order dates")
    if len(dashboards) == 1:
        facts = facts_of(tables, first).withColumn("grain", F.lit(first.grain))
    else:
        daily, orders = daily_rollup(tables["shipment_item"]), orders_in_range(tables, first)
        facts = order_facts_of_grains(daily, orders, [at.grain for at in dashboards])
    with stored(facts, "facts") as facts, stored(
        first_valid_orders(tables["shipment"]), FIRST_ORDERS
    ) as first_orders:
        known = {**tables, FIRST_ORDERS: first_orders}
        made = [
            _all_cells(known, at, facts.filter(F.col("grain") == at.grain).drop("grain"))
            for at in dashboards
        ]
        upsert_cells(reduce(DataFrame.unionByName, made), store)


def check_points(spark: SparkSession, settings: Settings, store: str) -> DataFrame:
    """Stored point shares of the reported periods with their check sum."""
    offset = 2 - settings.point_first_period
    columns = [period + offset for period in settings.point_periods]
    rows = list(layouts.POINT_ROWS.values())
    read = read_range(
        spark,
        store,
        settings.point_sheet,
        (min(rows), max(rows)),
        (min(columns), max(columns)),
    )
    return cells.verify_points(read, settings.point_sheet, layouts.POINT_ROWS)
