"""Items and shipments prepared once for all sales and basket reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.functions import codes
from tillgrid.functions.money import is_whole, money, rounded_amount, vat_net
from tillgrid.functions.periods import MONTH, WEEK, between_days, calendar_day, period_of


SUMS = ["supply_price", "discount_price", "coupon", "point", "pg_supply_price", "gross"]


def shipment_rollup(items: DataFrame, grain: str) -> DataFrame:
    """Ordered items added up per shipment and period they enter.

    Everything else the reports need hangs on the shipment, so this is as far as
    items can be reduced before the join. The sums combine before the shuffle: a
    shipment with very many items leaves each task as one row per period. Items
    without a date keep a NULL period.
    """
    day = calendar_day(items, "entering_dated_at")
    return _rollup(items, F.year(day).alias("entering_year"), period_of(day, grain).alias("period"))


def daily_rollup(items: DataFrame) -> DataFrame:
    """Ordered items added up per shipment and day they enter, for more than one grain."""
    return _rollup(items, calendar_day(items, "entering_dated_at").alias("day"))


def _rollup(items: DataFrame, *times: Column) -> DataFrame:
    taxed = F.col("tax_type") == codes.TAXED
    price, list_price = money(items, "price"), money(items, "list_price")
    gross = price * F.col("quantity")
    discount = (list_price - price) * F.col("quantity")
    whole_price = is_whole(items, "price", "quantity")
    whole_discount = is_whole(items, "price", "list_price", "quantity")

    def net(amount: Column, whole: bool) -> Column:
        return F.when(taxed, vat_net(amount, whole)).otherwise(rounded_amount(amount, whole))

    def net_if_taxed(name: str) -> Column:
        amount = money(items, name)
        return F.when(taxed, vat_net(amount, is_whole(items, name))).otherwise(amount)

    dated = items.filter((F.col("is_deleted") == 0) & (F.col("item_status") == codes.ORDERED_ITEM)).select(
        "shipment_id",
        *times,
        net(gross, whole_price).alias("supply_price"),
        net(discount, whole_discount).alias("discount_price"),
        net_if_taxed("coupon_discount_amount").alias("coupon"),
        net_if_taxed("use_point").alias("point"),
        money(items, "supply_price").alias("pg_supply_price"),
        F.when(taxed, gross).otherwise(rounded_amount(gross, whole_price)).alias("gross"),
    )
    keys = [name for name in dated.columns if name not in SUMS]
    return dated.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in SUMS], F.count("*").alias("item_lines"))


#: What an order fact is unique by, besides the period it enters.
FACT_KEYS = ["status", "delivery_type", "user_id", "order_number"]


def _fact_measures() -> list[Column]:
    return [
        *[F.sum(name).alias(name) for name in SUMS],
        F.sum(F.col("delivery_fee") * F.col("item_lines")).alias("delivery_price"),
        F.sum("item_lines").alias("item_lines"),
        F.min("order_dated_at").alias("first_at"),
    ]


def order_facts(rollup: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per entering period, status, delivery type, user and order number.

    All sales and basket reports are sums and distinct counts over these, so
    shipments are read and added up once for all of them. ``delivery_price`` is
    the fee of every item line, ``first_at`` the earliest order time.
    """
    keys = ["entering_year", "period", *FACT_KEYS]
    return rollup.join(orders, "shipment_id").groupBy(*keys).agg(*_fact_measures())


def order_facts_of_grains(daily: DataFrame, orders: DataFrame, grains: Sequence[str] = (WEEK, MONTH)) -> DataFrame:
    """The order facts of several grains from one reading of the items, told apart by ``grain``.

    ``daily`` comes from :func:`daily_rollup`. A day is in one period of each grain; the
    grains are grouping sets, so both are added up from the same rows before the shuffle.
    """
    day = F.col("day")
    dated = daily.join(orders, "shipment_id").withColumns(
        {"entering_year": F.year(day), **{f"_{grain}": period_of(day, grain) for grain in grains}}
    )
    keys = ["entering_year", *FACT_KEYS]
    other = [f"_{grain}" for grain in grains]
    summed = dated.groupingSets([[*keys, name] for name in other], *keys, *other).agg(
        *_fact_measures(), *[F.grouping(name).alias(f"{name}_out") for name in other]
    )
    grain = F.coalesce(*[F.when(F.col(f"_{grain}_out") == 0, F.lit(grain)) for grain in grains])
    period = F.coalesce(*[F.when(F.col(f"_{grain}_out") == 0, F.col(f"_{grain}")) for grain in grains])
    return summed.select(grain.alias("grain"), period.alias("period"), *[
        name for name in summed.columns if not name.startswith("_")
    ])


def is_order_facts(df: DataFrame) -> bool:
    """Order facts rather than a rollup, which does not know its orders yet."""
    return "order_number" in df.columns


def shipped_orders(shipments: DataFrame, order_from: str, order_to: str) -> DataFrame:
    """Shipments under way or delivered, ordered within the dates (inclusive).

    ``delivery_fee`` is net of VAT and for one item line: the reports count it
    once per line.
    """
    fee = vat_net(money(shipments, "delivery_price"), is_whole(shipments, "delivery_price"))
    return shipments.filter(
        F.col("status").isin(codes.SHIPPED_STATUSES)
        & between_days(shipments, "order_dated_at", order_from, order_to)
    ).select(
        F.col("id").alias("shipment_id"),
        "user_id",
        "order_number",
        "status",
        codes.delivery_type(F.col("courier")).alias("delivery_type"),
        "order_dated_at",
        fee.alias("delivery_fee"),
    )
