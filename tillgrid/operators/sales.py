"""Sales measures by delivery type, by business category and in total.

Two stages on purpose. Distinct orders and buyers are counted per entering
year, period and shipment status, and these counts are then summed by period: a
buyer with parcels in two statuses counts twice, and equal period numbers of
two years are added. The published numbers are defined that way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.functions.codes import BUSINESS_CATEGORIES, position
from tillgrid.operators.buyers import hot_keys, is_first_order, spread_join, with_categories
from tillgrid.operators.shipments import order_facts

ADDED = ["supply_price", "discount_price", "coupon", "point", "pg_supply_price", "delivery_price"]
COUNTED = ["orders", "orders_sku", "buyers", "first_order_users"]
USER, ORDER, COMPANY = 0, 1, 2


def sales_lines(rollup: DataFrame, orders: DataFrame, buyer_rows: DataFrame) -> DataFrame:
    """Dated order facts of a rollup and its shipments, with their buyers."""
    counted = orders.groupBy("user_id").agg(F.count("*").alias("shipments"))
    return bought(order_facts(rollup, orders), buyer_rows, hot_keys(counted, "user_id", "shipments"))


def bought(facts: DataFrame, buyer_rows: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Dated order facts with their buyers.

    ``facts`` come from :func:`~tillgrid.operators.shipments.order_facts`, so a user
    has one row per order and period there, however many items it has.
    """
    dated = facts.filter(F.col("entering_year").isNotNull())
    return spread_join(dated, buyer_rows, "user_id", spread_by="order_number", hot=hot).select(
        "*", is_first_order("first_at").alias("is_first")
    )


def _staged(
    lines: DataFrame, split_by: Sequence[str], block: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Measures per stage-one group (``split_by`` included), summed by block.

    What is counted distinctly, users, orders and companies, becomes one set of
    keys per group, told apart by their kind. Sets merge before the shuffle, users carry
    the sums, and the rows of all sets are then counted in one go.
    """
    group = ["entering_year", "period", "status", *split_by]
    accounts = F.col("accounts")
    added = {name: F.col(name) * accounts for name in ADDED}
    added["orders_sku"] = F.when(F.col("order_number").isNotNull(), F.col("item_lines") * accounts)
    added = {name: value for name, value in added.items() if name in measures}

    def keys_of(kind: int, key: str) -> Column:
        carried = {**added, "is_first": F.col("is_first")}
        return F.struct(
            F.lit(kind).alias("kind"),
            F.col(key).cast("string").alias("key"),
            *[F.when(F.lit(kind == USER), value).alias(name) for name, value in carried.items()],
        )

    by_company = "company" in lines.columns
    kinds = [keys_of(USER, "user_id")]
    if "orders" in measures:
        kinds.append(keys_of(ORDER, "order_number"))
    if "buyers" in measures and by_company:
        kinds.append(keys_of(COMPANY, "company"))
    sets = (
        lines.select(*group, F.inline(F.array(*kinds)))
        .groupBy(*group, "kind", "key")
        .agg(*[F.sum(name).alias(name) for name in added], F.max("is_first").alias("is_first"))
    )

    def number(kind: int, asked: Column | bool = True) -> Column:
        return F.count(F.when((F.col("kind") == kind) & F.lit(asked), F.col("key")))

    available = {
        **{name: F.sum(name) for name in added},
        "orders_sku": F.coalesce(F.sum("orders_sku"), F.lit(0)) if "orders_sku" in added else None,
        "orders": number(ORDER),
        "buyers": number(COMPANY if by_company else USER),
        "first_order_users": number(USER, F.col("is_first")),
    }
    return sets.groupBy("period", *block).agg(*[available[name].alias(name) for name in measures])


def sales_by_delivery(lines: DataFrame) -> DataFrame:
    """Nine measures by period and delivery type; supply price is net of VAT."""
    measures = ["supply_price", "discount_price", "delivery_price", "coupon", "point", *COUNTED]
    return _staged(lines, ["delivery_type"], ["delivery_type"], measures)


def sales_total(lines: DataFrame) -> DataFrame:
    """Buyers and first-order users by period over both delivery types."""
    return _staged(lines, [], [], ["buyers", "first_order_users"])


def in_categories(
    buyer_rows: DataFrame,
    category_codes: DataFrame,
    categories: DataFrame,
    names: Sequence[str] = tuple(BUSINESS_CATEGORIES),
) -> DataFrame:
    """Buyers once per business category they are in, for the named ones."""
    return with_categories(buyer_rows, category_codes, categories, names)


def sales_by_category(lines: DataFrame, names: Sequence[str] = tuple(BUSINESS_CATEGORIES)) -> DataFrame:
    """Nine measures by period and business category, ranked in the given order.

    ``lines`` are of buyers :func:`in_categories`, so a user of two counts in
    both. The supply price is the stored one. Distinct counts are taken per delivery
    type before they are added.
    """
    measures = ["pg_supply_price", "discount_price", "delivery_price", "coupon", "point", *COUNTED]
    sales = _staged(
        lines, ["business_category", "delivery_type"], ["business_category"], measures
    )
    return sales.withColumn("category_rank", position(F.col("business_category"), list(names)))
