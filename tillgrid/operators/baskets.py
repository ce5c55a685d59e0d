"""Shares of basket-size bands in orders and in net sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrid.functions.codes import BASKET_BANDS, basket_band
from tillgrid.functions.money import rounded_share


def baskets(rollup: DataFrame, orders: DataFrame, by_delivery: bool = True) -> DataFrame:
    """One row per entering year, period, order number and delivery type.

    An order that enters in several periods is a basket in each of them, and
    the delivery fee counts once per item line. Without ``by_delivery`` an order
    is one basket over both types.
    """
    fee = F.col("delivery_fee") * F.col("item_lines")
    block = ["delivery_type"] if by_delivery else []
    return (
        rollup.join(orders, "shipment_id")
        .groupBy("entering_year", "period", *block, "order_number")
        .agg(
            F.sum("gross").alias("total"),
            F.sum("point").alias("point"),
            F.sum("coupon").alias("coupon"),
            F.sum(fee).alias("delivery"),
        )
    )


def baskets_of_facts(facts: DataFrame, by_delivery: bool = True) -> DataFrame:
    """The same baskets from order facts, which are there already where sales are reported too."""
    block = ["delivery_type"] if by_delivery else []
    sums = {"gross": "total", "point": "point", "coupon": "coupon", "delivery_price": "delivery"}
    return facts.groupBy("entering_year", "period", *block, "order_number").agg(
        *[F.sum(name).alias(alias) for name, alias in sums.items()]
    )


def _band_shares(basket_rows: DataFrame, block: Sequence[str]) -> DataFrame:
    """Text ``orders%(net sales%)`` per band, one column each.

    The denominator is the whole period: both delivery types and baskets without
    a band are in it. Baskets are unique per order number and block, so counting
    them counts distinct orders. Net sales are taken from the sums of a basket,
    so a missing point, coupon or fee of one row costs nothing of the others.
    """
    net = F.col("total") - F.col("point") - F.col("coupon") + F.col("delivery")
    bands = basket_rows.groupBy(
        "entering_year", "period", *block, basket_band(F.col("total")).alias("band")
    ).agg(
        F.count("order_number").alias("orders"),
        F.sum(net).alias("net_total"),
    )
    period = Window.partitionBy("entering_year", "period")

    def percent(name: str) -> Column:
        share = rounded_share(F.col(name), F.sum(name).over(period), 1, percent=True)
        return share.cast("string")

    text = F.concat(percent("orders"), F.lit("%("), percent("net_total"), F.lit("%)"))
    return (
        bands.withColumn("shares", text)
        .groupBy("entering_year", "period", *block)
        .agg(*[F.max(F.when(F.col("band") == band, F.col("shares"))).alias(band)
               for band in BASKET_BANDS])
    )


def basket_bands(basket_rows: DataFrame) -> DataFrame:
    """Band shares by year, period and delivery type."""
    return _band_shares(basket_rows, ["delivery_type"])


def basket_bands_total(basket_rows: DataFrame) -> DataFrame:
    """Band shares by year and period, an order being one basket over both types.

    Takes baskets of either kind. Baskets by delivery type are merged first,
    which is the shorter way where they are there already.
    """
    if "delivery_type" in basket_rows.columns:
        basket_rows = basket_rows.groupBy("entering_year", "period", "order_number").agg(
            *[F.sum(name).alias(name) for name in ("total", "point", "coupon", "delivery")]
        )
    return _band_shares(basket_rows, [])
