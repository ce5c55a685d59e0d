"""Sign-ups, new members, direct-shipping requests, member snapshots, growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.functions.codes import referral_type
from tillgrid.functions.periods import calendar_day, in_year, period_of


def signups(
    users: DataFrame, grain: str, year: int, last_period: int, strict_referral: bool
) -> DataFrame:
    """Sign-ups by period and referral type; users without a type are left out."""
    return (
        users.filter((F.col("deleted_yn") == "n") & in_year(users, "created_at", year))
        .select(
            period_of(calendar_day(users, "created_at"), grain).alias("period"),
            referral_type(F.col("recommender_username"), strict_referral).alias("referral_type"),
        )
        .filter((F.col("period") <= last_period) & F.col("referral_type").isNotNull())
        .groupBy("period", "referral_type")
        .agg(F.count("*").alias("signups"))
    )


def _daily(dashboard: DataFrame, grain: str, year: int, last_period: int) -> DataFrame:
    day = calendar_day(dashboard, "period_date")
    return (
        dashboard.filter(
            (F.col("period_type") == "DAILY") & in_year(dashboard, "period_date", year)
        )
        .withColumn("period", period_of(day, grain))
        .filter(F.col("period") <= last_period)
    )


def new_members(dashboard: DataFrame, grain: str, year: int, last_period: int) -> DataFrame:
    """Daily new-member counts summed by period."""
    return (
        _daily(dashboard, grain, year, last_period)
        .groupBy("period")
        .agg(F.sum("new_count").alias("new_members"))
    )


def requests(shipping: DataFrame, grain: str, year: int, last_period: int) -> DataFrame:
    """Direct-shipping requests that were not deleted, by period."""
    return (
        shipping.filter((F.col("is_deleted") == 0) & in_year(shipping, "created_at", year))
        .select(period_of(calendar_day(shipping, "created_at"), grain).alias("period"))
        .filter(F.col("period") <= last_period)
        .groupBy("period")
        .agg(F.count("*").alias("requests"))
    )


def member_snapshot(dashboard: DataFrame, grain: str, year: int, last_period: int) -> DataFrame:
    """Counts of the last daily snapshot of each period.

    The maximum of a struct that starts with the date needs no sort and combines
    before the shuffle. Equal dates are settled by the counts.
    """
    counts = ["ok_total_count", "ok_direct_count", "ok_parcel_count"]
    return (
        _daily(dashboard, grain, year, last_period)
        .groupBy("period")
        .agg(F.max(F.struct("period_date", *counts)).alias("last"))
        .select("period", *[F.col(f"last.{count}").alias(count) for count in counts])
    )


def member_growth(snapshot: DataFrame) -> DataFrame:
    """Difference to the snapshot of the previous period number, from period 2.

    A period whose predecessor is missing grows by its whole count, which a lag
    over the existing rows would not give; a missing count of the predecessor is
    0, one of the period's own has no growth. Each snapshot is brought to its own
    period and to the next, so the source is read once and not joined.
    """
    kinds = ["total", "direct", "parcel"]

    def entry(period: Column, is_own: bool) -> Column:
        counts = [F.col(f"ok_{kind}_count").alias(kind) for kind in kinds]
        return F.struct(period.alias("period"), F.lit(is_own).alias("is_own"), *counts)

    def growth(kind: str) -> Column:
        own = F.max(F.when(F.col("is_own"), F.col(kind)))
        before = F.max(F.when(~F.col("is_own"), F.col(kind)))
        return (own - F.coalesce(before, F.lit(0))).alias(f"{kind}_growth")

    own, following = entry(F.col("period"), True), entry(F.col("period") + 1, False)
    return (
        snapshot.select(F.inline(F.array(own, following)))
        .groupBy("period")
        .agg(
            F.max("is_own").alias("is_own"),
            *[growth(kind) for kind in kinds],
        )
        .filter(F.col("is_own") & (F.col("period") >= 2))
        .drop("is_own")
    )
