"""Shares of the reported reasons in charged loyalty points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillgrid.functions import codes
from tillgrid.functions.money import money, rounded_share
from tillgrid.functions.periods import calendar_day, in_year, period_of
from tillgrid.operators.buyers import account_counts


def point_share(
    points: DataFrame,
    users: DataFrame,
    base_users: DataFrame,
    grain: str,
    year: int,
    periods: Sequence[int],
) -> DataFrame:
    """Share of first-order, sign-up and referral points by period.

    Points are added up per user, period and reason before they meet the user
    tables, so a user with very many points is a handful of rows by then. The
    share is taken of all reasons of the period and rounded per reason; only
    then are the reported reasons picked and the two referral ones added.
    """
    charged = (
        points.filter(
            (F.col("event_type") == codes.CHARGED_EVENT) & in_year(points, "created_at", year)
        )
        .select(
            "user_id",
            period_of(calendar_day(points, "created_at"), grain).alias("period"),
            codes.label(
                F.col("reason_type"), codes.POINT_REASON, codes.POINT_REASON_OTHER
            ).alias("reason"),
            money(points, "amount").alias("amount"),
        )
        .filter(F.col("period").isin(list(periods)))
        .groupBy("user_id", "period", "reason")
        .agg(F.sum("amount").alias("amount"))
    )
    by_reason = (
        charged.join(account_counts(users, base_users), "user_id")
        .groupBy("period", "reason")
        .agg(F.sum(F.col("amount") * F.col("accounts")).alias("amount"))
    )
    total = F.sum("amount").over(Window.partitionBy("period"))
    reason = codes.reported_reason(F.col("reason"))
    return (
        by_reason.withColumn("share", rounded_share(F.col("amount"), total, 2))
        .withColumn("reason", reason)
        .filter(F.col("reason").isin(codes.REPORTED_REASONS))
        .groupBy("period", "reason")
        .agg(F.sum("share").cast("decimal(20,2)").alias("share"))
        .withColumn("reason_rank", codes.position(F.col("reason"), codes.REPORTED_REASONS))
    )


def point_share_filled(shares: DataFrame) -> DataFrame:
    """All reported reasons, 0 where missing, for periods that have any."""
    reasons = codes.REPORTED_REASONS
    wide = shares.groupBy("period").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("reason") == reason, F.col("share"))), F.lit(0))
            .cast("decimal(20,2)")
            .alias(reason)
            for reason in reasons
        ]
    )
    return wide.unpivot("period", reasons, "reason", "share").withColumn(
        "reason_rank", codes.position(F.col("reason"), reasons)
    )
