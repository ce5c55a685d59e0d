"""Per-user facts: accounts, first valid order, business categories.

The reports reach users through inner joins, so a user with two accounts counts
twice in every sum. Each table is therefore reduced to one row per user with a
count, and sums are multiplied by the count after the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.functions.codes import VALID_ORDER_STATUSES

# Rows of one key that go to one task of a spread join, and the parts of rows
# without a key.
ROWS_PER_PART = 1_000_000
KEYLESS_PARTS = 1_000


def spread_join(
    facts: DataFrame,
    per_key: DataFrame,
    key: str,
    spread_by: str,
    how: str = "inner",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join many facts to few rows per key, hot keys over several tasks.

    Both sides are shuffled for this join alone, so AQE can still split a part
    that is too large, or broadcast the smaller side after measuring it. ``hot``
    comes from :func:`hot_keys`; without it the facts are counted here.
    """
    split, repeated = split_hot_keys(facts, per_key, key, spread_by, hot)
    return split.join(repeated, [key, "_part"], how).drop("_part")


def hot_keys(counted: DataFrame, key: str, rows: str) -> DataFrame:
    """``key, _parts`` of the keys with more than ``ROWS_PER_PART`` rows, from a count per key.

    A count that is too high only makes more parts. There is at most one hot key
    per ``ROWS_PER_PART`` rows, which bounds what is broadcast.
    """
    parts = F.ceil(F.col(rows) / ROWS_PER_PART).cast("int").alias("_parts")
    return counted.filter(F.col(key).isNotNull() & (F.col(rows) > ROWS_PER_PART)).select(key, parts)


def split_hot_keys(
    facts: DataFrame, per_key: DataFrame, key: str, spread_by: str, hot: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_part`` to join by together with the key.

    A key with more than ``ROWS_PER_PART`` facts gets a part per that many, and
    its rows of the smaller side are repeated for each; other keys have one
    part. A fact takes its part from a hash of ``spread_by``, which stays the
    same when a lost task is run again.
    """
    if hot is None:
        hot = hot_keys(facts.groupBy(key).agg(F.count("*").alias("_facts")), key, "_facts")
    hot = F.broadcast(hot)
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    fact_parts = F.when(F.col(key).isNull(), KEYLESS_PARTS).otherwise(parts)
    split = facts.join(hot, key, "left").withColumn(
        "_part", F.pmod(F.xxhash64(spread_by), fact_parts).cast("int")
    )
    repeated = per_key.join(hot, key, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    return split.drop("_parts"), repeated.drop("_parts")


def account_counts(
    users: DataFrame, base_users: DataFrame, extra: Sequence[str] = ()
) -> DataFrame:
    """``user_id, accounts`` (and ``extra`` columns of the account) per user."""
    accounts = users.groupBy(F.col("base_user_id").alias("user_id"), *extra).agg(
        F.count("*").alias("accounts")
    )
    registered = base_users.groupBy(F.col("id").alias("user_id")).agg(
        F.count("*").alias("registered")
    )
    return accounts.join(registered, "user_id").select(
        "user_id", *extra, (F.col("accounts") * F.col("registered")).alias("accounts")
    )


def first_valid_orders(shipments: DataFrame) -> DataFrame:
    """Earliest order time and number of the valid shipments per user, over the whole table."""
    return (
        shipments.filter(F.col("status").isin(VALID_ORDER_STATUSES))
        .groupBy("user_id")
        .agg(F.min("order_dated_at").alias("first_valid_at"), F.count("*").alias("valid_orders"))
    )


def updated_first_orders(
    stored: DataFrame, removed: DataFrame, added: DataFrame, shipments: DataFrame
) -> DataFrame:
    """What :func:`first_valid_orders` gives after a change, from what it gave before.

    ``removed`` holds shipments as they were and no longer are, cancelled ones
    among them, ``added`` new shipments and changed ones as they are now, and
    ``shipments`` the whole table as it is now. The table is read for those users alone whose
    first order may have gone, to find their next one; all others follow from the
    stored row and the changes. Users without a valid shipment have no row.
    """
    gone, come = first_valid_orders(removed), first_valid_orders(added)
    nothing = F.lit(None).cast(stored.schema["first_valid_at"].dataType)

    def part(rows: DataFrame, sign: int, name: str) -> DataFrame:
        dates = {other: F.col("first_valid_at") if other == name else nothing for other in ("before", "gone", "come")}
        return rows.select(
            "user_id", (F.col("valid_orders") * sign).alias("valid_orders"), *[date.alias(at) for at, date in dates.items()]
        )

    changed = (
        part(stored, 1, "before").unionByName(part(gone, -1, "gone")).unionByName(part(come, 1, "come"))
        .groupBy("user_id")
        .agg(F.sum("valid_orders").alias("valid_orders"), *[F.min(name).alias(name) for name in ("before", "gone", "come")])
        .filter(F.col("valid_orders") > 0)
    )
    # A removed order was the first one, and no added one is as early.
    unsure = F.coalesce(F.col("gone") <= F.col("before"), F.lit(False)) & ~F.coalesce(
        F.col("come") <= F.col("before"), F.lit(False)
    )
    known = changed.filter(~unsure).select(
        "user_id", F.least("before", "come").alias("first_valid_at"), "valid_orders"
    )
    asked = changed.filter(unsure).select(F.col("user_id").alias("asked"))
    again = shipments.join(asked, F.col("user_id").eqNullSafe(F.col("asked")), "left_semi")
    return known.unionByName(first_valid_orders(again))


def is_first_order(ordered_at: str = "order_dated_at") -> Column:
    """No valid shipment of the user is strictly earlier than this one."""
    return ~F.coalesce(F.col("first_valid_at") < F.col(ordered_at), F.lit(False))


def first_order(shipments: DataFrame) -> DataFrame:
    """``id, user_id, first_order``: 'O' for first orders of a user, else 'X'.

    The earlier-order test needs only the minimum per user, so no shipment is
    compared with another one.
    """
    flag = F.when(is_first_order(), "O").otherwise("X")
    return spread_join(
        shipments.select("id", "user_id", "order_dated_at"),
        first_valid_orders(shipments),
        "user_id",
        spread_by="id",
        how="left",
    ).select("id", "user_id", flag.alias("first_order"))


def buyers(
    shipments: DataFrame,
    users: DataFrame,
    base_users: DataFrame,
    by_company: bool = False,
    first_orders: DataFrame | None = None,
) -> DataFrame:
    """``user_id, accounts, first_valid_at`` for users with an account.

    With ``by_company`` there is a row per user and ``company``, which is then
    what the buyer count counts. ``first_orders`` is the result of
    :func:`first_valid_orders` where it is there already.
    """
    extra = ["company_name"] if by_company else []
    if first_orders is None:
        first_orders = first_valid_orders(shipments)
    return (
        account_counts(users, base_users, extra)
        .join(first_orders, "user_id", "left")
        .select("user_id", *[F.col(name).alias("company") for name in extra], "accounts", "first_valid_at")
    )


def with_categories(
    buyer_rows: DataFrame,
    category_codes: DataFrame,
    categories: DataFrame,
    names: Sequence[str],
) -> DataFrame:
    """Buyers once per business category, for the named categories only."""
    codes_per_user = category_codes.groupBy(
        F.col("base_user_id").alias("user_id"), F.col("business_type_codes").alias("category_id")
    ).agg(F.count("*").alias("codes"))
    named = categories.filter(F.col("name").isin(list(names))).select(
        F.col("id").alias("category_id"), F.col("name").alias("business_category")
    )
    links = (
        spread_join(codes_per_user, named, "category_id", spread_by="user_id")
        .groupBy("user_id", "business_category")
        .agg(F.sum("codes").alias("codes"))
    )
    return (
        buyer_rows.join(links, "user_id")
        .withColumn("accounts", F.col("accounts") * F.col("codes"))
        .drop("codes")
    )
