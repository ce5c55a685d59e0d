"""Small random shop tables with the awkward cases the given tables lack.

Duplicate accounts and category codes, NULL dates, keys and couriers, refunds,
one user, order number and shipment with a third of all rows.
"""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import duckdb
import pandas as pd

from tillgrid.functions import codes
from tillgrid.plans.dashboard import Settings, monthly_settings, weekly_settings
from tillgrid.sources.tables import SCHEMAS, read_parquet_tables

CATEGORIES = ("bakery", "cafe", "pub")
SETTINGS: dict[str, Settings] = {
    "weekly": weekly_settings(
        2025, "2025-08-08", "2024-12-30", point_periods=range(1, 33), categories=CATEGORIES
    ),
    "monthly": monthly_settings(
        2025, "2025-08-08", point_periods=range(1, 9), categories=CATEGORIES
    ),
}


def shop_rows(seed: int, size: int) -> dict[str, list[tuple]]:
    rng = random.Random(seed)
    users = max(size // 10, 5)

    def some(value, share_of_null=0.05):
        return None if rng.random() < share_of_null else value

    def hot(count):
        return 1 if rng.random() < 1 / 3 else rng.randrange(count)

    def moment(spread_days=400):
        start = datetime(2024, 11, 1)
        return start + timedelta(minutes=rng.randrange(spread_days * 1440))

    accounts = [
        (
            rng.randrange(users) if rng.random() < 0.2 else user,
            some(moment()),
            some(rng.choice(["#A", "u1", "u-1", "-"])),
            rng.choice("nnny"),
            some(f"company {rng.randrange(users // 2 + 1)}"),
        )
        for user in range(users)
    ]
    base_users = [(user,) for user in range(users - 1)] + [(1,), (2,)]
    shipments = [
        (
            number,
            some(hot(users + 2)),
            some(f"ON{hot(size // 4 + 1)}"),
            some(rng.choice([*codes.SHIPMENT_STATUS, *codes.SHIPPED_STATUSES, "NEW"])),
            some(rng.choice(["SFN", "POST"])),
            some(moment().replace(hour=0, minute=0)),
            rng.randrange(0, 5000),
        )
        for number in range(size)
    ]
    items = [
        (
            hot(size + 5),
            some(rng.choice([*codes.ITEM_STATUS, "ORDER", "ORDER", "ORDER"])),
            some(rng.choice(["TAX", "FREE"])),
            (price := rng.randrange(100, 150_000)),
            price + rng.randrange(-500, 2_000),
            rng.randrange(1, 4),
            rng.randrange(1_000, 90_000),
            rng.randrange(0, 3_000),
            rng.randrange(0, 300_000) if rng.random() < 0.05 else 100,
            int(rng.random() < 0.1),
            some(moment(430)),
        )
        for _ in range(size * 4)
    ]
    points = [
        (
            some(hot(users + 2)),
            some(rng.choice([*codes.POINT_EVENT, "REWARD", "REWARD"])),
            some(rng.choice([*codes.POINT_REASON, "NEW"])),
            rng.randrange(1, 10_000),
            some(moment()),
        )
        for _ in range(size * 3)
    ]
    category_codes = [
        (rng.randrange(users + 2), 1 if rng.random() < 1 / 3 else rng.randrange(5))
        for _ in range(users * 2)
    ]
    return {
        "user_account": accounts,
        "base_user": base_users,
        "shipment": shipments,
        "shipment_item": items,
        "point": points,
        "user_business_type_code": category_codes,
        "business_type": [(0, "bakery"), (1, "cafe"), (2, "pub"), (3, "other"), (4, "cafe")],
    }


def spark_tables(spark, rows: dict[str, list[tuple]], folder: str) -> dict:
    for name, values in rows.items():
        spark.createDataFrame(values, SCHEMAS[name]).write.parquet(f"{folder}/{name}")
    return read_parquet_tables(spark, folder, rows)


def duck_tables(rows: dict[str, list[tuple]]) -> duckdb.DuckDBPyConnection:
    types = {"bigint": "bigint", "int": "int", "string": "varchar", "timestamp": "timestamp"}
    connection = duckdb.connect()
    for name, values in rows.items():
        fields = SCHEMAS[name].fields
        columns = ", ".join(f"{f.name} {types[f.dataType.simpleString()]}" for f in fields)
        connection.execute(f"create table {name} ({columns})")
        frame = pd.DataFrame(values, columns=[f.name for f in fields], dtype=object)
        marks = ", ".join("?" * len(fields))
        connection.executemany(f"insert into {name} values ({marks})", frame.values.tolist())
    return connection
