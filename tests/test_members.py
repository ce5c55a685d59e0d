"""Sign-ups, daily counts, snapshots and growth on hand-made rows."""

from datetime import datetime

from tillgrid.functions import codes
from tillgrid.operators.members import (
    member_growth,
    member_snapshot,
    new_members,
    requests,
    signups,
)
from tillgrid.sources.tables import SCHEMAS


def frame(spark, table, rows):
    return spark.createDataFrame(rows, SCHEMAS[table])


def as_set(df):
    return {tuple(row) for row in df.collect()}


def test_signups_differ_by_grain_in_the_friend_pattern(spark):
    day = datetime(2025, 2, 3, 12)
    users = frame(
        spark,
        "user_account",
        [
            (1, day, "#A1", "n", None),
            (2, day, "u1", "n", None),
            (3, day, "u-1", "n", None),
            (4, day, None, "n", None),
            (5, day, "u1", "y", None),
            (6, day, "u1", None, None),
            (7, None, "u1", "n", None),
            (8, datetime(2024, 2, 3), "u1", "n", None),
            (9, datetime(2025, 12, 31), "u1", "n", None),
        ],
    )
    agency, friend = codes.AGENCY_REFERRAL, codes.FRIEND_REFERRAL
    assert as_set(signups(users, "week", 2025, 32, True)) == {(6, agency, 1), (6, friend, 1)}
    assert as_set(signups(users, "month", 2025, 8, False)) == {(2, agency, 1), (2, friend, 2)}


DAILY = [
    ("2025-01-05 00:00:00", "DAILY", 1, 10, 4, 6),
    ("2025-01-06 00:00:00", "DAILY", 2, 12, 5, 7),
    ("2025-01-12 00:00:00", "DAILY", 3, 15, 6, 9),
    ("2025-01-12 00:00:00", "MONTHLY", 9, 99, 99, 99),
    ("2025-01-30 00:00:00", "DAILY", 4, 30, 11, 19),
    ("2024-01-30 00:00:00", "DAILY", 5, 5, 5, 5),
    ("2025-12-30 00:00:00", "DAILY", 6, 60, 30, 30),
    ("not a date", "DAILY", 7, 70, 70, 70),
    (None, "DAILY", 8, 80, 80, 80),
]


def test_new_members(spark):
    daily = frame(spark, "dashboard_user", DAILY)
    assert as_set(new_members(daily, "week", 2025, 32)) == {(1, 1), (2, 5), (5, 4)}
    assert as_set(new_members(daily, "month", 2025, 8)) == {(1, 10)}


def test_snapshot_is_the_last_of_the_period(spark):
    daily = frame(spark, "dashboard_user", DAILY)
    assert as_set(member_snapshot(daily, "week", 2025, 32)) == {
        (1, 10, 4, 6),
        (2, 15, 6, 9),
        (5, 30, 11, 19),
    }
    assert as_set(member_snapshot(daily, "month", 2025, 8)) == {(1, 30, 11, 19)}


def test_growth_after_a_gap_is_the_whole_count(spark):
    daily = frame(spark, "dashboard_user", DAILY)
    growth = member_growth(member_snapshot(daily, "week", 2025, 32))
    assert as_set(growth) == {(2, 5, 2, 3), (5, 30, 11, 19)}


def test_week_zero_and_one_are_no_growth_rows(spark):
    daily = frame(
        spark,
        "dashboard_user",
        [
            ("2023-01-01 00:00:00", "DAILY", 1, 1, 1, 0),
            ("2023-01-08 00:00:00", "DAILY", 1, 4, 2, 2),
            ("2023-01-15 00:00:00", "DAILY", 1, 9, 4, 5),
        ],
    )
    snapshot = member_snapshot(daily, "week", 2023, 32)
    assert {row.period for row in snapshot.collect()} == {0, 1, 2}
    assert as_set(member_growth(snapshot)) == {(2, 5, 2, 3)}


def test_requests_from_timestamps_and_from_text(spark):
    rows = [
        (datetime(2025, 1, 6, 23, 59), 0),
        (datetime(2025, 1, 12), 0),
        (datetime(2025, 1, 12), 1),
        (datetime(2025, 1, 12), None),
        (None, 0),
        (datetime(2026, 1, 12), 0),
    ]
    shipping = frame(spark, "direct_shipping", rows)
    text = shipping.withColumn("created_at", shipping["created_at"].cast("string"))
    for table in (shipping, text):
        assert as_set(requests(table, "week", 2025, 32)) == {(2, 2)}
        assert as_set(requests(table, "month", 2025, 8)) == {(1, 2)}


def test_growth_of_missing_counts(spark):
    snapshot = spark.createDataFrame(
        [(2, 10, None, 1), (3, None, 4, 2), (4, 7, 5, None)],
        "period int, ok_total_count long, ok_direct_count long, ok_parcel_count long",
    )
    assert as_set(member_growth(snapshot)) == {(2, 10, None, 1), (3, None, 4, 1), (4, 7, 1, None)}
