"""Stored first orders after changes, and days in periods, against plain ways."""

import random
from datetime import date, datetime, timedelta

import pytest

from conftest import plan_of
from tillgrid.functions import codes
from tillgrid.operators import buyers, intervals
from tillgrid.sources.tables import SCHEMAS

STATUSES = [*codes.VALID_ORDER_STATUSES, "CANCEL", "DELETE", None]


def first_orders(rows):
    found = {}
    for row in rows.values():
        if row[3] in codes.VALID_ORDER_STATUSES:
            first, count = found.get(row[1], (None, 0))
            days = [day for day in (first, row[5]) if day is not None]
            found[row[1]] = (min(days, default=None), count + 1)
    return found


@pytest.mark.parametrize("seed", range(4))
def test_first_orders_follow_random_changes(spark, seed):
    draw = random.Random(seed)

    def shipment(number):
        user = draw.choice([None, 1, 1, *range(25)])
        day = draw.choice([None, *[datetime(2025, 1, 1) + timedelta(days=draw.randrange(30)) for _ in range(9)]])
        return (number, user, "ON", draw.choice(STATUSES), "POST", day, 0)

    def table(rows):
        return spark.createDataFrame(list(rows), SCHEMAS["shipment"])

    now = {number: shipment(number) for number in range(150)}
    stored = buyers.first_valid_orders(table(now.values()))
    for _ in range(2):
        changed = draw.sample(sorted(now), 40)
        removed = [now[number] for number in changed]
        for number in changed[:10]:
            del now[number]
        for number in changed[10:]:
            now[number] = (*now[number][:3], draw.choice(STATUSES), *now[number][4:]) if draw.random() < 0.7 else shipment(number)
        new = [number + 1 + max(now) for number in range(15)]
        now |= {number: shipment(number) for number in new}
        added = [now[number] for number in [*changed[10:], *new]]
        stored = buyers.updated_first_orders(stored, table(removed), table(added), table(now.values()))
        found = {row.user_id: (row.first_valid_at, row.valid_orders) for row in stored.collect()}
        assert found == first_orders(now)


def test_first_orders_without_changes_or_rows(spark):
    none = spark.createDataFrame([], SCHEMAS["shipment"])
    stored = buyers.first_valid_orders(none)
    assert buyers.updated_first_orders(stored, none, none, none).count() == 0
    one = spark.createDataFrame([(1, 1, "ON", "PAYMENT", "POST", datetime(2025, 1, 1), 0)], SCHEMAS["shipment"])
    held = buyers.first_valid_orders(one)
    assert buyers.updated_first_orders(held, none, none, one).collect() == held.collect()
    assert buyers.updated_first_orders(held, one, none, none).count() == 0


def test_days_in_periods(spark):
    draw = random.Random(3)
    start = date(2024, 12, 1)

    def day(spread=900):
        return None if draw.random() < 0.05 else start + timedelta(days=draw.randrange(-spread, spread))

    rows = [(n, day()) for n in range(300)] + [(300, date(1969, 12, 31)), (301, date(1, 1, 1))]
    periods = [(n, first, first and draw.choice([first, first + timedelta(days=draw.randrange(-5, 400)), None]))
               for n in range(150) for first in [day()]]
    periods += [(500, date(1, 1, 1), date(9999, 12, 31)), (500, date(1, 1, 1), date(9999, 12, 31)), (501, start, start)]
    wanted = sorted((r, p) for r, d in rows for p, a, b in periods if d and a and b and a <= d <= b)
    found = intervals.in_periods(
        spark.createDataFrame(rows, "row_id int, day date"), "day", spark.createDataFrame(periods, "period int, a date, b date"), "a", "b"
    )
    assert len(wanted) > 1000 and found.columns == ["row_id", "day", "period", "a", "b"]
    assert sorted((row.row_id, row.period) for row in found.collect()) == wanted


def test_many_periods_need_no_nested_loop(spark):
    day = "date_add(date'2020-01-01', cast(id % 1500 as int))"
    periods = spark.range(100_000).selectExpr("id as period", f"{day} as a", f"date_add({day}, cast(id % 37 as int)) as b")
    events = spark.range(200_000).selectExpr("id as event", f"{day} as day")
    found = intervals.in_periods(events, "day", periods, "a", "b").groupBy("day").count()
    plan = plan_of(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    by_day = {row.day: row["count"] for row in found.collect()}
    first = date(2020, 1, 1)
    starts = [(n % 1500, n % 1500 + n % 37) for n in range(100_000)]
    for at in (0, 700, 1499):
        inside = sum(a <= at <= b for a, b in starts)
        events_then = sum(n % 1500 == at for n in range(200_000))
        assert by_day[first + timedelta(days=at)] == inside * events_then


def test_no_periods(spark):
    none = spark.createDataFrame([], "period int, a date, b date")
    rows = spark.createDataFrame([(1, date(2025, 1, 1))], "row_id int, day date")
    assert intervals.in_periods(rows, "day", none, "a", "b").count() == 0
