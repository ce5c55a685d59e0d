"""Single rules of the sales, basket and point reports, each on a few rows."""

from datetime import datetime

import pytest

from tillgrid.functions import codes
from tillgrid.operators import baskets, buyers, points, sales
from tillgrid.operators.shipments import shipment_rollup, shipped_orders
from tillgrid.sources.tables import SCHEMAS

MARCH = datetime(2025, 3, 4)


def frame(spark, table, rows):
    return spark.createDataFrame(rows, SCHEMAS[table])


def shipment(number, user=1, order="ON1", status="SHIPPING", courier="SFN", day=MARCH, fee=0):
    return (number, user, order, status, courier, day, fee)


def item(number, price=1000, day=MARCH, status="ORDER", tax="FREE", deleted=0, quantity=1):
    return (number, status, tax, price, price, quantity, price, 0, 0, deleted, day)


def delivery_rows(spark, shipments, items, users=((1,), (2,)), by_company=False):
    accounts = [(user[0], None, None, "n", user[-1] if by_company else None) for user in users]
    orders = frame(spark, "shipment", shipments)
    lines = sales.sales_lines(
        shipment_rollup(frame(spark, "shipment_item", items), "week"),
        shipped_orders(orders, "2025-01-01", "2025-08-08"),
        buyers.buyers(
            orders,
            frame(spark, "user_account", accounts),
            frame(spark, "base_user", [(1,), (2,)]),
            by_company,
        ),
    )
    return {
        (row.period, row.delivery_type): row.asDict()
        for row in sales.sales_by_delivery(lines).collect()
    }


def test_first_order_flags(spark):
    early, late = datetime(2025, 1, 1), datetime(2025, 2, 1)
    table = frame(
        spark,
        "shipment",
        [
            shipment(1, user=1, status="CANCEL", day=early),
            shipment(2, user=1, status="PAYMENT", day=late),
            shipment(3, user=2, status="SHIPPING", day=early),
            shipment(4, user=2, status="SHIPPING", day=early),
            shipment(5, user=2, status="SHIPPING", day=late),
            shipment(6, user=2, status="CANCEL", day=None),
            shipment(7, user=3, status="DELETE", day=late),
            shipment(8, user=None, status="SHIPPING", day=late),
        ],
    )
    flags = {row.id: row.first_order for row in buyers.first_order(table).collect()}
    assert flags == {1: "O", 2: "O", 3: "O", 4: "O", 5: "X", 6: "O", 7: "O", 8: "O"}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [3, 1000])
def test_spread_join_is_a_join(spark, monkeypatch, how, limit):
    monkeypatch.setattr(buyers, "ROWS_PER_PART", limit)
    facts = spark.sql(
        "select id, if(id % 3 = 0, 1, if(id % 7 = 0, null, id % 20)) as key from range(200)"
    )
    per_key = spark.sql("select id as key, id * n as x from range(15) join values 1, 2 t(n)")
    joined = buyers.spread_join(facts, per_key, "key", spread_by="id", how=how)
    plain = facts.join(per_key, "key", how)
    assert joined.columns == plain.columns
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))


def test_hot_users_are_split_evenly(spark, monkeypatch):
    monkeypatch.setattr(buyers, "ROWS_PER_PART", 100)
    facts = spark.sql("select id, if(id % 3 = 0, 1, id) as key from range(3000)")
    per_key = spark.sql("select id as key from range(3000)")
    split, repeated = buyers.split_hot_keys(facts, per_key, "key", "id")
    sizes = split.filter("key = 1").groupBy("_part").count().collect()
    assert len(sizes) == 11 and max(row["count"] for row in sizes) < 200
    assert repeated.groupBy("key").count().filter("count > 1").collect() == [(1, 11)]


def test_fee_counts_per_item_line(spark):
    rows = delivery_rows(spark, [shipment(1, fee=1100)], [item(1), item(1), item(1)])
    row = rows[(10, codes.DIRECT)]
    assert (row["delivery_price"], row["orders"], row["orders_sku"]) == (3000, 1, 3)


def test_no_entering_date_no_row(spark):
    assert delivery_rows(spark, [shipment(1)], [item(1, day=None)]) == {}


def test_years_of_a_week_number_are_added(spark):
    days = [datetime(2025, 3, 4), datetime(2026, 3, 3)]
    rows = delivery_rows(spark, [shipment(1)], [item(1, day=day) for day in days])
    assert rows[(10, codes.DIRECT)]["orders"] == 2
    assert rows[(10, codes.DIRECT)]["buyers"] == 2


def test_counts_of_two_statuses_are_added(spark):
    shipments = [shipment(1), shipment(2, status="SHIPPING_COMPLETE")]
    rows = delivery_rows(spark, shipments, [item(1), item(2)])
    assert rows[(10, codes.DIRECT)]["orders"] == 2
    assert rows[(10, codes.DIRECT)]["first_order_users"] == 2


def test_two_accounts_double_sums_but_not_counts(spark):
    rows = delivery_rows(spark, [shipment(1)], [item(1)], users=[(1,), (1,)])
    row = rows[(10, codes.DIRECT)]
    assert (row["supply_price"], row["orders_sku"]) == (2000, 2)
    assert (row["orders"], row["buyers"]) == (1, 1)


def test_buyers_by_company(spark):
    shipments = [shipment(1, user=1), shipment(2, user=2, order="ON2")]
    users = [(1, "same"), (2, "same")]
    by_user = delivery_rows(spark, shipments, [item(1), item(2)], users)
    by_company = delivery_rows(spark, shipments, [item(1), item(2)], users, by_company=True)
    assert by_user[(10, codes.DIRECT)]["buyers"] == 2
    assert by_company[(10, codes.DIRECT)]["buyers"] == 1


@pytest.mark.parametrize(
    "shipments, items",
    [
        ([shipment(1, status="PENDING")], [item(1)]),
        ([shipment(1, status=None)], [item(1)]),
        ([shipment(1, user=9)], [item(1)]),
        ([shipment(1, day=datetime(2025, 8, 9))], [item(1)]),
        ([shipment(1)], [item(1, status="CANCEL")]),
        ([shipment(1)], [item(1, deleted=1)]),
        ([shipment(1)], [item(2)]),
    ],
)
def test_rows_that_do_not_count(spark, shipments, items):
    assert delivery_rows(spark, shipments, items) == {}


def basket_table(spark, shipments, items):
    return baskets.baskets(
        shipment_rollup(frame(spark, "shipment_item", items), "week"),
        shipped_orders(frame(spark, "shipment", shipments), "2025-01-01", "2025-08-08"),
    )


def test_band_denominator_spans_both_delivery_types(spark):
    rows = basket_table(
        spark,
        [shipment(1), shipment(2, order="ON2"), shipment(3, order="ON3", courier="POST")],
        [item(1, 100_000), item(2, 300_000), item(3, 100_000)],
    )
    shown = {row.delivery_type: row for row in baskets.basket_bands(rows).collect()}
    assert shown[codes.DIRECT].under_150k == "33.3%(20.0%)"
    assert shown[codes.DIRECT].from_300k == "33.3%(60.0%)"
    assert shown[codes.PARCEL].under_150k == "33.3%(20.0%)"
    assert shown[codes.PARCEL].from_300k is None


def test_total_bands_merge_the_delivery_types_of_an_order(spark):
    rows = basket_table(
        spark, [shipment(1), shipment(2, courier="POST")], [item(1, 100_000), item(2, 100_000)]
    )
    (total,) = baskets.basket_bands_total(rows).collect()
    assert total.from_200k == "100.0%(100.0%)"
    by_type = baskets.basket_bands(rows).collect()
    assert [row.under_150k for row in by_type] == ["50.0%(50.0%)"] * 2


def test_periods_without_a_date_keep_their_band_row(spark):
    rows = basket_table(spark, [shipment(1)], [item(1, day=None)])
    (only,) = baskets.basket_bands(rows).collect()
    assert (only.entering_year, only.period, only.under_150k) == (None, None, "100.0%(100.0%)")


def point_rows(spark, rows, periods=(10,)):
    return points.point_share(
        frame(spark, "point", rows),
        frame(spark, "user_account", [(1, None, None, "n", None), (2, None, None, "n", None)]),
        frame(spark, "base_user", [(1,), (2,)]),
        "week",
        2025,
        periods,
    )


def test_share_is_of_all_reasons_and_rounded_before_adding(spark):
    shares = point_rows(
        spark,
        [
            (1, "REWARD", "REFERRAL_MEMBER", 105, MARCH),
            (2, "REWARD", "FIRST_ORDER_REFERRED", 105, MARCH),
            (1, "REWARD", "ORDER", 790, MARCH),
            (1, "USED", "JOINED", 500, MARCH),
            (7, "REWARD", "JOINED", 500, MARCH),
        ],
    )
    (row,) = shares.collect()
    # 0.105 rounds to 0.11 twice; adding first would give 0.21.
    assert (row.reason, float(row.share), row.reason_rank) == (codes.REFERRAL, 0.22, 3)


def test_missing_reasons_are_zero_only_where_one_is_there(spark):
    shares = point_rows(
        spark,
        [
            (1, "REWARD", "JOINED", 100, MARCH),
            (1, "REWARD", "ORDER", 100, datetime(2025, 3, 11)),
        ],
        periods=(10, 11, 12),
    )
    filled = points.point_share_filled(shares).collect()
    assert {(row.period, row.reason, float(row.share)) for row in filled} == {
        (10, codes.FIRST_ORDER_REASON, 0.0),
        (10, codes.JOINED_REASON, 1.0),
        (10, codes.REFERRAL, 0.0),
    }


def test_missing_parts_of_a_row_leave_the_others_of_its_basket(spark):
    rollup = spark.createDataFrame(
        [(1, 2025, 5, 100_000, None, 0, 1), (2, 2025, 5, 100_000, 0, None, 1), (3, 2025, 5, 400_000, 0, 0, 1)],
        "shipment_id long, entering_year int, period int, gross long, point long, coupon long, item_lines long",
    )
    orders = spark.createDataFrame(
        [(1, "A", "d", None), (2, "A", "d", 0), (3, "B", "d", 0)],
        "shipment_id long, order_number string, delivery_type string, delivery_fee long",
    )
    rows = baskets.baskets(rollup, orders)
    for bands in (baskets.basket_bands(rows), baskets.basket_bands_total(rows)):
        texts = {text for text in bands.first()[2:] if text and "%(" in text}
        assert texts == {"50.0%(33.3%)", "50.0%(66.7%)"}
