"""Operators against the reports' definitions on awkward random tables."""

from collections import Counter

import pytest

import shop
from tillgrid.operators import baskets, buyers, points
from tillgrid.plans import dashboard, oracles

SEEDS = [1, 2]
GRAINS = ["weekly", "monthly"]


@pytest.fixture(scope="module", params=SEEDS)
def both(spark, request, tmp_path_factory):
    rows = shop.shop_rows(request.param, size=300)
    folder = str(tmp_path_factory.mktemp("shop"))
    return shop.spark_tables(spark, rows, folder), shop.duck_tables(rows)


@pytest.fixture(autouse=True)
def low_hot_limit(monkeypatch):
    """Spread the hot users and categories of the small tables too."""
    monkeypatch.setattr(buyers, "ROWS_PER_PART", 20)


def counted(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(
        tuple(float(v) if not isinstance(v, str | None) else v for v in (row[i] for i in order))
        for row in rows
    )


def assert_same(result, duck, sql):
    expected = duck.sql(sql)
    assert sorted(result.columns) == sorted(expected.columns)
    wanted = counted(expected.fetchall(), expected.columns)
    assert sum(wanted.values()) > 0
    assert counted(result.collect(), result.columns) == wanted


@pytest.mark.parametrize("grain", GRAINS)
def test_sales_by_delivery(both, grain):
    tables, duck = both
    at = shop.SETTINGS[grain]
    result = dashboard.delivery_sales(tables, at, dashboard.rollup_of(tables, at))
    assert_same(result, duck, oracles.sales_by_delivery(at))


@pytest.mark.parametrize("grain", GRAINS)
def test_sales_by_category(both, grain):
    tables, duck = both
    at = shop.SETTINGS[grain]
    result = dashboard.category_sales(tables, at, dashboard.rollup_of(tables, at))
    assert_same(result, duck, oracles.sales_by_category(at))


@pytest.mark.parametrize("grain", GRAINS)
def test_sales_total(both, grain):
    tables, duck = both
    at = shop.SETTINGS[grain]
    result = dashboard.total_sales(tables, at, dashboard.rollup_of(tables, at))
    assert_same(result, duck, oracles.sales_total(at))


@pytest.mark.parametrize("grain", GRAINS)
def test_basket_bands(both, grain):
    tables, duck = both
    at = shop.SETTINGS[grain]
    rows = dashboard.basket_rows(tables, at, dashboard.rollup_of(tables, at))
    assert_same(baskets.basket_bands(rows), duck, oracles.basket_bands(at))
    assert_same(baskets.basket_bands_total(rows), duck, oracles.basket_bands_total(at))
    merged = dashboard.basket_rows(tables, at, dashboard.rollup_of(tables, at), by_delivery=False)
    assert_same(baskets.basket_bands_total(merged), duck, oracles.basket_bands_total(at))


@pytest.mark.parametrize("grain", GRAINS)
def test_point_share(both, grain):
    tables, duck = both
    at = shop.SETTINGS[grain]
    shares = dashboard.point_shares(tables, at)
    assert_same(shares, duck, oracles.point_share(at))
    assert_same(points.point_share_filled(shares), duck, oracles.point_share_filled(at))


def test_first_order(both):
    tables, duck = both
    assert_same(buyers.first_order(tables["shipment"]), duck, oracles.first_order())


def test_decimal_and_double_amounts_give_the_same(both):
    tables, duck = both
    at = shop.SETTINGS["monthly"]
    amounts = ["price", "list_price", "coupon_discount_amount", "use_point", "supply_price"]
    for kind in ("decimal(12,2)", "double"):
        items = tables["shipment_item"]
        changed = {
            **tables,
            "shipment_item": items.withColumns(
                {name: items[name].cast(kind) for name in amounts}
            ),
            "shipment": tables["shipment"].withColumn(
                "delivery_price", tables["shipment"]["delivery_price"].cast(kind)
            ),
        }
        rollup = dashboard.rollup_of(changed, at)
        assert_same(
            dashboard.delivery_sales(changed, at, rollup), duck, oracles.sales_by_delivery(at)
        )
        rows = dashboard.basket_rows(changed, at, rollup)
        assert_same(baskets.basket_bands(rows), duck, oracles.basket_bands(at))


def test_string_dates_give_the_same(both):
    tables, duck = both
    at = shop.SETTINGS["weekly"]
    shipments, items = tables["shipment"], tables["shipment_item"]
    changed = {
        **tables,
        "shipment_item": items.withColumn(
            "entering_dated_at", items["entering_dated_at"].cast("string")
        ),
        "shipment": shipments.withColumn(
            "order_dated_at", shipments["order_dated_at"].cast("string")
        ),
    }
    result = dashboard.delivery_sales(changed, at, dashboard.rollup_of(changed, at))
    assert_same(result, duck, oracles.sales_by_delivery(at))


@pytest.mark.parametrize("grain", GRAINS)
def test_band_shares_of_a_period_add_up(both, grain):
    tables, _ = both
    at = shop.SETTINGS[grain]
    rows = baskets.basket_bands(
        dashboard.basket_rows(tables, at, dashboard.rollup_of(tables, at))
    ).collect()
    shares = {}
    for row in rows:
        texts = [text for text in row[3:] if text is not None]
        shares.setdefault((row.entering_year, row.period), []).extend(
            float(text.split("%")[0]) for text in texts
        )
    # A period whose orders have no number at all has no shares.
    sums = [sum(parts) for parts in shares.values() if parts]
    assert len(sums) >= 8
    assert all(abs(total - 100) <= 0.5 for total in sums)
