"""Physical plans: what is pushed to the scan, combined, broadcast or shuffled."""

import re
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import shop
from conftest import plan_of
from tillgrid.operators import buyers, shipments
from tillgrid.plans import dashboard, queries
from tillgrid.sources.tables import SCHEMAS, as_declared, jdbc_options

@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows = shop.shop_rows(5, size=60)
    return shop.spark_tables(spark, rows, str(tmp_path_factory.mktemp("shop")))


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are when no table is small."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    yield
    spark.conf.set(setting, before)


def scan(plan: str, column: str) -> str:
    blocks = [block for block in plan.split("\n\n") if "Scan parquet" in block]
    return next(block for block in blocks if re.search(rf"struct<.*\b{column}:", block))


def test_filters_and_columns_reach_the_scans(tables, no_broadcast):
    at = shop.SETTINGS["weekly"]
    plan = plan_of(dashboard.delivery_sales(tables, at, dashboard.rollup_of(tables, at)))
    items = scan(plan, "shipment_id")
    assert "EqualTo(is_deleted,0)" in items and "EqualTo(item_status,ORDER)" in items
    assert "supply_price" not in items
    orders = scan(plan, "delivery_price")
    assert "GreaterThanOrEqual(order_dated_at,2025-01-01" in orders
    assert "LessThan(order_dated_at,2025-08-09" in orders
    assert "In(status, [READY_SHIPMENT,SHIPPING,SHIPPING_COMPLETE])" in orders


def test_items_are_combined_before_their_first_shuffle(tables, no_broadcast):
    at = shop.SETTINGS["weekly"]
    plan = plan_of(dashboard.basket_rows(tables, at, dashboard.rollup_of(tables, at)))
    tree = plan.split("\n\n")[0].splitlines()
    place = next(n for n, line in enumerate(tree) if "Scan parquet" in line)
    above = [re.sub(r"[^A-Za-z]", "", line) for line in tree[:place]]
    aggregate = max(n for n, name in enumerate(above) if name == "HashAggregate")
    shuffle = max(n for n, name in enumerate(above) if name == "Exchange")
    assert aggregate > shuffle


def test_buyers_are_joined_by_user_and_part(tables, no_broadcast):
    plan = plan_of(buyers.first_order(tables["shipment"]))
    assert re.search(r"SortMergeJoin.*\nLeft keys \[2\]: \[user_id#\d+L, _part#\d+\]", plan)
    assert "Window" not in plan


def test_tables_bucketed_by_shipment_need_no_shuffle_up_to_the_join(spark, tables, no_broadcast):
    bucketed = dict(tables)
    for name, key in (("shipment_item", "shipment_id"), ("shipment", "id")):
        table = f"bucketed_{name}"
        tables[name].write.bucketBy(4, key).mode("overwrite").saveAsTable(table)
        bucketed[name] = spark.table(table)
    at = shop.SETTINGS["weekly"]
    try:
        rows = dashboard.basket_rows(bucketed, at, dashboard.rollup_of(bucketed, at))
        plan = plan_of(rows)
        assert "SortMergeJoin" in plan
        assert re.findall(r"Arguments: hashpartitioning\((\w+)#", plan) == ["entering_year"]
    finally:
        for name in ("shipment_item", "shipment"):
            spark.sql(f"drop table bucketed_{name}")


def test_jdbc_options():
    options = jdbc_options(
        "jdbc:x", "shipment", {"user": "u"}, "order_dated_at", "2025-01-01", "2025-09-01", 64
    )
    assert options == {
        "url": "jdbc:x",
        "dbtable": "shipment",
        "fetchsize": "10000",
        "user": "u",
        "partitionColumn": "order_dated_at",
        "lowerBound": "2025-01-01",
        "upperBound": "2025-09-01",
        "numPartitions": "64",
    }
    assert "partitionColumn" not in jdbc_options("jdbc:x", "business_type", {}, one_task=True)
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "shipment", {}, partition_column="id")


BLOOM = "spark.sql.optimizer.runtime.bloomFilter"


@pytest.mark.parametrize("build", [
    lambda t, at: dashboard.delivery_sales(t, at, dashboard.rollup_of(t, at)),
    lambda t, at: dashboard.basket_rows(t, at, dashboard.rollup_of(t, at)),
    dashboard.pruned_rollup,
])
def test_items_are_filtered_by_the_shipments_in_range(spark, tables, no_broadcast, build):
    size = f"{BLOOM}.applicationSideScanSizeThreshold"
    before = spark.conf.get(size)
    spark.conf.set(size, "0")
    try:
        tree = plan_of(build(tables, shop.SETTINGS["weekly"]))
    finally:
        spark.conf.set(size, before)
    tests = [block for block in tree.split("\n\n") if "might_contain" in block and "Filter" in block]
    assert any("item_status" in block or "is_deleted" in block for block in tests)


def test_the_pruned_rollup_gives_the_same_reports(spark, tables):
    at = shop.SETTINGS["weekly"]
    whole, pruned = dashboard.rollup_of(tables, at), dashboard.pruned_rollup(tables, at)
    assert pruned.count() < whole.count()
    for build in (dashboard.delivery_sales, dashboard.basket_rows):
        first, second = (sorted(map(str, build(tables, at, rollup).collect())) for rollup in (whole, pruned))
        assert first == second


def test_stored_tables_go_and_need_a_shared_folder(spark):
    with dashboard.stored(spark.range(3), "x") as df:
        path = df.inputFiles()[0].rsplit("/", 1)[0]
        assert df.count() == 3
    assert not Path(path.removeprefix("file:").replace("///", "/")).exists()
    bare = SimpleNamespace(sparkSession=SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None)))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"), dashboard.stored(bare, "x"):
        pass


def test_building_a_report_starts_no_job(spark, tables):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    for build in (queries._report_cells, queries._report_cells_category):
        build({**tables, **MEMBERS(spark)}, shop.SETTINGS["weekly"])
    assert list(tracker.getJobIdsForGroup("building")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def MEMBERS(spark):
    return {
        name: spark.createDataFrame([], SCHEMAS[name]) for name in ("dashboard_user", "direct_shipping")
    } | {"ads": spark.createDataFrame([], "date string, total_signups double, total_cost double, "
                                      "total_conversions double, total_roas double")}


def test_tables_of_a_database_get_their_declared_types(spark):
    read = spark.createDataFrame(
        [(True, "2025-01-02 03:04:05"), (False, None), (None, None)], "is_deleted boolean, created_at string"
    )
    typed = as_declared(read, "direct_shipping")
    assert typed.schema == SCHEMAS["direct_shipping"] or typed.dtypes == [("created_at", "timestamp"), ("is_deleted", "int")]
    assert [row.is_deleted for row in typed.collect()] == [1, 0, None]
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", {})
    assert "partitionColumn" not in jdbc_options("jdbc:x", "t", {}, one_task=True)


def scans_of(plan: str, column: str) -> int:
    """Files read for a table, told by one of its columns; what is reused is read once."""
    return sum(bool(re.search(rf"struct<.*\b{column}:", block)) for block in plan.split("\n\n") if "Scan parquet" in block)


@pytest.mark.parametrize("grain", ["weekly", "monthly"])
def test_sales_have_no_expand(tables, no_broadcast, grain):
    at = shop.SETTINGS[grain]
    for build in (dashboard.delivery_sales, dashboard.total_sales, dashboard.category_sales):
        for facts in (dashboard.facts_of(tables, at), dashboard.rollup_of(tables, at)):
            assert "Expand" not in plan_of(build(tables, at, facts))


def test_a_dashboard_reads_shipments_twice_and_items_once(spark, tables, monkeypatch):
    """All that reads the given tables for sales and baskets is what gets stored."""
    at = shop.SETTINGS["weekly"]
    stored = [plan_of(dashboard.facts_of(tables, at)), plan_of(buyers.first_valid_orders(tables["shipment"]))]
    assert sum(scans_of(plan, "order_dated_at") for plan in stored) == 2
    assert sum(scans_of(plan, "item_status") for plan in stored) == 1
    with dashboard.stored(dashboard.facts_of(tables, at), "facts") as facts, dashboard.stored(
        buyers.first_valid_orders(tables["shipment"]), "first"
    ) as first:
        known = {**tables, dashboard.FIRST_ORDERS: first}
        for build in (dashboard.sales_cells, dashboard.report_cells_category):
            plan = plan_of(build(known, at, facts))
            assert scans_of(plan, "item_status") == scans_of(plan, "courier") == 0


def test_both_grains_read_items_once_and_combine_before_the_shuffle(tables, no_broadcast):
    at = shop.SETTINGS["weekly"]
    daily = shipments.daily_rollup(tables["shipment_item"])
    plan = plan_of(shipments.order_facts_of_grains(daily, dashboard.orders_in_range(tables, at)))
    assert scans_of(plan, "item_status") == scans_of(plan, "courier") == 1
    assert plan.count(") Expand") == 1


def test_facts_and_rollup_give_the_same_reports(tables, monkeypatch):
    monkeypatch.setattr(buyers, "ROWS_PER_PART", 5)
    daily = shipments.daily_rollup(tables["shipment_item"])
    known = {**tables, dashboard.FIRST_ORDERS: buyers.first_valid_orders(tables["shipment"])}
    for at in shop.SETTINGS.values():
        both = shipments.order_facts_of_grains(daily, dashboard.orders_in_range(tables, at))
        own = both.filter(F.col("grain") == at.grain).drop("grain")
        for build in (dashboard.delivery_sales, dashboard.total_sales, dashboard.category_sales, dashboard.basket_rows):
            wanted = build(tables, at, dashboard.rollup_of(tables, at))
            for facts in (own, dashboard.facts_of(tables, at)):
                found = build(known, at, facts).select(*wanted.columns)
                assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
