"""Placing, merging, storing and reading back report cells."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import shop
from tillgrid.functions import codes
from tillgrid.functions.a1 import column_letter
from tillgrid.operators import cells
from tillgrid.plans import dashboard, layouts
from tillgrid.sources import cell_store


def cell_rows(spark, rows):
    values = [(sheet, row, col, f"C{col}R{row}", value) for sheet, row, col, value in rows]
    return spark.createDataFrame(values, cell_store.CELL_SCHEMA)


def values(df):
    return {(row.sheet, row.row_no, row.col_no): row.value for row in df.collect()}


def test_layout_rows():
    places = layouts.main_layout("s")
    rows = [place[3] for place in places]
    assert len(rows) == len(set(rows))
    by_name = {(place[1], place[2]): place[3] for place in places}
    assert by_name[(codes.DIRECT, "under_150k")] == 47
    assert by_name[(codes.PARCEL, "from_300k")] == 77
    assert by_name[(layouts.TOTAL, "from_300k")] == 103
    category = layouts.category_layout("s", codes.BUSINESS_CATEGORIES)
    assert [place[3] for place in category if place[2] == "pg_supply_price"] == list(
        range(115, 206, 10)
    )
    assert max(place[3] for place in category) == 209


def test_only_placed_measures_of_emitted_periods(spark):
    layout = cells.layout_table(spark, [("s", "b", "x", 6, 1), ("s", "b", "never", 7, 1)])
    df = spark.createDataFrame(
        [(1, 10, 0), (2, 20, 0), (32, 30, 0), (33, 40, 0), (3, None, 0)],
        "period int, x bigint, y bigint",
    )
    placed = cells.place_cells(cells.measures_long(df, ["x", "y"], "b"), layout, 2, 32)
    assert {(row.a1, row.value) for row in placed.collect()} == {
        ("C6", "20"),
        ("AG6", "30"),
        ("D6", "0"),
    }


def test_numbers_are_cut_and_texts_stay(spark):
    df = spark.sql("select 1 as period, 2.9D as x, -2.9BD as y, '33.3%(1.0%)' as z")
    long = cells.measures_long(df, ["x", "y", "z"], "b")
    assert {(row.measure, row.value) for row in long.collect()} == {
        ("x", "2"),
        ("y", "-2"),
        ("z", "33.3%(1.0%)"),
    }


def test_earliest_year_wins(spark):
    df = spark.createDataFrame(
        [(2026, 5, "new"), (2025, 5, None), (2026, 6, "only")],
        "entering_year int, period int, x string",
    )
    assert {tuple(row) for row in cells.earliest_year(df).collect()} == {(5, None), (6, "only")}


def test_merge_overwrites_and_keeps(spark):
    old = cell_rows(spark, [("s", 1, 1, "9"), ("s", 1, 2, "2"), ("t", 1, 1, "3")])
    new = cell_rows(spark, [("s", 1, 1, "10"), ("s", 1, 3, "4")])
    once = cells.merge_cells(old, new)
    expected = {
        ("s", 1, 1): "10",
        ("s", 1, 2): "2",
        ("t", 1, 1): "3",
        ("s", 1, 3): "4",
    }
    assert values(once) == expected
    assert values(cells.merge_cells(once, new)) == expected


def test_store(spark, tmp_path):
    store = str(tmp_path / "cells")
    assert cell_store.read_cells(spark, store).count() == 0
    cell_store.upsert_cells(cell_rows(spark, [("s", 3, 2, "0.5"), ("s", 9, 2, "1")]), store)
    cell_store.upsert_cells(cell_rows(spark, [("s", 3, 2, "0.25")]), store)
    cell_store.upsert_cells(cell_rows(spark, [("s", 3, 2, "0.25")]), store)
    assert cell_store.latest_version(spark, store) == 3
    assert values(cell_store.read_cells(spark, store)) == {("s", 3, 2): "0.25", ("s", 9, 2): "1"}
    assert values(cell_store.read_range(spark, store, "s", (3, 5), (2, 2))) == {
        ("s", 3, 2): "0.25"
    }
    cell_store.replace_cells(cell_rows(spark, [("s", 1, 1, "x")]), store)
    assert values(cell_store.read_cells(spark, store)) == {("s", 1, 1): "x"}


def test_store_counts_complete_versions_only(spark, tmp_path):
    store = tmp_path / "cells [1]"
    cell_store.replace_cells(cell_rows(spark, [("s", 1, 1, "x")]), str(store))
    (store / "version=2").mkdir()
    (store / "version=2" / "part-0.parquet").write_bytes(b"half")
    assert values(cell_store.read_cells(spark, str(store))) == {("s", 1, 1): "x"}
    cell_store.upsert_cells(cell_rows(spark, [("s", 1, 2, "y")]), str(store))
    assert cell_store.latest_version(spark, str(store)) == 3
    assert values(cell_store.read_cells(spark, str(store))) == {("s", 1, 1): "x", ("s", 1, 2): "y"}


def test_store_is_emptied_and_keeps_few_versions(spark, tmp_path):
    store = tmp_path / "cells"
    for number in range(5):
        cell_store.replace_cells(cell_rows(spark, [("s", 1, 1, str(number))]), str(store))
    assert sorted(path.name for path in store.iterdir()) == ["version=3", "version=4", "version=5"]
    cell_store.replace_cells(cell_rows(spark, []), str(store))
    assert cell_store.read_cells(spark, str(store)).count() == 0
    cell_store.upsert_cells(cell_rows(spark, [("s", 1, 1, "new")]), str(store))
    assert values(cell_store.read_cells(spark, str(store))) == {("s", 1, 1): "new"}


def test_columns_without_letters_fail(spark):
    numbers = spark.createDataFrame([(1,), (27,), (702,)], "n int")
    assert [row[0] for row in numbers.select(column_letter(F.col("n"))).collect()] == ["A", "AA", "ZZ"]
    with pytest.raises(Exception, match="no letters for column 703"):
        spark.createDataFrame([(703,)], "n int").select(column_letter(F.col("n"))).collect()


def test_verify_adds_the_first_two_rows(spark):
    table = cell_rows(
        spark,
        [
            ("p", 3, 2, "0.21"),
            ("p", 4, 2, "0.30"),
            ("p", 5, 2, "0.05"),
            ("p", 4, 3, ""),
            ("p", 5, 3, "0.50"),
            ("p", 6, 2, "9"),
            ("q", 3, 2, "9"),
        ],
    )
    checked = cells.verify_points(table, "p", layouts.POINT_ROWS)
    assert {
        (row.col_no, float(row.first_order), float(row.referral), float(row.check_sum))
        for row in checked.collect()
    } == {(2, 0.21, 0.05, 0.51), (3, 0.0, 0.5, 0.0)}


def test_dashboard_is_written_once_and_again_without_change(spark, tmp_path):
    rows = shop.shop_rows(3, size=120)
    rows["dashboard_user"] = [
        (f"2025-0{month}-15 00:00:00", "DAILY", month, 10 * month, 4 * month, 6 * month)
        for month in range(1, 9)
    ]
    rows["direct_shipping"] = [(row[5], 0) for row in rows["shipment"] if row[5]]
    tables = shop.spark_tables(spark, rows, str(tmp_path / "tables"))
    tables["ads"] = spark.sql(
        "select '2025-03-04' as date, 5D as total_signups, 1000D as total_cost,"
        " 2D as total_conversions, 150D as total_roas"
    )
    at = shop.SETTINGS["monthly"]
    store = str(tmp_path / "cells")
    dashboard.write_dashboard(tables, at, store)
    first = values(cell_store.read_cells(spark, store))
    dashboard.write_dashboard(tables, at, store)
    assert values(cell_store.read_cells(spark, store)) == first
    sheet, points = at.sheet, at.point_sheet
    assert first[(sheet, 6, 2)] == "1"
    assert first[(sheet, 11, 9)] == "80"
    assert first[(sheet, 14, 9)] == "10"
    assert (sheet, 14, 2) not in first
    assert first[(sheet, 27, 4)] == "150"
    sales = {
        row.period: row.supply_price
        for row in dashboard.delivery_sales(tables, at, dashboard.rollup_of(tables, at))
        .filter(F.col("delivery_type") == codes.DIRECT)
        .collect()
    }
    for month in range(1, 9):
        assert first.get((sheet, 34, month + 1)) == (
            str(sales[month]) if month in sales else None
        )
    assert any(key[0] == sheet and 115 <= key[1] <= 139 for key in first)
    shown = {row.col_no: row for row in dashboard.check_points(spark, at, store).collect()}
    assert set(shown) <= {period - 7 + 2 for period in at.point_periods}
    assert {key[2] for key in first if key[0] == points} >= set(shown)
    assert {
        (points, row, column): f"{value:.2f}"
        for column, read in shown.items()
        for row, value in zip((3, 4, 5), (read.first_order, read.joined, read.referral))
    } == {key: value for key, value in first.items() if key[0] == points and key[2] in shown}
    assert shown


def test_comparison_finds_changed_lost_and_extra_cells(spark, tmp_path):
    store = str(tmp_path / "cells")
    before = [("s", 1, 1, "a"), ("s", 1, 2, None), ("s", 1, 3, "c"), ("s", 2, 1, None), (None, 3, 3, "n"), ("t", 1, 1, "x")]
    after = [("s", 1, 1, "a"), ("s", 1, 2, "b"), ("s", 2, 1, None), ("s", 2, 2, None), (None, 3, 3, "m"), ("t", 1, 1, None)]
    for rows in (before, after):
        cell_store.replace_cells(spark.createDataFrame([(*row[:3], "A1", row[3]) for row in rows], cell_store.CELL_SCHEMA), store)
    assert cell_store.complete_versions(spark, store) == [1, 2]
    found = {tuple(row) for row in cell_store.changes_of_last_write(spark, store).collect()}
    assert found == {
        ("s", 1, 2, "changed", None, "b"), ("s", 1, 3, "lost", "c", None), ("s", 2, 2, "extra", None, None),
        (None, 3, 3, "changed", "n", "m"), ("t", 1, 1, "changed", "x", None),
    }
    assert cell_store.read_cells(spark, store, 1).count() == len(before)


def test_changes_of_a_first_write_and_of_none(spark, tmp_path):
    store = str(tmp_path / "cells")
    assert cell_store.changes_of_last_write(spark, store).count() == 0
    cell_store.replace_cells(cell_rows(spark, [("s", 1, 1, "x")]), store)
    assert [row.change for row in cell_store.changes_of_last_write(spark, store).collect()] == ["extra"]


def dashboard_tables(spark, folder, seed=3, size=120):
    rows = shop.shop_rows(seed, size=size)
    rows["dashboard_user"] = [
        (f"2025-0{month}-15 00:00:00", "DAILY", month, 10 * month, 4 * month, 6 * month)
        for month in range(1, 9)
    ]
    rows["direct_shipping"] = [(row[5], 0) for row in rows["shipment"] if row[5]]
    tables = shop.spark_tables(spark, rows, folder)
    tables["ads"] = spark.sql(
        "select '2025-03-04' as date, 5D as total_signups, 1000D as total_cost,"
        " 2D as total_conversions, 150D as total_roas"
    )
    return tables


def test_both_dashboards_from_one_reading_are_those_of_two(spark, tmp_path):
    tables = dashboard_tables(spark, str(tmp_path / "tables"), seed=4, size=300)
    together, apart = str(tmp_path / "together"), str(tmp_path / "apart")
    weekly, monthly = shop.SETTINGS["weekly"], shop.SETTINGS["monthly"]
    dashboard.write_dashboards(tables, [weekly, monthly], together)
    for at in (weekly, monthly):
        dashboard.write_dashboard(tables, at, apart)
    found = values(cell_store.read_cells(spark, together))
    assert found == values(cell_store.read_cells(spark, apart))
    assert {key[0] for key in found} >= {weekly.sheet, monthly.sheet}
    with pytest.raises(ValueError, match="same order dates"):
        dashboard.write_dashboards(tables, [weekly, replace(monthly, order_to="2025-07-01")], together)


def test_an_upsert_leaves_other_sheets_alone(spark, tmp_path):
    store = tmp_path / "cells"
    for name in ("a", "b/ä=1", "12", None):
        cell_store.upsert_cells(cell_rows(spark, [(name, 1, 1, "old"), (name, 2, 2, "stays")]), str(store))
    before = {path: path.stat().st_mtime_ns for path in store.rglob("*.parquet")}
    for n in range(4):
        cell_store.upsert_cells(cell_rows(spark, [("b/ä=1", 1, 1, f"new {n}")]), str(store))
    written = [path for path in store.rglob("cells/*/*.parquet") if path not in before]
    assert written and all("sheet_folder=b" in str(path) for path in written)
    assert all(path.stat().st_mtime_ns == before[path] for path in store.rglob("*.parquet") if path in before)
    found = values(cell_store.read_cells(spark, str(store)))
    assert found == {(name, 1, 1): "new 3" if name == "b/ä=1" else "old" for name in ("a", "b/ä=1", "12", None)} | {
        (name, 2, 2): "stays" for name in ("a", "b/ä=1", "12", None)
    }
    # What only versions that are gone referred to is gone, what the others refer to is not.
    assert cell_store.complete_versions(spark, str(store)) == [1, 3, 4, 6, 7, 8]
    plan = cell_store.read_range(spark, str(store), "a", (1, 1), (1, 1))
    assert [row.value for row in plan.collect()] == ["old"]
    assert len(plan.inputFiles()) == 1 and "version=1" in plan.inputFiles()[0]


def test_a_second_writer_is_refused(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "cells")
    cell_store.replace_cells(cell_rows(spark, [("s", 1, 1, "x")]), store)
    with cell_store._new_version(spark, store):
        for write in (cell_store.upsert_cells, cell_store.replace_cells):
            with pytest.raises(cell_store.StoreBusy):
                write(cell_rows(spark, [("s", 1, 1, "y")]), store)
        assert values(cell_store.read_cells(spark, store)) == {("s", 1, 1): "x"}
        # One that has been silent for long has died.
        monkeypatch.setattr(cell_store, "WRITER_SECONDS", -1)
        cell_store.upsert_cells(cell_rows(spark, [("s", 1, 2, "z")]), store)
    assert values(cell_store.read_cells(spark, store)) == {("s", 1, 1): "x", ("s", 1, 2): "z"}


def test_a_failed_write_lets_the_next_one_in(spark, tmp_path):
    store = str(tmp_path / "cells")
    failing = cell_rows(spark, [("s", 1, 1, "x")]).withColumn("value", F.raise_error(F.lit("no value")))
    with pytest.raises(Exception, match="no value"):
        cell_store.upsert_cells(failing, store)
    cell_store.upsert_cells(cell_rows(spark, [("s", 1, 1, "y")]), store)
    assert values(cell_store.read_cells(spark, store)) == {("s", 1, 1): "y"}
