"""The raw advertising sheet, from CSV to weekly and monthly figures."""

import csv
import random
import re

import pytest

from conftest import plan_of
from tillgrid.operators.ads import ads_clean, ads_monthly, ads_weekly
from tillgrid.plans.dashboard import refresh_ads
from tillgrid.sources import ad_grid
from tillgrid.sources.ad_grid import ad_columns, raw_sheet, read_ad_grid


def grid_row(date, **cells):
    names = ad_columns()
    row = ["0"] * len(names)
    row[0] = date
    for name, cell in cells.items():
        row[names.index(name)] = cell
    return row


@pytest.fixture()
def folder(tmp_path):
    def write(name, rows):
        with open(tmp_path / name, "w", newline="", encoding="utf-8") as file:
            csv.writer(file).writerows(rows)

    junk = [["title"], ["", "note"], ["date", "impressions"]]
    write(
        "sheet_Raw.csv",
        [
            *junk,
            grid_row("2025-01-06", total_signups="1,234.5%", total_cost="abc", total_roas="10"),
            [""] * 92,
            [" "] * 92,
            grid_row("2025-01-12", total_signups="#value!", total_cost="", total_roas="15"),
            grid_row("2025-01-13", total_signups="7", total_conversions="line\nbreak")[:90],
            [*grid_row("2025-02-01", total_signups=" 8 ", total_cost="1d"), "x", "y", "z"],
        ],
    )
    write("z_RAW.csv", [*junk, grid_row("2024-12-31", total_signups="#VALUE")])
    write("unrelated.csv", [*junk, grid_row("2025-01-06", total_signups="999")])
    return str(tmp_path)


def test_columns():
    names = ad_columns()
    assert len(names) == len(set(names)) == 92
    assert names[:2] == ["date", "total_impressions"]
    assert names[9:11] == ["total_cpa", "total_roas"]
    assert names[-1] == "mobion_roas"


DATES = ["2025-01-06", "2025-01-12", "2025-01-13", "2025-02-01"]


def test_first_raw_file_is_the_sheet(spark, folder):
    assert raw_sheet(spark, folder).endswith("/sheet_Raw.csv")


def test_header_rows_are_skipped_in_each_file(spark, folder):
    grid = read_ad_grid(spark, raw_sheet(spark, folder), f"{folder}/z_RAW.csv")
    dates = [row.date for row in grid.collect()]
    assert sorted(date for date in dates if date and date.strip()) == ["2024-12-31", *DATES]


def test_no_raw_file_is_an_error(spark, tmp_path):
    (tmp_path / "other.csv").write_text("a,b\n")
    with pytest.raises(FileNotFoundError):
        raw_sheet(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        raw_sheet(spark, str(tmp_path / "missing"))


def test_clean(spark, folder):
    clean = ads_clean(read_ad_grid(spark, raw_sheet(spark, folder)))
    assert clean.columns == ad_columns()
    assert {kind for _, kind in clean.dtypes[1:]} == {"double"}
    rows = {row.date: row for row in clean.collect()}
    assert sorted(rows) == DATES
    assert rows["2025-01-06"].total_signups == 1234.5
    assert rows["2025-01-06"].total_cost == 0
    assert rows["2025-01-12"].total_signups == 0
    assert rows["2025-01-13"].total_conversions == 0
    assert rows["2025-01-13"].mobion_roas == 0
    assert rows["2025-02-01"].total_signups == 8
    assert rows["2025-02-01"].total_cost == 0


@pytest.mark.parametrize(
    "cell, number",
    [
        ("+5", 5.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("-1.5e2", -150.0),
        ("\t3", 3.0),
        ("1d", 0.0),
        ("1f", 0.0),
        ("0x10", 0.0),
        ("1 2", 0.0),
        ("--1", 0.0),
        ("nan", 0.0),
        ("12%", 12.0),
        ("#VALUE", 0.0),
    ],
)
def test_numbers(spark, cell, number):
    grid = spark.createDataFrame([("2025-01-06", cell)], "date string, total_cost string")
    assert ads_clean(grid).collect()[0].total_cost == number


def figures(df):
    return {tuple(row) for row in df.collect()}


def test_weekly_and_monthly_figures(spark, folder):
    clean = ads_clean(read_ad_grid(spark, raw_sheet(spark, folder)))
    assert figures(ads_weekly(clean, "2024-12-30", 32)) == {
        (2, 1234, 0, 0, 12),
        (3, 7, 0, 0, 0),
        (5, 8, 0, 0, 0),
    }
    assert figures(ads_monthly(clean, 2025, 8)) == {(1, 1241, 0, 0, 8), (2, 8, 0, 0, 0)}


def test_refresh_replaces_the_table(spark, folder, tmp_path):
    target = str(tmp_path / "ads")
    for _ in range(2):
        assert refresh_ads(spark, folder, target).count() == 4


def test_weekly_dates_compare_as_text(spark):
    texts = [
        "2025-01-06",
        "2025-01-08 10:00",
        "2025-01-12",
        "2025-01-12 10:00",
        "2025-1-8",
        "",
        "2024-12-29",
        "2025-08-10",
        "2025-08-11",
    ]
    rows = [(text, 1.0, 1.0, 1.0, 1.0) for text in texts]
    ads = spark.createDataFrame(
        rows,
        "date string, total_signups double, total_cost double, total_conversions double,"
        " total_roas double",
    )
    weeks = {row.period: row.signups for row in ads_weekly(ads, "2024-12-30", 32).collect()}
    expected = {}
    for number in range(1, 33):
        start = f"{_day(7 * (number - 1))}"
        end = f"{_day(7 * number - 1)}"
        inside = sum(start <= text <= end for text in texts)
        if inside:
            expected[number] = inside
    assert weeks == expected == {2: 3, 32: 1}


def _day(offset):
    from datetime import date, timedelta

    return (date(2024, 12, 30) + timedelta(days=offset)).isoformat()


def test_monthly_fails_on_a_bad_date(spark):
    ads = spark.createDataFrame(
        [("no date", 1.0, 1.0, 1.0, 1.0)],
        "date string, total_signups double, total_cost double, total_conversions double,"
        " total_roas double",
    )
    with pytest.raises(Exception, match="no date"):
        ads_monthly(ads, 2025, 8).collect()


def test_sheet_names_and_empty_header_lines(spark, tmp_path):
    folder = tmp_path / "ads {a}"
    folder.mkdir()
    row = ",".join(grid_row("2025-01-06", total_signups="5"))
    (folder / "ad RAW [data].csv").write_bytes(f"title\r\n\r\ndate\r\n{row}\r\n\r\n{row}".encode())
    sheet = raw_sheet(spark, str(folder))
    assert sheet.endswith("/ad RAW [data].csv")
    assert [row.total_signups for row in read_ad_grid(spark, sheet).collect()] == ["5", "5"]


def test_dates_that_are_not_written_in_full(spark):
    texts = ["2025-02-3", "2025-01-05", "2025-01-05 10:00", "2025-01-04 10:00", "", "x"]
    ads = spark.createDataFrame([(text, 1.0, 1.0, 1.0, 1.0) for text in texts],
        "date string, total_signups double, total_cost double, total_conversions double, total_roas double")
    weeks = {row.period: row.signups for row in ads_weekly(ads, "2024-12-30", 32).collect()}
    assert weeks == {1: 2, 9: 1}


def rows_in_order(lines):
    """Row number of each line, read one after the other."""
    quotes, row, found = 0, 0, []
    for line in lines:
        row += quotes % 2 == 0
        found.append(row)
        quotes += line.count('"')
    return found


@pytest.mark.parametrize("block", [1, 7, 10_000])
def test_rows_over_blocks_of_lines(spark, block):
    draw = random.Random(block)
    sheets = {}
    for number in range(6):
        lines = [draw.choice(["a,b", "", '"x', 'y"', '"whole"', 'a""b', '"', "z"]) for _ in range(60)]
        if sum(line.count('"') for line in lines) % 2:
            lines.append('"')
        sheets[f"f{number}"] = lines
    rows = [(name, n * 3, line) for name, lines in sheets.items() for n, line in enumerate(lines)]
    found = ad_grid.numbered_rows(spark.createDataFrame(rows, "file string, position long, line string"), block)
    by_file = {}
    for row in sorted(found.collect(), key=lambda row: row.position):
        by_file.setdefault(row.file, []).append(row.row)
    assert by_file == {name: rows_in_order(lines) for name, lines in sheets.items()}


def test_a_stray_quote_fails(spark):
    lines = spark.createDataFrame([("f", n, 'a"b' if n == 5 else "a") for n in range(9)], "file string, position long, line string")
    with pytest.raises(Exception, match="a quote without its partner in f"):
        ad_grid.grid_of_lines(lines, 3).collect()


def test_no_window_over_lines_spans_a_file(spark):
    lines = spark.createDataFrame([("f", n, "a") for n in range(9)], "file string, position long, line string")
    plan = plan_of(ad_grid.grid_of_lines(lines))
    keys = re.findall(r"\n\(\d+\) Window\n.*\n(Arguments: .*)", plan)
    over_lines = [text for text in keys if "position#" in text]
    assert over_lines and all(re.search(r"\[file#\d+, block#\d+L\], \[position#", text) for text in over_lines)
    assert all("line#" not in text for text in keys)
    # By file alone go the totals of blocks, after they have been grouped.
    tree = plan.split("\n\n")[0].splitlines()
    assert any("HashAggregate" in line for line in tree)


def test_no_lines(spark):
    none = spark.createDataFrame([], "file string, position long, line string")
    assert ad_grid.grid_of_lines(none).count() == 0
