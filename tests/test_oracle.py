"""Every registered query against its DuckDB SQL on the same tables."""

import math
import os
import re
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from conftest import plan_of

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SLOW = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "ExistingRDD"]
#: The text operators have tests of their own.
REPORTS = [name for name in registered.queries() if not re.match(r"op\d+_|pipeline$", name)]
QUERIES, ORACLES = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.sql(f"create view {file.stem} as select * from '{file}'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(plain(row[index]) for index in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(REPORTS) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_same_rows(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    expected = duck.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(expected.columns)
    got = rows_of(result.collect(), result.columns)
    wanted = rows_of(expected.fetchall(), expected.columns)
    assert sum(wanted.values()) > 0
    assert got == wanted
    plan = plan_of(result)
    assert [word for word in SLOW if word in plan] == []
