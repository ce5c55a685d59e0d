"""Whitening against covariances of exact integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillgrid.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, x int, key string, n int"


def made_vectors():
    draw = np.random.default_rng(7)
    mix = draw.normal(size=(6, 6)) * [3.0, 1.0, 0.5, 0.2, 0.1, 0.05]
    rows = [(draw.normal(size=6) @ mix.T + 4).tolist() for _ in range(300)]
    rows += rows[:100] + [rows[0]] * 150
    rows += [[x + 1e-6 for x in rows[1]], None, [], [1.0, None] * 3, [math.nan] * 6, [math.inf] + [0.0] * 5]
    return rows + [[1.0, 2.0], [1.5, 2.0], [1.0, 2.0], [7.0]]


def usable(row):
    return bool(row) and all(x is not None and math.isfinite(x) for x in row)


def whole(row):
    return tuple(math.floor(256 * x) for x in row)


def expected(rows, length):
    fit = sorted({whole(row) for row in rows if usable(row) and len(row) == length})
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    centred = [[n * x - s for x, s in zip(row, sums)] for row in fit]
    cov = np.array([[sum(a * b for a, b in zip(p, q)) / n**3 for q in zip(*centred)] for p in zip(*centred)])
    spread, axes = np.linalg.eigh(cov)
    return n, sums, cov, spread[::-1], axes[:, ::-1]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, row, 1, "k", 2) for i, row in enumerate(made_vectors())] + [(None, made_vectors()[0], 1, "k", 2)]
    made = whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert made.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return made.collect()


def test_components(found):
    rows = made_vectors()
    n, sums, cov, spread, axes = expected(rows, 6)
    by_row = {(row["vec_id"], row["component"]): row for row in found}
    six = [i for i, row in enumerate(rows) if usable(row) and len(row) == 6]
    assert {key for key in by_row if key[0] in {*six, None}} == {(i, k) for i in [*six, None] for k in (1, 2, 3, 4)}
    signs = np.zeros(4)
    for i in six:
        centred = [n * x - s for x, s in zip(whole(rows[i]), sums)]
        for k in range(4):
            row = by_row[i, k + 1]
            wanted = np.array(centred) / n @ axes[:, k] / math.sqrt(spread[k])
            signs[k] = signs[k] or math.copysign(1, row["whitened"] * wanted)
            assert row["whitened"] == pytest.approx(signs[k] * wanted, rel=1e-9, abs=1e-9)
            assert (row["n"], row["deviation"]) == (n, sum(c * c for c in centred))
            assert row["explained"] == pytest.approx(spread[k] / np.trace(cov), rel=1e-10)
            assert 0 <= row["identity_error"] < 1e-9


def test_other_lengths_and_no_spread(found):
    rows = made_vectors()
    by_length = {length: [row for row in found if row["vec_id"] is not None and len(rows[row["vec_id"]]) == length] for length in (1, 2)}
    assert [(row["component"], row["n"], row["deviation"], row["whitened"], row["explained"]) for row in by_length[1]] == [(1, 1, 0, None, None)]
    assert len(by_length[2]) == 6
    for row in by_length[2]:
        assert row["n"] == 2 and row["explained"] == (1.0 if row["component"] == 1 else 0.0)
        assert (row["whitened"] is None) == (row["component"] == 2)
        assert row["component"] == 2 or abs(row["whitened"]) == pytest.approx(1.0)


def test_sums_beyond_64_bits(spark):
    """Whole numbers near the end of 64 bits, whose squares need twice as many."""
    rows = [(i, [float(2**54 * s), float(i)], 1, "k", 2) for i, s in enumerate([1, -1, 1, -1, 3])]
    made = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    n, sums, _, spread, _ = expected([row[1] for row in rows], 2)
    assert len(made) == 10
    for row in made:
        exact = sum((n * x - s) ** 2 for x, s in zip(whole(rows[row["vec_id"]][1]), sums))
        assert exact > 2**63 and row["deviation"] is None
    first = [row["whitened"] for row in made if row["component"] == 1]
    assert np.var(first) == pytest.approx(1.0)


def test_model_is_the_same_however_rows_are_spread(spark):
    rows = [(row,) for row in made_vectors() if usable(row)]
    models = []
    for parts in (1, 7):
        vectors = spark.createDataFrame(rows, "embedding array<double>").repartition(parts)
        models.append(whitening.fit_whitening(vectors.select(whitening.whole_numbers(F.col("embedding")).alias("x")).distinct()))
    assert models[0].keys() == models[1].keys() == {1, 2, 6}
    for length in models[0]:
        assert np.array_equal(models[0][length].axes, models[1][length].axes)


def test_empty_table_and_floats(spark):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "vec_id int, embedding array<float>")
    assert whitening.whitened(none).count() == 0
