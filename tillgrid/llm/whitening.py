"""Embedding whitening: principal components from variances of dimensions and of their pairwise sums.

Components of vectors are rounded to whole numbers, so every sum is exact and a
run gives the same model whatever the order of rows and tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import saved

#: Steps of a whole number in 1, and components returned.
STEPS, COMPONENTS = 256, 4
#: Sums leave a task as limbs of so many bits, the last one signed.
LIMB, LIMBS = 48, 6
#: Rows that are squared at a time, and what squares may be made of in two halves of 24 bits.
ROWS, LARGEST = 8192, 1 << 47
#: Share of the largest eigenvalue below which a component is taken to have no spread.
LEAST_SPREAD = 1e-12

_SUMS = "length int, i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS))


def whole_numbers(vector: Column, steps: int = STEPS) -> Column:
    """``vector`` in steps of 1/``steps``, rounded down; null where a part is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * steps).cast("long")))


def _square_sums(values: np.ndarray) -> list[int]:
    """Exact sums of squares by column, in halves of 24 bits where they fit."""
    if values.dtype == object or np.abs(values).max(initial=0) >= LARGEST:
        values = values.astype(object)
        return [int(total) for total in (values * values).sum(0)]
    high, low = values >> 24, values & 0xFFFFFF
    parts = [(a * b).sum(0).tolist() for a, b in ((high, high), (high, low), (low, low))]
    return [(hh << 48) + (hl << 25) + ll for hh, hl, ll in zip(*parts)]


def _centred(rows: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, in 64 bits where that is far from their end."""
    if n * max(1, max(map(abs, sums), default=0) // n + 1, int(np.abs(rows.astype(float)).max(initial=0)) + 1) >= 1 << 61:
        rows = rows.astype(object)
    return rows * n - np.array(sums, rows.dtype)


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows of the batch, their vectors) for a vector column that is the first one."""
    for batch in batches:
        vectors = batch.column(0)
        lengths = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.zeros(0, np.int32)
        for length in np.unique(lengths).tolist():
            every = np.flatnonzero(lengths == length)
            for start in range(0, len(every), ROWS):
                at = every[start: start + ROWS]
                flat = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                yield length, at, flat.reshape(len(at), length)


def _limbs(total: int) -> list[int]:
    mask = (1 << LIMB) - 1
    return [(total >> LIMB * k) & mask for k in range(LIMBS - 1)] + [total >> LIMB * (LIMBS - 1)]


def _summed(of_rows: Callable[[int, np.ndarray], dict[tuple[int, int], int]]):
    """Adds up what ``of_rows`` gives by (i, j) over all rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int, int], int] = {}
        for length, _, rows in _by_length(batches):
            for (i, j), value in of_rows(length, rows).items():
                totals[length, i, j] = totals.get((length, i, j), 0) + value
        rows = [[*key, *_limbs(total)] for key, total in totals.items()]
        if rows:
            columns = list(zip(*rows))
            kinds = [pa.int32()] * 3 + [pa.int64()] * LIMBS
            names = ["length", "i", "j", *[f"l{k}" for k in range(LIMBS)]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _totals(vectors: DataFrame, of_rows) -> dict[int, dict[tuple[int, int], int]]:
    """Sums by length and (i, j): the driver gets one row per sum, whatever the number of vectors."""
    limbs = [F.sum(F.col(f"l{k}").cast("decimal(38,0)")).alias(f"l{k}") for k in range(LIMBS)]
    rows = vectors.select("x").mapInArrow(_summed(of_rows), _SUMS).groupBy("length", "i", "j").agg(*limbs).collect()
    found: dict[int, dict[tuple[int, int], int]] = {}
    for row in rows:
        total = sum(int(row[f"l{k}"]) << LIMB * k for k in range(LIMBS))
        found.setdefault(row["length"], {})[row["i"], row["j"]] = total
    return found


@dataclass(frozen=True)
class Whitening:
    """Model of the vectors of one length.

    ``n`` different vectors have the sums ``sums``. ``axes`` are unit eigenvectors of
    their covariance in columns, by falling eigenvalue ``spread``.
    """

    n: int
    sums: list[int]
    axes: np.ndarray
    spread: np.ndarray
    trace: float

    def projected(self, rows: np.ndarray, components: int) -> np.ndarray:
        """Rows on the first components, over the root of the eigenvalue; NaN where there is no spread."""
        spread = self.spread[:components]
        centred = _centred(rows, self.n, self.sums).astype(float) / self.n
        with np.errstate(divide="ignore", invalid="ignore"):
            made = centred @ self.axes[:, :components] / np.sqrt(spread)
        made[:, ~self.spread_out(components)] = np.nan
        return made

    def spread_out(self, components: int) -> np.ndarray:
        return self.spread[:components] > LEAST_SPREAD * max(float(self.spread[:1].sum()), 0.0)


def _model(n: int, sums: list[int], squares: dict[tuple[int, int], int]) -> Whitening:
    """``squares`` are the sums of (n x_i - S_i)^2 by (i, i) and of the same of x_i + x_j by (i, j).

    A covariance is half of what the variance of a sum exceeds the variances of its
    two dimensions by; whole numbers up to the division, so nothing cancels.
    """
    d, scale = len(sums), n ** 3
    matrix = np.zeros((d, d))
    for i in range(d):
        matrix[i, i] = float(Fraction(squares[i, i], scale))
        for j in range(i):
            twice = squares[j, i] - squares[i, i] - squares[j, j]
            matrix[i, j] = matrix[j, i] = float(Fraction(twice, 2 * scale))
    spread, axes = np.linalg.eigh(matrix)
    spread, axes = np.maximum(spread[::-1], 0.0), axes[:, ::-1]
    largest = axes[np.abs(axes).argmax(0), np.arange(d)]
    trace = float(Fraction(sum(squares[i, i] for i in range(d)), scale))
    return Whitening(n, sums, axes * np.where(largest < 0, -1.0, 1.0), spread, trace)


def fit_whitening(vectors: DataFrame) -> dict[int, Whitening]:
    """Model by length of the vectors ``x`` (array of long), each different one to be given once.

    Two passes: sums, then squares of centred dimensions and of centred sums of two. Squares of
    n x - S stay whole, beyond 64 bits where they need to. d (d + 1) / 2 numbers
    a task are shuffled, and as many come to the driver.
    """

    def plain(length: int, rows: np.ndarray) -> dict[tuple[int, int], int]:
        halves = [(rows >> 24).sum(0).tolist(), (rows & 0xFFFFFF).sum(0).tolist()]
        found = {(0, i): (high << 24) + low for i, (high, low) in enumerate(zip(*halves))}
        return {**found, (1, 0): len(rows)}

    first = {length: own for length, own in _totals(vectors, plain).items() if length}
    centre = {length: (own[1, 0], [own[0, i] for i in range(length)]) for length, own in first.items()}

    def squared(length: int, rows: np.ndarray) -> dict[tuple[int, int], int]:
        if not length:
            return {}
        centred, found = _centred(rows, *centre[length]), {}
        for i in range(length):
            # Twice a dimension is its sum with itself; it is taken plain instead.
            both = np.concatenate([centred[:, i: i + 1], centred[:, i: i + 1] + centred[:, i + 1:]], axis=1)
            found.update({(i, i + at): total for at, total in enumerate(_square_sums(both))})
        return found

    squares = _totals(vectors, squared)
    return {length: _model(n, sums, squares[length]) for length, (n, sums) in centre.items()}


def identity_errors(vectors: DataFrame, models: dict[int, Whitening], components: int = COMPONENTS) -> dict[int, float]:
    """Largest difference of the covariance of the whitened vectors from the identity, by length."""
    schema = "length int, total array<double>, product array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[np.ndarray]] = {}
        for length, _, rows in _by_length(batches):
            if length in models:
                own = np.nan_to_num(models[length].projected(rows, components))
                total = found.setdefault(length, [np.zeros(own.shape[1]), np.zeros((own.shape[1],) * 2)])
                total[0] += own.sum(0)
                total[1] += own.T @ own
        for length, (total, product) in found.items():
            yield pa.RecordBatch.from_pydict(
                {"length": pa.array([length], pa.int32()), "total": [total.tolist()], "product": [product.ravel().tolist()]}
            )

    parts = vectors.select("x").mapInArrow(run, schema)
    added = [
        parts.select("length", F.lit(k).alias("kind"), F.posexplode(name)).groupBy("length", "kind", "pos").agg(F.sum("col").alias("value"))
        for k, name in enumerate(["total", "product"])
    ]
    rows, errors = added[0].union(added[1]).collect(), {}
    for length, model in models.items():
        own = {(row["kind"], row["pos"]): row["value"] for row in rows if row["length"] == length}
        k = min(components, length)
        mean = np.array([own[0, i] for i in range(k)]) / model.n
        product = np.array([own[1, i] for i in range(k * k)]).reshape(k, k) / model.n
        spread_out = np.flatnonzero(model.spread_out(components))
        apart = np.abs(product - np.outer(mean, mean) - np.eye(k))[np.ix_(spread_out, spread_out)]
        errors[length] = float(apart.max(initial=0.0))
    return errors


def _whitened(models: dict[int, Whitening], errors: dict[int, float], components: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, at, rows in _by_length([batch]):
                model = models.get(length)
                if model is None:
                    continue
                k = min(components, length)
                made = model.projected(rows, k)
                centred = _centred(rows, model.n, model.sums).astype(object)
                deviation = [own if own < 1 << 63 else None for own in (centred * centred).sum(1).tolist()]
                share = [float(own / model.trace) if model.trace else None for own in model.spread[:k]]
                size = len(at) * k
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).take(pa.array(np.repeat(at, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(size, model.n, np.int64)),
                        pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))),
                        pa.array(made.ravel(), from_pandas=True),
                        pa.array(share * len(at), pa.float64()),
                        pa.array(np.full(size, errors[length])),
                    ],
                    names=[batch.schema.names[1], "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whitened(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Each vector on the first principal components, with unit spread on each.

    Returns ``key``, ``component`` from 1 on, ``n``, ``deviation``, ``whitened``, ``explained``
    and ``identity_error``. Vectors that are null, empty, or hold null or non-finite
    parts have no rows; vectors of different lengths have models of their own. The model is
    fitted on each different vector once, repeated rows get equal results, and a null
    key stays null. ``whitened`` is null on a component without spread, ``explained`` is null
    where no dimension has any, and ``deviation`` is null beyond 64 bits. Other columns
    are dropped; an empty table stays empty.
    """
    every = vectors.select(whole_numbers(F.col(column)).alias("x"), F.col(key).alias("key")).where("size(x) > 0")
    different = saved(every.select("x").distinct())
    models = fit_whitening(different)
    errors = identity_errors(different, models, components) if models else {}
    kind = vectors.schema[key].dataType.simpleString()
    schema = (
        f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    return every.mapInArrow(_whitened(models, errors, components), schema).withColumnRenamed("key", key)
