"""Quality classifier: random Fourier features, ridge scores, isotonic calibration."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import saved

#: Random features, width of the kernel, ridge, and the seed of the features.
FEATURES, WIDTH, RIDGE, SEED = 192, 4.0, 1e-3, 7
#: Bins of the calibration, over raw scores from LOWEST to HIGHEST.
BINS, LOWEST, HIGHEST = 1024, -0.5, 1.5
STATISTICS = [
    "log_words", "word_length", "symbols", "bangs", "capitals", "digits", "foreign", "variety",
    "pair_variety", "echoes", "top_word", "equal_lines", "log_line", "stops",
]
_CAPITALS, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))


def statistics(text: str | None) -> list[float]:
    """Statistics of a whole text; a null text counts as empty and has only zeros."""
    data = (text or "").encode()
    words = data.split()
    n, size = len(words), max(1, len(data))
    if not n:
        return [0.0] * len(STATISTICS)
    lines = [line for line in data.split(b"\n") if line.strip()]
    counts: dict[bytes, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    return [
        math.log1p(n),
        (size - data.count(b" ") - data.count(b"\n")) / n,
        min(4.0, sum(map(data.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))) / n),
        min(4.0, data.count(b"!") / n),
        1 - len(data.translate(None, _CAPITALS)) / size,
        1 - len(data.translate(None, _DIGITS)) / size,
        1 - len(text) / size,
        len(counts) / n,
        len(set(zip(words, words[1:]))) / max(1, n - 1),
        sum(map(bytes.__eq__, words, words[1:])) / n,
        max(counts.values()) / n,
        1 - len(set(lines)) / len(lines),
        math.log1p(n / len(lines)),
        min(1.0, data.count(b".") / n),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [statistics(text) for text in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(values, pa.list_(pa.float64()))], names=[*batch.schema.names[1:], "x"]
        )


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``x``, the statistics of the whole text."""
    schema = docs.select(*keep, F.array(F.lit(0.0)).alias("x")).schema
    return docs.select(F.col("text").alias("_text"), *keep).mapInArrow(_measure, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


@dataclass(frozen=True)
class QualityModel:
    """Scale of the statistics, weights of the random features, and the calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    chance: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Features whose products approximate a Gaussian kernel, and a constant."""
        random = np.random.default_rng(SEED)
        turn = random.normal(size=(len(STATISTICS), FEATURES)) / WIDTH
        phase = random.uniform(0, 2 * np.pi, FEATURES)
        scaled = np.clip((x - self.mean) / self.scale, -20, 20)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(scaled @ turn + phase), np.ones((len(x), 1))])

    def raw_score(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *[self.features(part) @ self.weights for part in _parts(x)]])

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw_score(x), self.raw, self.chance)


def _parts(x: np.ndarray, rows: int = 4096) -> list[np.ndarray]:
    return [x[start: start + rows] for start in range(0, len(x), rows)]


def _sums(model: QualityModel):
    """Rows of the normal equations, summed over what the task reads: (i, row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            for part, own in zip(_parts(_matrix(batch.column(0))), _parts(label)):
                features = model.features(part)
                total += features.T @ np.hstack([features, own[:, None]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"]
        )

    return run


def _scored(model: QualityModel, column: str, calibrated: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0))
            made = model.score(x) if calibrated else model.raw_score(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(made)], names=[*batch.schema.names[1:], column])

    return run


def increasing(raw: np.ndarray, good: np.ndarray, every: np.ndarray) -> np.ndarray:
    """Isotonic shares of ``good`` in ``every`` in the order of ``raw``: pools neighbours that fall."""
    blocks: list[list[float]] = []
    for own, size in zip(good, every):
        blocks.append([own, size, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.concatenate([np.zeros(0), *[np.full(int(n), own / size) for own, size, n in blocks]])


def fit_quality(labelled: DataFrame) -> QualityModel:
    """Model from all rows of ``x`` and ``label`` (0 or 1).

    The driver gets the mean and spread of each statistic, the summed normal
    equations, whose size is that of the features, and one row per bin of raw
    scores. Without rows every score is 0.5.
    """
    labelled = labelled.where("label is not null")
    width = len(STATISTICS)
    columns = [F.col("x")[i] for i in range(width)]
    first = labelled.agg(*[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    if first[0] is None:
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))
    mean, spread = np.array(first[:width]), np.array(first[width:])
    model = QualityModel(mean, np.where(spread > 1e-9, spread, 1.0), np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))
    rows = labelled.select("x", "label").mapInArrow(_sums(model), "i int, row array<double>")
    entries = rows.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    system = np.zeros((FEATURES + 1, FEATURES + 2))
    for i, j, v in entries:
        system[i, j] = v
    n = system[FEATURES, FEATURES]
    weights = np.linalg.solve(system[:, :-1] + RIDGE * n / FEATURES * np.eye(FEATURES + 1), system[:, -1])
    model = QualityModel(model.mean, model.scale, weights, model.raw, model.chance)
    raw = labelled.select("x", "label").mapInArrow(_scored(model, "raw", False), "label int, raw double")
    bins = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("raw") - LOWEST) / (HIGHEST - LOWEST) * BINS)))
    counted = raw.groupBy(bins.cast("int").alias("bin")).agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect()
    counted.sort(key=lambda row: row["bin"])
    middle = np.array([LOWEST + (row["bin"] + 0.5) * (HIGHEST - LOWEST) / BINS for row in counted])
    chance = increasing(middle, np.array([float(row["good"]) for row in counted]), np.array([float(row["n"]) for row in counted]))
    return QualityModel(model.mean, model.scale, weights, middle, chance)


def scored(measured: DataFrame, model: QualityModel) -> DataFrame:
    """Rows of ``measured`` with ``score`` instead of ``x``."""
    keep = [name for name in measured.columns if name != "x"]
    schema = measured.select(*keep, F.lit(0.0).alias("score")).schema
    return measured.select("x", *keep).mapInArrow(_scored(model, "score", True), schema)


def classified(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document.

    Learns from labelled documents that are not held out: those whose crc32 of
    ``doc_id`` as text leaves a remainder by 5. A null ``doc_id`` is not held out and has no
    label; repeated labels all count. Only statistics of the text enter a score.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    measured = saved(with_statistics(docs.select("doc_id", "text"), "doc_id").withColumn("held_out", held_out))
    labels = labels.select("doc_id", F.col("quality").cast("int").alias("label"))
    model = fit_quality(measured.where("not held_out").join(labels, "doc_id").select("x", "label"))
    return scored(measured, model).withColumn("predicted", (F.col("score") >= least).cast("int"))
