"""What several operators of this subpackage share: words, saved tables, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.sources.folders import kept

#: A word is a run of characters other than these (space and U+0009 to U+000D).
SPACES = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Array of the words of a text; a null text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACES)
    return F.filter(parts, lambda word: word != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def saved(df: DataFrame) -> DataFrame:
    """``df`` written once as a table to the shared folder and read from there.

    Cuts the lineage: a lost executor costs no recomputation of what is before. The
    table is removed when the driver's process ends.
    """
    return kept(df, "table")


def slices(batch: pa.RecordBatch, column: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``most`` bytes of text each, to bound what arrays a task holds."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    borders = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(borders, borders[1:]):
        if end > start:
            yield batch.slice(start, end - start)


#: Steps in which expected numbers of different characters are counted, so that sums are exact in any order.
STEPS = 1 << 20


def witten_bell(
    grams: DataFrame, order: int, names: list[str], uniform: float, shares: dict[str, float] | None = None
) -> DataFrame:
    """Chance of the last character of each ``gram`` after the others, ``p_<name>`` per count column.

    Mixes orders 0 to ``order`` - 1: the share of a character after a context is
    mixed with that after the context without its first character, by the number
    of different characters seen after it. A context never seen leaves the shorter
    one's chance as it is; before any count stands ``uniform``. A model in ``shares`` is that of a
    part of its counts: they are scaled by the share f, and a character counted n times is
    different with the chance 1 - (1 - f)^n that the part has it.
    """
    shares = shares or {}
    chances = None
    for k in range(order):
        ends = grams.groupBy(F.substring("gram", order - k, k + 1).alias("e")).agg(
            *[F.sum(name).alias(name) for name in names]
        )
        ends = ends.withColumn("c", F.substring("e", 1, k))
        contexts = ends.groupBy("c").agg(
            *[F.sum(name).alias(f"{name}_all") for name in names],
            *[_kinds(name, shares.get(name, 1.0)).alias(f"{name}_kinds") for name in names],
        )
        table = ends.join(contexts, "c")
        if chances is None:
            table = table.withColumns({f"p_{name}": F.lit(uniform) for name in names})
        else:
            table = table.withColumn("s", F.substring("e", 2, k)).join(chances.withColumnRenamed("e", "s"), "s")
        mixed = []
        for name in names:
            share = shares.get(name, 1.0)
            kinds, p = F.col(f"{name}_kinds"), F.col(f"p_{name}")
            own, every = F.col(name) * share, F.col(f"{name}_all") * share
            mixed.append(F.when(every == 0, p).otherwise((own + kinds * p) / (every + kinds)).alias(f"p_{name}"))
        chances = table.select("e", *mixed)
    return chances.withColumnRenamed("e", "gram")


def _kinds(name: str, share: float) -> Column:
    """Different characters counted, or expected in a share of the counts."""
    if share == 1:
        return F.sum((F.col(name) > 0).cast("long"))
    chance = -F.expm1(F.col(name) * math.log1p(-share))
    return F.sum(F.ceil(chance * STEPS)) / STEPS


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of links (a, b) as links of its nodes with the smallest reachable one."""
    for batch in batches:
        a, b = (np.asarray(column, dtype=np.int64) for column in batch.columns)
        if not len(a):
            continue
        nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
        roots = smallest_reachable(len(nodes), index[: len(a)], index[len(a):])
        moved = roots != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[moved]), pa.array(nodes[roots[moved]])], names=["a", "b"]
        )


def smallest_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of ``n`` nodes over the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component_id) of every node of ``links`` (a, b), both long.

    ``component_id`` is the smallest node reachable. Alternates two steps, large
    star and small star, until the links are stars around the smallest nodes;
    that takes a number of rounds logarithmic in the size of a component. A
    round groups by minimum, which combines before the shuffle, and joins the
    minimum back, where a node with very many links is split by AQE. Batches of
    links are reduced to forests before every shuffle.
    """
    schema = "a long, b long"
    pairs = links.select("a", "b").where("a <> b").mapInArrow(_forest, schema)
    stars = saved(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    before = None
    for _ in range(most_rounds):
        both = stars.union(stars.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        least = least.select("a", F.least("a", "low").alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        stars = saved(small.union(least.select("a", F.col("low").alias("b"))).distinct())
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components not found in {most_rounds} rounds")
    roots = stars.select("b").distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component_id")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("component_id"))
    )
