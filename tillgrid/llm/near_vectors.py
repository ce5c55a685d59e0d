"""Near-duplicate vectors: an exact range join over pivot cells."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrid.llm.common import components, saved, smallest_reachable

LEAST_COSINE = 0.93
#: Vectors for which a group gets one pivot more, rows of a block, and pivots in all.
PER_PIVOT, IN_BLOCK, MOST_PIVOTS = 2048, 1024, 2048
#: For rounding of distances; cosines are compared without it.
SLACK = 1e-6
#: Parts of a component that look up its smallest id apart.
ROOT_PARTS = 16


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: no null or non-finite part, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (a @ b.T)))


def _to_cells(pivots: dict[tuple[int, int], np.ndarray], radius: float):
    """Rows (label, node, copies, vector) to the cell they are at home in and those they border.

    A vector within ``radius`` of one at home in a cell is at most twice the radius
    further from that cell's pivot than from its own, by the triangle inequality.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, vectors = batch.column(0).to_numpy(), batch.column(3)
            lengths = np.diff(vectors.offsets.to_numpy())
            take, cells, home = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
            kinds, kind = np.unique(np.stack([labels, lengths], axis=1), axis=0, return_inverse=True)
            for number, (label, length) in enumerate(kinds.tolist()):
                rows = np.flatnonzero(kind.reshape(-1) == number)
                own = pivots.get((label, length))
                if own is None:
                    take.append(rows), cells.append(np.full(len(rows), -1)), home.append(np.ones(len(rows), bool))
                    continue
                apart = _distances(_units(vectors.take(pa.array(rows))), own)
                nearest = apart.argmin(1)
                within = apart <= apart.min(1)[:, None] + 2 * radius + SLACK
                within[np.arange(len(rows)), nearest] = True
                at, cell = np.nonzero(within)
                take.append(rows[at]), cells.append(cell), home.append(nearest[at] == cell)
            taken = pa.array(np.concatenate(take))
            yield pa.RecordBatch.from_arrays(
                [*[column.take(taken) for column in batch.columns],
                 pa.array(np.concatenate(cells).astype(np.int32)), pa.array(np.concatenate(home))],
                names=[*batch.schema.names, "cell", "home"],
            )

    return run


def _compare(least: float):
    """Links of the home rows of one block with the rows of another."""

    def run(table: pa.Table) -> pa.Table:
        nodes, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        units, asks = _units(table["vector"]), table["asks"].to_numpy(zero_copy_only=False)
        own, other = np.flatnonzero(asks), np.flatnonzero(~asks)
        near = units[own] @ units[other].T >= least
        near &= nodes[own][:, None] != nodes[other][None, :]
        counts = near @ copies[other]
        found = np.flatnonzero(counts)
        a, b = np.nonzero(near)
        ids, index = np.unique(np.concatenate([nodes[own][a], nodes[other][b]]), return_inverse=True)
        roots = smallest_reachable(len(ids), index[: len(a)], index[len(a):])
        moved = np.flatnonzero(roots != np.arange(len(ids)))
        none = pa.nulls(len(found), pa.int64())
        return pa.table({
            "a": pa.concat_arrays([pa.array(nodes[own][found]), pa.array(ids[moved])]),
            "b": pa.concat_arrays([none, pa.array(ids[roots[moved]])]),
            "n": pa.concat_arrays([pa.array(counts[found].astype(np.int64)), pa.nulls(len(moved), pa.int64())]),
        })

    return run


def _pivots(nodes: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Pivots by (label, length): nodes picked by a hash where a group is larger than a cell.

    One in ``PER_PIVOT``, or fewer so that about ``MOST_PIVOTS`` are picked of any
    number of vectors; those are what the driver gets and hands to the tasks.
    More vectors per pivot only make cells of more blocks.
    """
    groups = nodes.groupBy("label", F.size("vector").alias("length")).count()
    every = groups.agg(F.sum("count")).first()[0] or 0
    per_pivot = max(PER_PIVOT, math.ceil(every / MOST_PIVOTS))
    large = groups.where(F.col("count") > per_pivot).select("label", "length")
    picked = nodes.where(F.pmod(F.xxhash64("node", F.lit("pivot")), F.lit(per_pivot)) == 0)
    picked = picked.withColumn("length", F.size("vector")).join(large, ["label", "length"])
    found: dict[tuple[int, int], list] = {}
    for row in picked.select("label", "length", "vector").collect():
        found.setdefault((row["label"], row["length"]), []).append(row["vector"])
    return {key: _units(pa.array(rows)) for key, rows in found.items()}


def links_of_vectors(nodes: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """Links among ``node``, ``copies``, ``label``, ``vector``, each different vector once.

    Rows (a, null, n): n vectors are linked to a, copies counted; to be added up.
    Rows (a, b, null): links that join all nodes reachable from each other.
    Cells are compared by themselves, in blocks of their home rows against blocks
    of all their rows, so that no task holds more than two blocks. A block gives
    counts and a forest, not its pairs.
    """
    radius = math.sqrt(2 - 2 * least)
    schema = "label long, node long, copies long, vector array<double>, cell int, home boolean"
    placed = saved(
        nodes.select("label", "node", "copies", F.col("vector").cast("array<double>").alias("vector"))
        .mapInArrow(_to_cells(_pivots(nodes), radius), schema)
        .withColumn("length", F.size("vector"))
    )
    cell = ["label", "length", "cell"]
    blocks = placed.groupBy(*cell).agg(
        F.ceil(F.sum(F.col("home").cast("long")) / F.lit(IN_BLOCK)).cast("int").alias("askers"),
        F.ceil(F.count("*") / F.lit(IN_BLOCK)).cast("int").alias("others"),
    )
    sized = placed.join(blocks, cell)
    asker, other = F.pmod(F.xxhash64("node"), F.col("askers")), F.pmod(F.xxhash64("node"), F.col("others"))
    columns = [*cell, "node", "copies", "vector"]
    as_asker = sized.where("home").select(
        *columns, asker.alias("x"), F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("y"), F.lit(True).alias("asks")
    )
    as_other = sized.where("askers > 0").select(
        *columns, F.explode(F.sequence(F.lit(0), F.col("askers") - 1)).alias("x"), other.alias("y"), F.lit(False).alias("asks")
    )
    as_asker, as_other = (
        side.select(*columns, F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), "asks")
        for side in (as_asker, as_other)
    )
    grouped = as_asker.union(as_other).groupBy(*cell, "x", "y")
    return grouped.applyInArrow(_compare(least), "a long, b long, n long")


def near_vectors(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``vec_id``, ``embedding``, ``label``.

    Rows link if their labels are equal and not null and the cosine is at least
    ``least``. Vectors without a direction, without a label, and of different
    lengths link with nothing. Equal vectors of a label are compared once and
    count as linked to each other. A row whose ``vec_id`` is null counts as a
    partner and has itself a null component. An id that stands twice names each of
    its rows for itself. Labels may be of any type. An empty table gives none.
    """
    keys = [F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(1), "embedding").alias("k2")]
    linkable = F.col("label").isNotNull() & usable(F.col("embedding"))
    whole = isinstance(vectors.schema["label"].dataType, T.IntegralType)
    group = F.col("label").cast("long") if whole else F.xxhash64("label")
    rows = vectors.select("vec_id", "label", "embedding", *keys).where(linkable)
    # Nodes are numbered as they are written, so that an id that stands twice names none.
    nodes = saved(
        rows.groupBy("label", "k1", "k2")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("embedding").alias("vector"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    found = saved(links_of_vectors(nodes.select(group.alias("label"), "node", "copies", "vector"), least))
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    reach = components(found.where("b is not null").select("a", "b"))
    rooted = (
        nodes.drop("vector")
        .join(counts, "node", "left")
        .join(reach.withColumnRenamed("component_id", "root"), "node", "left")
        .withColumns({"root": F.coalesce("root", "node"), "part": F.pmod(F.xxhash64("node"), F.lit(ROOT_PARTS))})
    )
    # A component may hold a third of all nodes: its smallest id goes to every part of it.
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ROOT_PARTS - 1).cast("long"))).alias("part")
    named = rooted.join(lowest.select("*", parts), ["root", "part"]).select(
        "label", "k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    every = vectors.select(
        "vec_id", F.when(linkable, F.col("label")).alias("label"), *keys
    )
    joined = every.join(named, ["label", "k1", "k2"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
