"""SimHash near-duplicates through an inverted index of fingerprint bytes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import components, saved, smallest_reachable

SHINGLE, SEED, BYTES = 4, 42, 8
#: Fingerprints link at so many differing bits; each spoils one byte at most, so
#: linked ones share at least the other ``BYTES - LINK_BITS`` positional bytes.
LINK_BITS = 4
SHARED_BYTES = BYTES - LINK_BITS
#: A list of more fingerprints than this is compared in blocks.
MOST_IN_BLOCK = 4096


def index_positions() -> list[tuple[int, ...]]:
    """Triples of byte positions such that any four positions hold one of them.

    Positions fall into three groups in a ring; a triple lies within a group, or
    has two positions in one and the third in the next. There are 20, the fewest
    that do (Turan's covering of 4-subsets of 8 points by triples).
    """
    group = [0, 0, 0, 1, 1, 1, 2, 2]

    def fits(triple: tuple[int, ...]) -> bool:
        counts = [sum(group[i] == g for i in triple) for g in range(3)]
        return max(counts) == 3 or any(counts[g] == 2 and counts[(g + 1) % 3] == 1 for g in range(3))

    return [triple for triple in combinations(range(BYTES), 3) if fits(triple)]


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of the shingles of a whole text, repeats included.

    A text of fewer than four words is one shingle; one without words gives 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(SHINGLE, len(words))
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist())
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes, max(1, len(hashes) // 65536)):
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = 2 * ones > len(hashes)
    return int(np.packbits(bits).view(">u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = np.array([fingerprint(text) for text in batch.column(0).to_pylist()], np.uint64)
        rest = batch.columns[1:]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(made.view(np.int64))], names=[*batch.schema.names[1:], "fp"]
        )


def with_fingerprint(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``fp``, the fingerprint as a long."""
    schema = docs.select(*keep, F.lit(0).cast("long").alias("fp")).schema
    return docs.select("text", *keep).mapInArrow(_fingerprints, schema)


def _reachable(fps: np.ndarray) -> np.ndarray:
    """For each of several fingerprints the position of the first one reachable by links.

    Tallies the equal bytes of a pair, keeps pairs that share the guaranteed
    number and counts their differing bits. A fingerprint that has been reached
    is not compared again, so a dense group costs little more than one round.
    """
    label = np.full(len(fps), -1)
    left = np.arange(len(fps))
    while len(left):
        first, left = left[0], left[1:]
        label[first] = first
        front = [first]
        while front and len(left):
            differing = fps[left] ^ fps[front.pop()]
            shared = (differing.view(np.uint8).reshape(-1, BYTES) == 0).sum(1) >= SHARED_BYTES
            near = np.flatnonzero(shared)
            near = near[np.bitwise_count(differing[near]) <= LINK_BITS]
            reached = left[near]
            label[reached] = first
            front.extend(reached.tolist())
            left = np.delete(left, near)
    return label


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of fingerprints that lie together under one key.

    Rows come sorted by ``key``; a key goes on over batches, so the last one is
    held back until it is complete.
    """
    held_keys, held_fps = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def link(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        borders = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.concatenate([[0], borders]), np.concatenate([borders, [len(keys)]])
        a, b = [], []
        for start, end in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            own = fps[start:end]
            label = _reachable(own.view(np.uint64))
            moved = np.flatnonzero(label != np.arange(len(own)))
            a.append(own[moved])
            b.append(own[label[moved]])
        if a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"]
            )

    for batch in batches:
        keys = np.concatenate([held_keys, batch.column(0).to_numpy()])
        fps = np.concatenate([held_fps, batch.column(1).to_numpy()])
        whole = int(np.searchsorted(-(keys != keys[-1]).astype(np.int8), 0)) if len(keys) else 0
        held_keys, held_fps = keys[whole:], fps[whole:]
        if whole:
            yield from link(keys[:whole], fps[:whole])
    if len(held_keys):
        yield from link(held_keys, held_fps)


def fingerprint_links(fingerprints: DataFrame) -> DataFrame:
    """Links (a, b) that join all fingerprints reachable from each other.

    ``fingerprints`` has different values ``fp``. A list for one position and byte
    would hold one in 256 of all, so lists are kept for three positions at once:
    of the four or more positions that linked fingerprints share, three form one
    of the kept triples. Lists that are longer than a block are cut into blocks
    by a hash, and every pair of blocks is compared, so that no task holds a whole
    hot list. A list gives a forest of links, never all its pairs.
    """
    byte = [F.shiftrightunsigned(F.col("fp"), 8 * i).bitwiseAND(F.lit(255)) for i in range(BYTES)]
    keys = [
        F.lit(n).cast("long") * F.lit(1 << 24) + byte[i] * F.lit(1 << 16) + byte[j] * F.lit(1 << 8) + byte[k]
        for n, (i, j, k) in enumerate(index_positions())
    ]
    posted = fingerprints.select("fp", F.explode(F.array(*keys)).alias("key"))
    long_lists = posted.groupBy("key").count().where(F.col("count") > MOST_IN_BLOCK)
    blocks = F.ceil(F.col("count") / F.lit(MOST_IN_BLOCK)).cast("long")
    posted = posted.join(long_lists.select("key", blocks.alias("blocks")), "key", "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    others = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.greatest(own, other) * F.col("blocks") + F.least(own, other),
    )
    pairs = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(others)
    posted = posted.select("fp", "key", F.explode(pairs).alias("pair"))
    posted = posted.select(F.when(F.col("pair") == 0, F.col("key")).otherwise(F.xxhash64("key", "pair")).alias("key"), "fp")
    return posted.repartition("key").sortWithinPartitions("key").mapInArrow(_links, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(``key``, ``fp``, ``component_id``) of every document.

    ``component_id`` is the smallest key reachable over links, its own included.
    Equal fingerprints are one node, so copies cost nothing but their row. Rows
    with a null key belong to components but never name one unless all are null;
    an empty table gives an empty one.
    """
    prints = saved(with_fingerprint(docs, key))
    nodes = prints.groupBy("fp").agg(F.min(key).alias("first"))
    links = fingerprint_links(nodes.select("fp"))
    of_node = components(links)
    named = nodes.join(of_node.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "first", F.coalesce("component_id", "fp").alias("root"))
    first = named.groupBy("root").agg(F.min("first").alias("component_id"))
    component = named.join(first, "root").select("fp", "component_id")
    return prints.join(component, "fp").select(key, "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    """16 lower-case hexadecimal digits of a long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
