"""Language-model scores: difference of cross-entropies of two n-gram models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import saved, witten_bell

#: A token is a character; a model looks at the four before it.
ORDER = 5
START = "\x02" * (ORDER - 1)
#: Characters that a task looks at together, and n-grams it adds up before it hands them on.
PART, MOST_HELD = 1_000_000, 1_000_000
#: Models of at most so many n-grams (24 bytes each) go to every task; others are joined.
MOST_SENT = 3_000_000


def _keyed(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in parts: index of the text, key of the n-gram that ends there, and its characters.

    Texts are never cut short: a part of a long one starts with the characters
    before it.
    """
    part: list[str] = []
    owners: list[int] = []
    held = 0

    def made():
        points = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(text) for text in part])
        begin = np.cumsum(sizes) - sizes
        inner = np.ones(len(points), bool)
        for k in range(ORDER - 1):
            inner[begin + k] = False
        at = np.flatnonzero(inner)
        keys = np.zeros(len(at), np.uint64)
        for k in range(ORDER):
            keys = keys * np.uint64(0x9E3779B97F4A7C15) + points[at - (ORDER - 1 - k)] + np.uint64(1)
            keys ^= keys >> np.uint64(29)
        owner = np.repeat(np.array(owners), sizes - (ORDER - 1))
        return owner, keys.view(np.int64), points, at

    for index, text in enumerate(texts):
        text = START + (text or "")
        for start in range(0, len(text) - (ORDER - 1), PART):
            part.append(text[start: start + PART + ORDER - 1])
            owners.append(index)
            held += len(part[-1])
            if held >= PART:
                yield made()
                part, owners, held = [], [], 0
    if part:
        yield made()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, gram, target, background) of what the task reads, added up; every text is in the background."""
    held: list[pd.DataFrame] = []
    size = 0

    def combined() -> pd.DataFrame:
        return pd.concat(held).groupby("key", as_index=False, sort=False).agg(
            {"gram": "first", "target": "sum", "background": "sum"}
        )

    for batch in batches:
        target = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
        for owner, keys, points, at in _keyed(batch.column(0).to_pylist()):
            codes, different = pd.factorize(keys)
            first = np.zeros(len(different), np.int64)
            first[codes[::-1]] = at[::-1]
            text = points[first[:, None] + np.arange(1 - ORDER, 1)].astype("<u4").tobytes().decode("utf-32-le", "replace")
            held.append(pd.DataFrame({
                "key": different,
                "gram": [text[i: i + ORDER] for i in range(0, len(text), ORDER)],
                "target": np.bincount(codes, target[owner], len(different)).astype(np.int64),
                "background": np.bincount(codes, minlength=len(different)).astype(np.int64),
            }))
            size += len(different)
            if size >= MOST_HELD:
                held = [combined()]
                size = len(held[0])
                if size >= MOST_HELD // 2:
                    yield pa.RecordBatch.from_pandas(held[0], preserve_index=False)
                    held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pandas(combined(), preserve_index=False)


def with_membership(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """``doc_id``, ``text`` and whether a text is in ``target``; and the target's share of all characters.

    The target is the documents of quality 1.
    """
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct().withColumn("target", F.lit(True))
    members = docs.select("doc_id", "text").join(good, "doc_id", "left")
    members = members.withColumn("target", F.coalesce("target", F.lit(False)))
    sizes = docs.select("doc_id", F.length("text").alias("size")).join(good, "doc_id", "left")
    every, own = sizes.agg(F.sum("size"), F.sum(F.when(F.col("target"), F.col("size")))).first()
    return members, (own or 0) / every if every else 0.0


def losses(members: DataFrame, share: float) -> DataFrame:
    """(``key``, ``target_loss``, ``background_loss``) of every n-gram of all texts.

    The background is counted over all documents. ``share`` matches both models in size: the background's
    counts stand for what a part of all documents as large as the target has of them.
    Both models share the characters and n-grams of all documents, so each n-gram that a text can
    ask for is there. Counts are added up in the tasks first.
    """
    counts = saved(
        members.select("text", "target")
        .mapInArrow(_count, "key long, gram string, target long, background long")
        .groupBy("key")
        .agg(F.first("gram").alias("gram"), F.sum("target").alias("target"), F.sum("background").alias("background"))
    )
    characters = counts.select(F.substring("gram", ORDER, 1)).distinct().count()
    chances = witten_bell(counts, ORDER, ["target", "background"], 1 / max(1, characters), {"background": share})
    return saved(
        counts.select("key", "gram").join(chances, "gram").select(
            "key", (-F.log("p_target")).alias("target_loss"), (-F.log("p_background")).alias("background_loss")
        )
    )


def _score(sent):
    """Sums of both losses of each text, from a table of all n-grams sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, target, background = sent.value
        for batch in batches:
            sums = np.zeros((3, batch.num_rows))
            for owner, keys, _, _ in _keyed(batch.column(0).to_pylist()):
                codes, different = pd.factorize(keys)
                at = np.searchsorted(table, different)
                for k, loss in enumerate((np.ones(len(table)), target, background)):
                    sums[k] += np.bincount(owner, loss[at][codes], batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])],
                names=[*batch.schema.names[1:], "n_tokens", "target_sum", "background_sum"],
            )

    return run


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, key, n): how often each text, named by two hashes, has each n-gram."""
    for batch in batches:
        h1, h2 = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for owner, keys, _, _ in _keyed(batch.column(0).to_pylist()):
            counted = pd.DataFrame({"at": owner, "key": keys}).groupby(["at", "key"], sort=False).size().rename("n").reset_index()
            at = counted.pop("at").to_numpy()
            made = pd.DataFrame({"h1": h1[at], "h2": h2[at], "key": counted["key"], "n": counted["n"]})
            yield pa.RecordBatch.from_pandas(made, preserve_index=False)


def scored(docs: DataFrame, table: DataFrame, most_sent: int = MOST_SENT) -> DataFrame:
    """Columns of ``docs`` but ``text``, with ``n_tokens``, ``target_sum`` and ``background_sum``."""
    keep = [name for name in docs.columns if name != "text"]
    sums = ["n_tokens", "target_sum", "background_sum"]
    if table.count() <= most_sent:
        rows = table.toArrow().sort_by("key")
        sent = docs.sparkSession.sparkContext.broadcast(tuple(rows[name].to_numpy() for name in rows.column_names))
        schema = docs.select(*keep, F.lit(0).cast("long").alias(sums[0]), *[F.lit(0.0).alias(name) for name in sums[1:]]).schema
        return docs.select("text", *keep).mapInArrow(_score(sent), schema)
    # Names come from the text alone: equal texts have equal scores.
    hashes = {"_h1": F.xxhash64("text"), "_h2": F.xxhash64(F.lit(1), "text")}
    numbered = docs.withColumns(hashes)
    bags = numbered.dropDuplicates([*hashes]).select("text", *hashes).mapInArrow(_bags, "h1 long, h2 long, key long, n long")
    added = bags.join(table, "key").groupBy(F.col("h1").alias("_h1"), F.col("h2").alias("_h2")).agg(
        F.sum("n").alias("n_tokens"),
        *[F.sum(F.col("n") * F.col(f"{name}_loss")).alias(f"{name}_sum") for name in ("target", "background")],
    )
    joined = numbered.drop("text").join(added, [*hashes], "left")
    return joined.select(*keep, *[F.coalesce(name, F.lit(0)).alias(name) for name in sums])


def entropy_differences(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``target_loss``, ``background_loss`` and ``score`` of every document.

    Losses are in nats per character of the whole text; the score is the target's
    loss less the background's, so that lower is closer to the target. A null or
    empty text has no tokens, null losses and the score 0. A null ``doc_id`` is never
    in the target. Without documents in the target both models are uniform and scores are 0.
    """
    members, share = with_membership(docs, labels)
    sums = scored(docs.select("doc_id", "text"), losses(members, share))
    means = {
        f"{name}_loss": F.when(F.col("n_tokens") > 0, F.col(f"{name}_sum") / F.col("n_tokens"))
        for name in ("target", "background")
    }
    return sums.withColumns(means).select(
        "doc_id", "n_tokens", *means,
        F.coalesce(F.col("target_loss") - F.col("background_loss"), F.lit(0.0)).alias("score"),
    )
