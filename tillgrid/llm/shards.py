"""Shards by rendezvous hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _draws(key: Column, weights: Sequence[float]) -> list[Column]:
    """One struct (time, shard) per shard; the smallest wins.

    Each pair of key and shard has a uniform hash u; -ln(u) / weight is the time
    of a clock that ticks at the rate of the weight, so a shard is first with a
    probability in proportion to it, and times of other shards don't depend on
    which shards there are.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    draws = []
    for shard, weight in enumerate(weights):
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
        uniform = (bits + F.lit(0.5)) / F.lit(float(2**53))
        draws.append(F.struct((-F.log(uniform) / F.lit(float(weight))).alias("t"), F.lit(shard).alias("shard")))
    return draws


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Shard (from 0) of a key among shards with these weights.

    Depends on the key and the weights alone. Another shard at the end, or a
    larger weight of one shard, moves keys into that shard only. Equal keys and
    null keys share a shard each; ties go to the lower shard.
    """
    return F.array_min(F.array(*_draws(key, weights)))["shard"]


def shard_rows(
    df: DataFrame, key: str, weights: Sequence[float], added: Sequence[float] = (1.0,), buckets: int = 256
) -> DataFrame:
    """``df`` with ``shard``, its place ``slot`` there, and ``grown_shard``.

    ``grown_shard`` is the shard once shards with the weights ``added`` have
    joined. Slots run from 0 without a gap in each shard. They are counted per
    shard and hash bucket and shifted by the rows of the buckets before, so no
    task sees a whole shard; the order is that of bucket, key and the other
    columns. Repeated rows get slots of their own, an empty table stays empty.
    Columns named ``shard``, ``slot`` or ``grown_shard`` are replaced.
    """
    names = [name for name in df.columns if name not in ("shard", "slot", "grown_shard", "_bucket")]
    old, new = _draws(F.col(key), weights), _draws(F.col(key), [*weights, *added])[len(weights):]
    placed = df.select(
        *names,
        F.array_min(F.array(*old)).alias("_first"),
        F.pmod(F.xxhash64(*[F.col(name) for name in names]), F.lit(buckets)).cast("int").alias("_bucket"),
    ).select(
        *names,
        "_bucket",
        F.col("_first.shard").alias("shard"),
        F.array_min(F.array(F.col("_first"), *new))["shard"].alias("grown_shard"),
    )
    counts = placed.groupBy("shard", "_bucket").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("shard", "_bucket").orderBy(*[F.col(name).asc_nulls_last() for name in names])
    return (
        placed.withColumn("_place", F.row_number().over(within))
        .join(starts, ["shard", "_bucket"])
        .select(*names, "shard", (F.col("_start") + F.col("_place") - 1).alias("slot"), "grown_shard")
    )


def document_shards(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Documents in equal shards by ``doc_id``: the law ``key``.

    ``size`` is the UTF-8 bytes of the text plus 1 and ``text_crc32`` the CRC of
    those bytes; a null text counts as an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    sharded = shard_rows(narrow, "doc_id", [1.0] * shards)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
