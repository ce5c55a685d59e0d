"""Mixing sources to target weights by nested hash thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrid.llm.common import saved, words_of

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST_TIMES = 1.5, 2.0
#: Levels of the histogram and bits of the hash each of them looks at.
LEVELS, BITS = 4, 12
#: Sources whose plan goes to every task, and parts that rows of more sources are dealt to.
MOST_SENT, SALTS = 50_000, 32


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0, by the code points of ``source``, null last.

    Sorted in ranges, which are numbered apart; the number of rows of the ranges before is added.
    """
    placed = saved(sources.sort(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()))
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    parts = placed.groupBy(part.alias("part")).count()
    before = parts.withColumn("before", F.sum("count").over(Window.orderBy("part")) - F.col("count"))
    joined = placed.withColumn("part", part).join(before.drop("count"), "part")
    return joined.withColumn("rank", F.col("before") + within).drop("at", "part", "before")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most_times: float = MOST_TIMES
) -> DataFrame:
    """(``source``, ``source_size``, ``target``) from a table with ``source`` and ``size``.

    Sources take the weights in turn, in the order of their code points, null
    last. A share by weight stops at ``most_times`` its source, and what is left of it goes to the
    others by weight; what nobody can take is left out. The share of one unit of weight only rises from
    round to round, so a round asks for two sums over the sources: what has stopped, and the
    weight of the rest. The driver holds these sums and no list of sources.
    """
    sums = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))
    own = F.get(F.array(*[F.lit(float(weight)) for weight in weights]), F.pmod("rank", F.lit(len(weights))).cast("int"))
    sources = saved(_numbered(sums).select("source", "source_size", own.alias("weight")))
    every, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    rest, stopped = share * (every or 0), 0
    while True:
        # No weight is left once all have stopped.
        offer = F.lit(rest) * F.col("weight") / F.lit(weight) if weight else F.lit(float("inf"))
        above = offer > most_times * F.col("source_size")
        n, size, weight_left = sources.agg(
            F.count_if(above), F.sum(F.when(above, F.col("source_size"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == stopped:
            break
        rest, weight, stopped = share * every - most_times * size, weight_left, n
    target = F.when(above, most_times * F.col("source_size")).otherwise(offer)
    return sources.select("source", "source_size", target.alias("target"))


def _with_source(rows: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined to a table of one row per source by ``source``, null like any other.

    Up to ``MOST_SENT`` sources go to every task. More are repeated once per salt, by which the rows
    of a source are dealt, as one source may hold a third of all rows.
    """
    table = table.withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    if table.count() <= MOST_SENT:
        return rows.join(F.broadcast(table), same, how).drop("_source")
    table = table.withColumn("_salt_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64("h"), F.lit(SALTS)).cast("int"))
    return dealt.join(table, same & (F.col("_salt") == F.col("_salt_of")), how).drop("_source", "_salt", "_salt_of")


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(``source``, ``times``, ``threshold``): rows below it are taken once more.

    ``rows`` has ``source``, ``size`` and ``h``, a hash of ``LEVELS * BITS`` bits. A source
    whose target is at least its size is taken ``times`` = 1 times whole, or twice,
    and the rest of the budget by the threshold. Each level sums sizes by source
    and hash bucket, finds the bucket in which the budget ends, and only its rows
    go to the next level with finer buckets. The threshold ends at whichever
    border of the last bucket is nearer to the budget; that bucket holds rows of
    one hash, or one in 2^48 of the source. A source without a rest of the budget has the threshold 0.
    Null and other sources alike.
    """
    state = targets.select(
        "source",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("times"),
        "source_size",
        "target",
    ).select(
        "source", "times", (F.col("target") - F.col("times") * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("start"),
    ).withColumn("spent", F.col("budget") <= 0)
    inside, span = rows, LEVELS * BITS
    for _ in range(LEVELS):
        span -= BITS
        bucket = F.shiftright(F.col("h"), span)
        sums = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"))
        order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        ends = sums.withColumn("until", F.sum("size").over(order))
        joined = ends.alias("e").join(state.alias("s"), F.col("e.source").eqNullSafe(F.col("s.source")))
        # The first bucket whose end is past the budget; none if all fit.
        past = joined.where("e.until > s.budget").groupBy("s.source").agg(
            F.min(F.struct("e.bucket", "e.size", "e.until")).alias("edge")
        )
        state = saved(
            state.alias("s")
            .join(past.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")), "left")
            .select(
                "s.source",
                "s.times",
                "s.spent",
                F.when(F.col("p.edge").isNull(), F.col("s.budget")).otherwise(
                    F.col("s.budget") - (F.col("p.edge.until") - F.col("p.edge.size"))
                ).alias("budget"),
                F.coalesce(F.shiftleft(F.col("p.edge.bucket"), span), F.col("s.start")).alias("start"),
                F.col("p.edge.size").alias("edge_size"),
            )
        )
        edges = state.where("edge_size is not null").select("source", F.shiftright(F.col("start"), span).alias("edge"))
        inside = _with_source(inside, edges).where(F.shiftright(F.col("h"), span) == F.col("edge")).drop("edge")
    up = (F.col("edge_size") - F.col("budget")) < F.col("budget")
    return state.select(
        "source",
        "times",
        F.when(F.col("spent"), 0)
        .when(F.col("edge_size").isNull() & (F.col("budget") > 0), F.lit(1 << (LEVELS * BITS)))
        .when(up, F.col("start") + 1)
        .otherwise(F.col("start"))
        .alias("threshold"),
    )


def row_hash(key: Column) -> Column:
    """Hash of a key that the thresholds cut; rows of equal keys are taken together."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - LEVELS * BITS)


def taken_times(docs: DataFrame, key: str, plan: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``plan`` and ``copies``, how often the mix takes the row.

    ``plan`` has one row per source. ``docs`` must have no column ``h``.
    """
    joined = _with_source(docs.withColumn("h", row_hash(F.col(key))), plan, "left")
    more = (F.col("h") < F.col("threshold")).cast("long")
    return joined.withColumn("copies", F.col("times") + more).drop("h")


def mix_plan(sizes: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per source with size, target, times and threshold, from ``key``, ``source``, ``size``."""
    targets = source_targets(sizes)
    cuts = thresholds(sizes.select("source", "size", row_hash(F.col(key)).alias("h")), targets)
    joined = targets.alias("t").join(cuts.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")))
    return saved(joined.select("t.*", "c.times", "c.threshold"))


def mixed(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` of every document.

    Null texts have the size 0, an empty table gives none. No document is taken
    more than twice, as no target exceeds twice its source.
    """
    sizes = saved(docs.select(key, "source", word_count(F.col("text")).alias("size")))
    placed = taken_times(sizes, key, mix_plan(sizes, key))
    return placed.select(
        key, "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def repeated(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them, with their columns."""
    sizes = saved(docs.select(key, "source", word_count(F.col("text")).alias("size")))
    rows = docs.select(key, "source", F.struct(*docs.columns).alias("row"))
    placed = taken_times(rows, key, mix_plan(sizes, key).select("source", "times", "threshold"))
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return placed.where("copies > 0").select("row", again).select("row.*")
