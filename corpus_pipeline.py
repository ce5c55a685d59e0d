"""Pipeline over ``documents``: each stage's result is written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.llm import mixing, passages, pieces, rules, simhash
from tillgrid.llm.common import saved


def _row(docs: DataFrame) -> Column:
    """All columns as one, out of the way of names that operators make."""
    return F.struct(*docs.columns).alias("row")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Measures are taken once and stored beside their row, so that neither the model nor the
    verdict takes them again.
    """
    measures = saved(rules.measured(docs.select("text", _row(docs))).drop("text"))
    return rules.judged(measures, rules.fit_rules(measures)).where("kept").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links, with the settings of ``op4_simhash``.

    It is the one with the smallest id; one without an id stays only where none has
    one, and of several texts of one id the first by a hash does. Rows are told by two hashes of all
    their columns, so an id that stands twice loses nothing but what has a copy. Of
    rows that repeat in every column one stays.
    """
    hashes = [F.xxhash64(*docs.columns).alias("h1"), F.xxhash64(F.lit(1), *docs.columns).alias("h2")]
    name = F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", *hashes).alias("name")
    found = simhash.near_duplicates(docs.select("text", name), "name")
    stays = found.where("name = component_id").select("name.h1", "name.h2").distinct()
    rows = docs.select(_row(docs), *hashes).dropDuplicates(["h1", "h2"])
    return rows.join(stays, ["h1", "h2"], "left_semi").select("row.*")


def passages_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand in an earlier document; ``n_chars`` follows.

    Only texts that lose words change: what they keep is joined by one space. A
    text that loses all its words goes.
    """
    others = F.struct(*[name for name in docs.columns if name != "text"]).alias("row")
    made = passages.without_repeats(docs.select("doc_id", "text", others), "text", "row")
    changed = F.col("n_removed") > 0
    made = made.where(~changed | (F.col("n_removed") < F.col("n_words")))
    values = {name: F.col("text") if name == "text" else F.col(f"row.{name}") for name in docs.columns}
    values["text"] = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    if "n_chars" in values:
        values["n_chars"] = F.when(changed, F.length("kept_text").cast("long")).otherwise(values["n_chars"])
    return made.select(*[value.alias(name) for name, value in values.items()])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, ``ids`` and their number, and the decoded text."""
    coded = pieces.with_pieces(docs.select("doc_id", "source", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded")


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_copies),
    ("substring dedup", passages_once),
    ("mixing sources", mix),
    ("SentencePiece encoding", encode),
]

#: SQL has no counterpart of expectation-maximisation and of the hashes used.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
