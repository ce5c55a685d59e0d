"""The pipeline's stages on a small table with copies, junk and shared passages."""

import random

import duckdb
import pytest
import sentencepiece
import public_tokenizers
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tillgrid.llm import simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words int, threshold int"


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(6)
    vocabulary = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 8))) for _ in range(400)]

    def prose(n):
        return " ".join(draw.choices(vocabulary, k=n)) + "."

    passage = prose(60)
    texts = [prose(80) for _ in range(40)]
    texts += [texts[0], texts[1], texts[1]]
    texts += [f"{prose(30)} {passage} {prose(30)}" for _ in range(6)]
    texts += ["spam " * 100, " ".join(word + "###" for word in draw.choices(vocabulary, k=60)), "", None, "short one"]
    rows = [(i, text, "en", f"s{i % 3}", len(text or ""), "k", 5, 6) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_stages(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [name for name, _ in corpus_pipeline.STAGES] and len(stages) == 5
    texts = {row["doc_id"]: row["text"] for row in docs.collect()}
    names = list(stages)

    good = stages[names[0]](spark, docs, "").cache()
    assert good.schema == docs.schema or good.columns == docs.columns
    assert {row["doc_id"] for row in good.collect()} == set(range(49))
    assert {tuple(row)[5:] for row in good.collect()} == {("k", 5, 6)}

    once = stages[names[1]](spark, good, "").cache()
    assert {row["doc_id"] for row in once.collect()} == set(range(49)) - {40, 41, 42}

    cut = stages[names[2]](spark, once, "").cache()
    assert cut.columns == docs.columns
    left = {row["doc_id"]: row for row in cut.collect()}
    assert all(left[i]["text"] == texts[i] for i in range(44) if i in left)
    assert all(len(left[i]["text"].split()) <= 62 and left[i]["n_chars"] == len(left[i]["text"]) for i in range(44, 49))

    mix = stages[names[3]](spark, cut, "").cache()
    assert mix.columns == docs.columns
    counts = {row["doc_id"]: row["count"] for row in mix.groupBy("doc_id").count().collect()}
    assert set(counts.values()) <= {1, 2}
    total = cut.agg(F.sum(F.size(F.split("text", " ")))).first()[0]
    taken = mix.agg(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert abs(taken - 1.5 * total) < 400

    coded = stages[names[4]](spark, mix, "").collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert len(coded) == mix.count()
    for row in coded:
        assert list(row["ids"]) == library.encode(left[row["doc_id"]]["text"])
        assert row["decoded"] == left[row["doc_id"]]["text"]


def near_copies_left(spark, rows):
    schema = "doc_id long, text string, source string, row string, h1 int, name string, component_id int"
    made = corpus_pipeline.near_copies(spark, spark.createDataFrame([(*row, "r", 1, "n", 2) for row in rows], schema).repartition(3), "")
    assert made.columns == ["doc_id", "text", "source", "row", "h1", "name", "component_id"]
    return sorted((tuple(row)[:3] for row in made.collect()), key=str)


def test_near_copies_of_ids_that_stand_twice(spark):
    """A text goes only where a copy of it stays."""
    draw = random.Random(8)
    a, b, c = (" ".join(str(draw.randrange(10**6)) for _ in range(300)) for _ in range(3))
    rows = [(2, b, "s"), (5, a, "s"), (5, b, "s"), (7, a + " tail", "s"), (9, c, "s"), (9, c, "s"), (9, c, "t"), (None, c, "s"), (None, a[:900], "s")]
    rows += [(None, "only without an id", "s"), (None, "only without an id", "s"), (3, None, "s"), (4, "", "s"), (4, " ", "s")]
    left = near_copies_left(spark, rows)
    assert (2, b, "s") in left and (5, a, "s") in left and (3, None, "s") in left and (None, "only without an id", "s") in left
    assert [row for row in left if row[1] == c][0][0] == 9 and len([row for row in left if row[1] == c]) == 1
    linked = simhash.fingerprint(a[:900]) ^ simhash.fingerprint(a)
    assert len(left) == 5 + (bin(linked).count("1") > 4)


def test_one_document_of_each_group_stays(spark, docs):
    """The rows that stay are those of brute-force groups of links, one each."""
    rows = docs.union(docs.where("doc_id % 3 = 0").withColumn("doc_id", F.col("doc_id") + 100)).cache()
    listed = rows.collect()
    prints = [simhash.fingerprint(row["text"]) for row in listed]
    group = list(range(len(listed)))
    for i, one in enumerate(prints):
        for j, other in enumerate(prints[:i]):
            if bin(one ^ other).count("1") <= 4:
                group = [group[j] if g == group[i] else g for g in group]
    wanted = {min(row["doc_id"] for row, g in zip(listed, group) if g == own) for own in group}
    assert {row["doc_id"] for row in corpus_pipeline.near_copies(spark, rows, "").collect()} == wanted


def test_stages_of_no_rows(spark, docs):
    table = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        table = stage(spark, table, "")
        assert table.count() == 0


def test_run_and_queries(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    names = __spark_entry__.queries()
    assert {name.split("_")[0] for name in names if name.startswith("op")} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(n for n in __spark_entry__.queries() if n.startswith("op") and not n.startswith(("op11", "op12"))))
def test_queries_return_every_row(spark, name):
    folder = "/root/testdata/sf0.001"
    table = {"op1": "embeddings", "op6": "pages"}.get(name.split("_")[0], "documents")
    made = __spark_entry__.queries()[name](spark, folder)
    assert made.count() == spark.read.parquet(f"{folder}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(n for n in __spark_entry__.oracle_sql() if n.startswith("op")))
def test_queries_against_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.sql(f"create view {table} as select * from '{folder}/{table}.parquet'")
    wanted = duck.sql(__spark_entry__.oracle_sql()[name])
    found = __spark_entry__.queries()[name](spark, folder).select(*wanted.columns)
    assert sorted(map(tuple, found.collect())) == sorted(wanted.fetchall())
