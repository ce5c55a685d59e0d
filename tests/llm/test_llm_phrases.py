"""Phrase mining against a count of every phrase."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillgrid.llm import phrases

LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, n string, phrase string, part int, row string"


def pieces_of(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def counts_of(rows):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            totals[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i: i + k]) for i in range(len(words) - k + 1))
    return counts, totals


def mined(rows, least, top):
    counts, totals = counts_of(rows)
    made = []
    for lang, own in counts.items():
        found = []
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            cuts = [(1000 * a * totals[lang] // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            inside = any(
                len(q) > len(p) and b >= a and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            )
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            made.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return made


def made_rows(n, seed):
    draw = random.Random(seed)
    words = ["the", "The", "a", "é", "É", "of", "x\xa0y", "non-stop", "\x1c", "日本", "n"] + [f"w{i}" for i in range(12)]
    set_phrases = ["new york city", "as a matter of fact", "new york"]
    rows = [(None, "en"), ("", None), (" .,;\t\n\r\x0b\x0c ", "en"), ("one", "xx")]
    for _ in range(n):
        parts = [draw.choice(set_phrases) if draw.random() < 0.2 else draw.choice(words) for _ in range(draw.randint(1, 60))]
        text = "".join(part + draw.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!? "]) for part in parts)
        rows.append((text, draw.choice(["en", "en", "en", "de", None, "und"])))
    return rows + [rows[-1]] * 20 + [("same same same same same same", "en")] * 15


def table(spark, rows):
    return spark.createDataFrame([(i % 50, t, g, "n", "p", 1, "r") for i, (t, g) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("sample", [1, 4, 10**9])
def test_collocations(spark, sample):
    """Sampled well, sampled thinly, and with a sample that proposes nothing."""
    rows = made_rows(200, 1)
    wanted = mined(rows, 12, 15)
    assert {row[0] for row in wanted} >= {"en", "und"} and max(row[1] for row in wanted) == 15
    assert any(len(row[2].split()) == 5 for row in wanted)
    found = phrases.collocations(table(spark, rows).repartition(5), least=12, top=15, sample=sample)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_failures_are_extended_at_once(spark, monkeypatch):
    """Every failure taken as few: one pass has to close the border."""
    monkeypatch.setattr(phrases, "LOOK_AHEAD", 10**6)
    rows = made_rows(150, 2)
    found = phrases.collocations(table(spark, rows), least=10, top=1000, sample=10**9)
    assert sorted(map(tuple, found.collect())) == sorted(mined(rows, 10, 1000))


def test_phrases_of_one_hash_come_apart(spark, monkeypatch):
    """A table of 64 bits holds nearly every hash: nothing is screened out, and nothing is miscounted."""
    monkeypatch.setattr(phrases, "_table", lambda found: np.full(1 << (phrases.BITS - 6), ~np.uint64(0)))
    rows = made_rows(60, 5)
    found = phrases.collocations(table(spark, rows), least=10, top=1000)
    assert sorted(map(tuple, found.collect())) == sorted(mined(rows, 10, 1000))


@pytest.mark.parametrize("look_ahead", [0, 10**6])
def test_phrases_known_by_chance_hide_no_longer_one(spark, monkeypatch, look_ahead):
    """The table holds phrases that no pass has looked at; longer ones around them have to be counted."""
    rows = [("a b c d e f", "en")] * 20 + made_rows(40, 6)
    every = np.full(1 << (phrases.BITS - 6), ~np.uint64(0))
    levels = phrases._Chunk("en", [b"a", b"b", b"c", b"d", b".", b"d", b"e", b"f"], 0).levels(3, every, None, False)
    slots = np.concatenate([phrases._slots(phrases._named(level.hashes, 3)) for level in levels if level.k == 3])
    assert len(slots) == 3
    right = phrases._table

    def chance(found):
        table = right(found)
        np.bitwise_or.at(table, (slots >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slots & np.uint64(63)))
        return table

    monkeypatch.setattr(phrases, "_table", chance)
    monkeypatch.setattr(phrases, "LOOK_AHEAD", look_ahead)
    wanted = mined(rows, 10, 1000)
    assert {"a b c d e", "b c d e f"} <= {row[2] for row in wanted}
    found = phrases.collocations(table(spark, rows), least=10, top=1000, sample=10**9)
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_without_ids_or_rows(spark):
    rows = made_rows(100, 3)
    docs = table(spark, rows)
    found = phrases.collocations(docs.select("text", "lang"), least=10, top=1000)
    assert sorted(map(tuple, found.collect())) == sorted(mined(rows, 10, 1000))
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_long_texts_in_stretches(monkeypatch):
    """A phrase over a cut counts once, and texts of one stretch stay apart."""
    monkeypatch.setattr(phrases, "CHUNK", 64)
    rows = [(text, "en") for text, _ in made_rows(60, 4)] + [("w0 " * 200 + "w1.w2 " * 90, "en")]
    counts, _ = counts_of(rows)
    found, before = Counter(), []
    every = np.full(1 << (phrases.BITS - 6), ~np.uint64(0))
    stretches = list(phrases._pieces([text for text, _ in rows if text]))
    assert sum(goes_on for _, goes_on in stretches) > 20
    for data, goes_on in stretches:
        context = before[-4:] if goes_on else []
        before = context + phrases.tokens_of(data)
        for level in phrases._Chunk("en", before, len(context)).levels(5, every, None, False):
            names, n = level.names(level.new)
            found.update({tuple(name.decode().split(" ")): int(c) for name, c in zip(names.to_pylist(), n)})
    assert found == counts["en"]


def test_scores_beyond_64_bits(spark, monkeypatch):
    many = 3 * 10**9
    rows = [("en", "", 4 * many), ("en", "a", many), ("en", "b", many + 1), ("en", "a b", many - 1)]
    counted = spark.createDataFrame(rows, "lang string, phrase string, n long")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *_: counted)
    docs = spark.createDataFrame([("t", "en")], "text string, lang string")
    row = phrases.collocations(docs).first()
    assert tuple(row) == ("en", 1, "a b", many - 1, many, many + 1, 4 * many, 1000 * (many - 1) * 4 * many // (many * (many + 1)))


def frequent(spark, rows, least, sample):
    found = phrases.frequent_phrases(table(spark, rows).select(
        "text", phrases.F.coalesce("lang", phrases.F.lit("und")).alias("lang"), phrases.F.col("doc_id").alias("row")
    ), least, sample)
    return {(lang, tuple(phrase.split(" "))): n for lang, phrase, n in found.select("lang", "phrase", "n").collect() if phrase}


def test_few_rows_for_the_words_of_a_hash(spark, monkeypatch):
    """The last pass counts by words what the sample does not have, not what is frequent."""
    rows, asked = made_rows(60, 7), []
    naming = phrases._naming
    monkeypatch.setattr(phrases, "_naming", lambda *of: asked.append(of[0].value) or naming(*of))
    counts, _ = counts_of([row for row in rows if row[0]])
    wanted = {(lang, p): n for lang, own in counts.items() for p, n in own.items() if n >= 10}
    assert frequent(spark, rows, 10, 1) == wanted
    assert not asked.pop().any()
    assert frequent(spark, rows, 10, 10**9) == wanted
    assert 0 < np.bitwise_count(asked.pop()).sum() <= len(wanted)


def test_hash_of_two_phrases_is_counted_by_words(spark, monkeypatch):
    """A hash whose occurrences weigh no multiple of the phrase told for it goes to the last pass."""
    rows, right = made_rows(60, 8), phrases._screened

    def screened(texts, lengths, least, known=None, done=None, ahead=False):
        found = right(texts, lengths, least, known, done, ahead)
        if 5 not in lengths:
            return found
        # As if another phrase of the same hash occurred five times.
        return found.withColumn("s", phrases.F.expr(f"if(h <> 0 and pmod(h, 16) < 8, s + 5 * ({1 << phrases.UNIT} + 7), s)"))

    monkeypatch.setattr(phrases, "_screened", screened)
    counts, _ = counts_of([row for row in rows if row[0]])
    wanted = {(lang, p): n for lang, own in counts.items() for p, n in own.items() if n >= 10}
    assert frequent(spark, rows, 10, 1) == wanted
