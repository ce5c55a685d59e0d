"""Operators on words of texts against brute force: rules, SimHash, passages, mixing, shards."""

import hashlib
import random
import re
from collections import Counter
from unicodedata import category
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillgrid.llm import common, mixing, passages, rules, shards, simhash

SCHEMA = "doc_id long, text string, source string, n_words string, kept string, size int, fp int"


def made_texts():
    draw = random.Random(3)
    vocabulary = ["".join(draw.choices("abcdeé", k=draw.randint(1, 5))) for _ in range(60)]

    def prose(n):
        return " ".join(draw.choices(vocabulary, k=n))

    passage, base = prose(20), prose(60)
    texts = [None, "", " \t\n\x0b\x0c\r ", "One", "Two words", "a b c d", base, base, base.upper(), base + " tail"]
    texts += [prose(draw.randint(1, 50)) + " " + passage + "\n" + prose(draw.randint(0, 40)) for _ in range(25)]
    texts += ["echo " * 50, "x\n" * 30 + "y z\n\n \n x", "a b c d e f g h " * 3 + "i j k", prose(3000), "nbsp\xa0joined \x1c sep"]
    texts += [prose(8) + " # * $ % & | < > !" for _ in range(5)]
    return texts


TEXTS = made_texts()
ROWS = [(i, text, f"s{i % 3}" if i % 7 else None, "n", "k", 1, 2) for i, text in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def odd(spark):
    """Repeated rows, one id with two texts, and null ids."""
    rows = [*ROWS, *ROWS[6:12], (6, "another text of the id six " + TEXTS[20], "s0", "n", "k", 1, 2)]
    rows += [(None, TEXTS[6], "s1", "n", "k", 1, 2), (None, TEXTS[6], "s1", "n", "k", 1, 2)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def union(n, pairs):
    label = list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return [root(i) for i in range(n)]


# Rules


def base_of(text):
    own = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    windows = Counter(tuple(own[i: i + 8]) for i in range(len(own) - 7))
    covered = {j for i in range(len(own) - 7) if windows[tuple(own[i: i + 8])] > 1 for j in range(i, i + 8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures(docs):
    found = {row["doc_id"]: tuple(row[name] for name in rules.COUNTS) for row in rules.measured(docs).collect()}
    assert found == {i: base_of(text) for i, text in enumerate(TEXTS)}


def votes_of(text):
    """Votes by the definition, from the text."""
    own, text = words(text), text or ""
    n, length, symbols, dup_lines, repeated = base_of(text)
    n_lines = sum(1 for line in text.split("\n") if words(line))
    letters = sum(c.isalpha() or category(c)[0] == "M" for c in text)
    with_letter = sum(any(c.isalpha() or category(c)[0] == "M" for c in word) for word in own)
    blocks = [own[at: at + rules.BLOCK] for at in range(0, n, rules.BLOCK)]
    capitals, distinct = sum("A" <= c <= "Z" for c in text), sum(len(set(block)) for block in blocks)

    def rule(good, bad):
        return None if not n else True if good else False if bad else None

    return (
        rule(symbols <= 0.02 * n, symbols > 0.1 * n),
        rule(dup_lines <= 0.1 * n_lines, dup_lines > 0.3 * n_lines),
        rule(repeated <= 0.1 * n, repeated > 0.2 * n),
        rule(4 * n <= length <= 7 * n, length < 3 * n or length > 9 * n),
        rule(capitals <= 0.1 * len(text), capitals > 0.3 * len(text)),
        rule(text.count("!") <= 0.02 * n, text.count("!") > 0.2 * n),
        rule(distinct >= 0.5 * n, distinct < 0.4 * n),
        rule(letters >= 0.85 * length, letters < 0.7 * length),
        rule(with_letter >= 0.9 * n, with_letter < 0.8 * n),
    )


def posteriors_of(votes, rounds=100):
    """Expectation-maximisation document by document, in numpy."""
    cast = np.array([[vote is not None for vote in row] for row in votes], float)
    good = np.array([[vote is True for vote in row] for row in votes], float)
    rates, share = np.array([[0.98] * cast.shape[1], [0.8] * cast.shape[1]]), 0.5

    def posterior():
        like = [np.exp((good * np.log(r) + (cast - good) * np.log(1 - r)).sum(1)) for r in rates]
        return share * like[0] / (share * like[0] + (1 - share) * like[1])

    for _ in range(rounds):
        p = posterior()
        for kind, (weight, start) in enumerate(((p, 0.98), (1 - p, 0.8))):
            n = weight @ cast
            rates[kind] = (weight @ good + start * (100 + n / 4)) / (n + 100 + n / 4)
        share = (p.sum() + 0.5 * (100 + len(p) / 4)) / (len(p) + 100 + len(p) / 4)
    return posterior()


def test_judged(docs, empty):
    """Votes, estimates and verdicts against brute force."""
    measures = rules.measured(docs)
    rows = rules.judged(measures, rules.fit_rules(measures)).select("doc_id", "kept", "base_failed", "posterior").collect()
    assert len(rows) == len(TEXTS)
    cast = {row["doc_id"]: tuple(row)[1:] for row in measures.select("doc_id", *rules.votes().values()).collect()}
    assert cast == {i: votes_of(text) for i, text in enumerate(TEXTS)}
    expected = posteriors_of([votes_of(text) for text in TEXTS])
    for row in rows:
        n, _, _, _, repeated = base_of(TEXTS[row["doc_id"]])
        assert row["posterior"] == pytest.approx(expected[row["doc_id"]])
        assert row["base_failed"] == (n < 20 or 100 * repeated > 30 * n)
        assert row["kept"] == (not row["base_failed"] and expected[row["doc_id"]] >= 0.5)
    model = rules.fit_rules(rules.measured(empty))
    assert model.balance == 0.5 and set(model.on_bad.values()) == {0.8}
    assert rules.judged(rules.measured(empty), model).count() == 0


def test_votes_count_by_what_they_are_worth():
    """A bad vote of an unreliable rule is outvoted; one of a rule that sees a defect is not, nor are two weak ones."""
    names = list("abcdef")
    patterns = Counter({(True,) * 6: 8000})
    # Documents with a defect: ``a`` and ``b`` see it; ``f`` votes bad now and then on any document.
    patterns.update({(False, False, True, True, True, True): 900, (False, False, True, True, True, False): 90})
    patterns.update({(True, True, True, True, True, False): 800})
    model = rules.estimated(patterns.items(), names)
    assert model.probability(names, (True,) * 5 + (False,)) > 0.9
    assert model.probability(names, (False, False, True, True, True, True)) < 0.01
    assert model.probability(names, (False,) + (True,) * 5) < model.probability(names, (True,) * 5 + (False,))
    assert model.probability(names, (None,) * 6) == pytest.approx(model.balance)


def test_verdicts_on_all_documents(spark):
    """Some documents stay against a bad vote and some go without failing the base; nearly no labelled good one goes."""
    sf = "/root/testdata/sf0.01"
    measures = rules.measured(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    judged = rules.judged(measures, rules.fit_rules(measures)).where("not base_failed")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = judged.join(labels, "doc_id").select("kept", "quality").collect()
    good = [row["kept"] for row in rows if row["quality"]]
    assert sum(good) >= 0.98 * len(good)
    assert not any(row["kept"] for row in rows if not row["quality"])
    assert judged.where("not kept").count() > 0


def test_long_clean_text_is_kept(spark):
    """Different words are a small share of long clean prose, and still a small one of each part of poor text."""
    draw = random.Random(13)
    vocabulary = ["".join(draw.choices("abcdefghij", k=draw.randint(3, 8))) for _ in range(8000)]
    weights = [1 / (rank + 30) for rank in range(8000)]
    clean = draw.choices(vocabulary, weights, k=50_000)
    poor = draw.choices(vocabulary[:60], k=50_000)
    assert len(set(clean)) < 0.2 * len(clean)
    table = spark.createDataFrame(
        [(0, " ".join(clean)), (1, " ".join(poor)), (2, " ".join(clean[:300])), (3, " ".join(poor[:300])), (4, "")],
        "doc_id long, text string",
    )
    measures = rules.measured(table)
    rows = {row["doc_id"]: row for row in rules.judged(measures, rules.fit_rules(measures)).collect()}
    assert [rows[i]["kept"] for i in range(5)] == [True, False, True, False, False]
    blocks = [clean[at: at + rules.BLOCK] for at in range(0, len(clean), rules.BLOCK)]
    assert rows[0]["n_distinct"] == sum(len(set(block)) for block in blocks) and rows[4]["n_distinct"] == 0


def test_estimates_follow_planted_rates():
    draw = random.Random(5)
    names, on_good, on_bad = list("abcd"), [0.95, 0.9, 0.97, 0.9], [0.1, 0.3, 0.5, 0.8]
    patterns = Counter()
    for _ in range(20000):
        rates = on_good if draw.random() < 0.7 else on_bad
        patterns[tuple(draw.random() < p for p in rates)] += 1
    model = rules.estimated(patterns.items(), names)
    found = [model.on_bad[name] for name in names]
    assert found == sorted(found) and all(model.on_good[name] > 0.85 for name in names)


# SimHash


def fingerprint_of(text):
    own = [re.sub("[A-Z]", lambda m: m[0].lower(), word) for word in words(text)]
    shingles = [" ".join(own[i: i + 4]) for i in range(max(1, len(own) - 3))] if own else []
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_triples_cover_all_fours():
    from itertools import combinations

    triples = simhash.index_positions()
    assert len(triples) == 20
    assert all(any(set(t) <= set(four) for t in triples) for four in combinations(range(8), 4))


def test_near_duplicates(docs, empty):
    prints = [fingerprint_of(text) for text in TEXTS]
    n = len(prints)
    pairs = [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    expected = dict(enumerate(zip([f"{p:016x}" for p in prints], union(n, pairs))))
    rows = simhash.near_duplicates(docs).withColumn("hex", simhash.hex_digits(F.col("fp"))).collect()
    assert {row["doc_id"]: (row["hex"], row["component_id"]) for row in rows} == expected
    assert simhash.near_duplicates(empty).count() == 0


def test_near_duplicates_keep_rows(odd):
    assert simhash.near_duplicates(odd).count() == odd.count()


@pytest.mark.parametrize("block", [4096, 7])
def test_links_of_dense_and_loose_fingerprints(spark, monkeypatch, block):
    """Hot lists in one block and in many give the components of all pairs."""
    monkeypatch.setattr(simhash, "MOST_IN_BLOCK", block)
    draw = random.Random(9)
    seeds = [draw.getrandbits(64) for _ in range(6)]
    prints = {0, 2**64 - 1}
    for seed in seeds:
        for _ in range(40):
            own = seed
            for bit in draw.sample(range(64), draw.randint(0, 5)):
                own ^= 1 << bit
            prints.add(own)
    prints = sorted(prints)
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    expected = union(len(prints), pairs)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    index = {p: i for i, p in enumerate(signed)}
    found = union(len(prints), [(index[row["a"]], index[row["b"]]) for row in links.collect()])
    assert found == expected


# Components


def test_components(spark):
    draw = random.Random(2)
    pairs = [(draw.randrange(400), draw.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 560)]
    found = common.components(spark.createDataFrame(pairs, "a long, b long").repartition(7)).collect()
    expected = union(600, pairs)
    nodes = {node for a, b in pairs if a != b for node in (a, b)}
    assert {row["node"]: row["component_id"] for row in found} == {node: expected[node] for node in nodes}
    assert len(found) == len(nodes)


# Passages


def removal(rows):
    """(n_words, n_removed, kept text) of rows (id, text)."""
    first = {}
    for i, text in rows:
        own = words(text)
        for k in range(len(own) - 12 if i is not None else 0):
            window = tuple(own[k: k + 13])
            first[window] = min(first.get(window, i), i)
    made = []
    for i, text in rows:
        own, gone = words(text), set()
        for k in range(len(own) - 12 if i is not None else 0):
            if first[tuple(own[k: k + 13])] < i:
                gone.update(range(k, k + 13))
        made.append((i, len(own), len(gone), " ".join(w for k, w in enumerate(own) if k not in gone)))
    return Counter(made)


@pytest.mark.parametrize("hot", [16, 2])
def test_without_repeats(docs, odd, empty, monkeypatch, hot):
    """Also where anchors count as hot and windows go their own ways."""
    monkeypatch.setattr(passages, "LEAST_HOT", hot)
    monkeypatch.setattr(passages, "HOT_ASKED", 1)
    for table in (docs, odd, empty):
        rows = [(row["doc_id"], row["text"]) for row in table.select("doc_id", "text").collect()]
        found = passages.without_repeats(table, "doc_id").collect()
        assert Counter(map(tuple, found)) == removal(rows)


def test_no_anchor_has_more_than_so_many_segments(docs, monkeypatch):
    monkeypatch.setattr(passages, "MOST_TOGETHER", 2)
    rows = [(row["doc_id"], row["text"]) for row in docs.select("doc_id", "text").collect()]
    assert Counter(map(tuple, passages.without_repeats(docs, "doc_id").collect())) == removal(rows)


@pytest.mark.parametrize("letters", [1, 2, 3, 60])
def test_matches_in_earlier_documents(letters):
    """Streamed segments against brute force, with copies, overlaps and one word over and over."""
    import numpy as np
    import pyarrow as pa

    draw = random.Random(letters)
    base = [str(draw.randrange(letters)) for _ in range(90)]
    for _ in range(40):
        segments = []
        for _ in range(draw.randrange(1, 12)):
            start = draw.randrange(60)
            own = base[start: start + draw.randrange(13, 60)]
            own += [str(draw.randrange(letters)) for _ in range(max(13 - len(own), draw.randrange(14)))]
            segments += [" ".join(own)] * draw.choice([1, 1, 2])
        ids = [draw.randrange(6) for _ in segments]
        first, smallest = {}, {}
        for segment, i in zip(segments, ids):
            smallest[segment] = min(smallest.get(segment, i), i)
            own = segment.split()
            for k in range(len(own) - 12):
                window = tuple(own[k: k + 13])
                first[window] = min(first.get(window, i), i)
        which, begins, windows, marks = passages._matched(pa.array(segments), np.array(ids, np.int64))
        for segment, i, own in zip(segments, ids, which):
            found = marks[int(i > smallest[segment]), begins[own]: begins[own] + windows[own]].tolist()
            text = segment.split()
            assert found == [first[tuple(text[k: k + 13])] < i for k in range(len(text) - 12)]


def test_least_of_ranges():
    import numpy as np

    draw = np.random.default_rng(3)
    for n in (1, 2, 3, 64, 65, 200):
        values = draw.integers(0, 50, n)
        low = draw.integers(0, n, 300)
        high = low + 1 + (draw.random(300) * (n - low)).astype(int)
        made = passages.Least(values).between(low, high)
        assert made.tolist() == [values[a:b].min() for a, b in zip(low, high)]


def test_index_finds_all_rows():
    import numpy as np

    draw = np.random.default_rng(1)
    text = np.concatenate([draw.integers(1, 4, 500), [0], draw.integers(1, 4, 300), [0]])
    index = passages.FmIndex(text, 5)
    patterns = draw.integers(1, 5, (200, 5))
    low, high = index.search(np.minimum(patterns, 3))
    for pattern, a, b in zip(np.minimum(patterns, 3), low, high):
        at = [i for i in range(len(text) - 4) if (text[i: i + 5] == pattern).all()]
        assert sorted(index.rows[a:b].tolist()) == at


# Mixing


def targets_of(sizes, weights, share=1.5, most_times=2.0):
    """Targets by stopping sources round by round, from sizes by source."""
    names = sorted((name for name in sizes if name is not None)) + [None] * (None in sizes)
    own = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    targets, rest = {}, share * sum(sizes.values())
    while len(targets) < len(names):
        left = [name for name in names if name not in targets]
        weight = sum(own[name] for name in left)
        above = [name for name in left if rest * own[name] / weight > most_times * sizes[name]]
        targets.update({name: most_times * sizes[name] for name in above})
        if not above:
            targets.update({name: rest * own[name] / weight for name in left})
        rest -= sum(most_times * sizes[name] for name in above)
    return targets


def test_targets(spark):
    draw = random.Random(2)
    many = {f"s{i}é😀"[: draw.randint(2, 7)] + str(i): int(10 ** draw.uniform(0, 6)) for i in range(700)}
    for sizes, weights in (
        ({"a": 100, "b": 100, "c": 100}, (5, 2, 1)), ({"a": 0, "b": 10}, (5, 2)), ({"a": 0, None: 0}, (5, 2, 1)),
        ({"a": 5, None: 7, "B": 1000, "": 3}, (5, 2, 1)), ({}, (5, 2, 1)), ({**many, None: 10**6}, (5, 2, 1)),
    ):
        # Each source in two rows, and one without a size.
        rows = [(name, part) for name, size in sizes.items() for part in (size // 3, size - size // 3, None)]
        table = spark.createDataFrame(rows, "source string, size long").repartition(3)
        found = {row["source"]: (row["source_size"], row["target"]) for row in mixing.source_targets(table, weights).collect()}
        expected = targets_of(sizes, weights)
        assert found.keys() == sizes.keys()
        for name, (size, target) in found.items():
            assert size == sizes[name] and target == pytest.approx(expected[name])


@pytest.mark.parametrize("sent", [mixing.MOST_SENT, 1])
def test_thresholds_by_brute_force(spark, monkeypatch, sent):
    """Rows in the order of their hash up to the border nearest to the budget, also if sources are joined by salts."""
    monkeypatch.setattr(mixing, "MOST_SENT", sent)
    draw = random.Random(8)
    sources = ["hot", "hot", "hot", "b", "c", None]
    rows = [(i, draw.choice(sources), draw.choice([0, 1, 5, 40])) for i in range(1500)]
    rows += [(2000, "one", 9), (2000, "one", 9), (2001, "none", 0), (2002, "none", 0)]
    # A small source with a heavy weight, taken twice whole, with rows of no words.
    rows += [(3000 + i, "a", i % 2) for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, source string, size long")
    hashed = table.withColumn("h", mixing.row_hash(F.col("doc_id")))
    given = [tuple(row) for row in hashed.select("source", "size", "h", "doc_id").collect()]
    sizes = Counter()
    for source, size, _, _ in given:
        sizes[source] += size
    targets, expected = targets_of(sizes, mixing.WEIGHTS), {}
    for source in sizes:
        times = int(targets[source] // sizes[source]) if sizes[source] else 0
        budget, taken = targets[source] - times * sizes[source], set()
        by_hash = Counter()
        for own, size, h, _ in given:
            if own == source:
                by_hash[h] += size
        left = budget
        for h in sorted(by_hash) if budget > 0 else []:
            if by_hash[h] > left:
                if by_hash[h] - left < left:
                    taken.add(h)
                break
            taken.add(h)
            left -= by_hash[h]
        for own, size, h, doc_id in given:
            if own == source:
                expected[doc_id] = times + (h in taken)
    placed = mixing.taken_times(table, "doc_id", mixing.mix_plan(table))
    found = {row["doc_id"]: row["copies"] for row in placed.collect()}
    assert placed.count() == len(rows) and found == expected
    assert max(found.values()) == 2 and {found[i] for i in range(3000, 3040)} == {2}


def test_mixed(docs, odd, empty):
    for table in (docs, odd):
        rows = mixing.mixed(table).collect()
        assert len(rows) == table.count()
        by_source = {}
        for row, given in ((row, TEXTS[row["doc_id"]]) for row in rows if row["doc_id"] is not None):
            assert row["taken"] in (0, row["size"], 2 * row["size"])
        sizes = {row["doc_id"]: row["source"] for row in table.select("doc_id", "source").collect()}
        for row in rows:
            own = by_source.setdefault(sizes[row["doc_id"]], [0, 0, row["target"], row["source_size"], 0])
            own[0] += row["size"]
            own[1] += row["taken"]
            own[4] = max(own[4], row["size"])
        for size, taken, target, source_size, largest in by_source.values():
            assert size == source_size
            assert abs(taken - target) <= 2 * largest
    assert mixing.mixed(empty).count() == 0


def test_thresholds_come_near_the_budget(spark):
    rows = spark.range(20000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 2).alias("source"), (F.col("id") % 50).alias("size")
    )
    placed = mixing.taken_times(rows, "doc_id", mixing.mix_plan(rows))
    for row in placed.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("t"), F.first("target").alias("g")).collect():
        assert abs(row["t"] - row["g"]) <= 50


def test_repeated_rows_follow_the_mix(docs):
    taken = {row["doc_id"]: row["copies"] for row in mixing.mixed(docs).collect()}
    made = mixing.repeated(docs)
    assert made.columns == docs.columns
    assert Counter(row["doc_id"] for row in made.collect()) == +Counter(taken)


# Shards


def shard_of(key, weights):
    import math
    import struct

    times = []
    for shard, weight in enumerate(weights):
        seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        h = xxhash.xxh64_intdigest(struct.pack("<i", shard), seed)
        times.append((-math.log(((h >> 11) + 0.5) / 2**53) / weight, shard))
    return min(times)[1]


def test_document_shards(docs, odd, empty):
    for table in (docs, odd):
        rows = shards.document_shards(table).collect()
        assert len(rows) == table.count()
        slots = {}
        for row in rows:
            if row["doc_id"] is not None:
                assert row["shard"] == shard_of(row["doc_id"], [1.0] * 16)
                assert row["grown_shard"] in (row["shard"], 16)
                assert row["grown_shard"] == shard_of(row["doc_id"], [1.0] * 17)
            slots.setdefault(row["shard"], []).append(row["slot"])
        assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert shards.document_shards(empty).count() == 0
    sizes = {row["doc_id"]: (row["size"], row["text_crc32"]) for row in shards.document_shards(docs).collect()}
    assert sizes == {i: (len((t or "").encode()) + 1, crc32((t or "").encode())) for i, t in enumerate(TEXTS)}


def test_weights_share_out_the_keys(spark):
    weights = [3.0, 1.0, 2.0]
    counts = spark.range(30000).groupBy(shards.rendezvous_shard(F.col("id"), weights).alias("s")).count().collect()
    shares = {row["s"]: row["count"] / 30000 for row in counts}
    assert all(abs(shares[i] - weight / 6) < 0.02 for i, weight in enumerate(weights))
    with pytest.raises(ValueError):
        shards.rendezvous_shard(F.col("id"), [1.0, 0.0])


def test_kept_text_hash(docs):
    rows = passages.without_repeats(docs, "doc_id").select(F.sha2("kept_text", 256).alias("h"), "kept_text").collect()
    assert all(row["h"] == hashlib.sha256(row["kept_text"].encode()).hexdigest() for row in rows)
