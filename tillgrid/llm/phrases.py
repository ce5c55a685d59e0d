"""Phrase collocations: frequent phrases by sampling and a full count, scored by their weakest cut."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrid.llm.common import saved, slices

#: Words of the longest phrase, occurrences of a frequent one, phrases of a language that are reported.
LONGEST, LEAST, TOP = 5, 100, 2000
#: One document in ``SAMPLE`` proposes phrases: those with at least ``LOWERED`` of the
#: occurrences that a frequent phrase has there on average.
SAMPLE, LOWERED = 8, 0.5
#: Share of all words up to which the occurrences of failures are extended at once.
LOOK_AHEAD = 1 / 16
#: Bits of the table that tells tasks which phrases are known, as a power of two. It has
#: this size whatever the input; a phrase taken for known by chance is counted in vain.
BITS = 27
#: Bytes of texts that a task looks at together.
CHUNK = 2 << 20
#: An occurrence weighs 2 to the power of ``UNIT`` and, below ``CHECK``, a second hash of its phrase, so that
#: one sum tells both how many there are and whether they are of one phrase.
UNIT, CHECK = 24, np.uint64((1 << 16) - 1)
#: Parts in which the best phrases of a language are looked for before they meet.
TOP_PARTS = 64

#: Separators of pieces become full stops, A to Z small letters; words have neither.
_TABLE = bytes.maketrans(b",;:!?\n\x0b\x0c\r" + bytes(range(65, 91)), b"." * 9 + bytes(range(97, 123)))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: bytes) -> list[bytes]:
    """Words in order, with full stops where pieces end."""
    return text.translate(_TABLE).replace(b".", b" . ").split()


def _spread(hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase with one word more."""
    mixed = (hashes ^ (hashes >> np.uint64(29))) * _FACTOR
    return mixed + word


def _named(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes that end in the number of words, in three bits."""
    return (hashes & ~np.uint64(7)) | np.uint64(k)


def _slots(names: np.ndarray) -> np.ndarray:
    return ((names ^ (names >> np.uint64(32))) * _FACTOR) >> np.uint64(64 - BITS)


def _holds(table: np.ndarray, hashes: np.ndarray, k: int) -> np.ndarray:
    slots = _slots(_named(hashes, k))
    return (table[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63))) & np.uint64(1) != 0


_word_hash = lru_cache(maxsize=200_000)(xxhash.xxh3_128_digest)


def _hashes(words: list[bytes]) -> np.ndarray:
    """Two hashes of each word, in two rows."""
    return np.frombuffer(b"".join(map(_word_hash, words)), ">u8").reshape(-1, 2).T.astype(np.uint64)


def _weights(checks: np.ndarray) -> np.ndarray:
    return (np.uint64(1 << UNIT) | (checks & CHECK)).view(np.int64)


def _kinds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys, a place of each, and the number of each key among them."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    index = np.empty(len(keys), np.int64)
    index[order] = np.cumsum(new) - 1
    return ordered[new], order[new], index


@dataclass(frozen=True)
class _Level:
    """Phrases of ``k`` words of a chunk: two hashes, occurrences, which are new, and how to get their words."""

    k: int
    hashes: np.ndarray
    checks: np.ndarray
    counts: np.ndarray
    new: np.ndarray
    words: Callable[[np.ndarray], list[pa.Array]]

    def names(self, wanted: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Texts and occurrences of the wanted phrases that occur."""
        at = np.flatnonzero(wanted & (self.counts > 0))
        parts = self.words(at)
        return (pc.binary_join_element_wise(*parts, b" ") if self.k > 1 else parts[0]), self.counts[at]


class _Chunk:
    """Words of one language, and how often each of their phrases occurs.

    The first ``seen`` words belong to what came before: phrases that end in them have been
    counted.
    """

    def __init__(self, lang: str, tokens: list[bytes], seen: int):
        coded = pa.array([b".", *tokens], pa.binary()).dictionary_encode()
        self.ids = coded.indices.to_numpy()[1:].astype(np.int64)
        self.words = coded.dictionary
        self.seen = seen
        self.name = lang
        self.hashes, self.checks = _hashes(self.words.to_pylist())
        self.lang = _hashes([lang.encode()])[:, 0]

    def levels(
        self, longest: int, known: np.ndarray | None, done: np.ndarray | None, ahead: bool, frequent: np.ndarray | None = None
    ) -> Iterator[_Level]:
        """Phrases by their number of words.

        One of two words or more is looked at only if both its parts of a word less are
        ``known``; it is new if not both are ``done``, or if one is itself new: ``done`` holds some
        phrases by chance that no pass has looked at. With ``ahead`` a new phrase is at
        once known to longer ones. Others are left out if their hash is not ``frequent``, where that is given:
        no longer phrase around them can be.
        """
        ids, size = self.ids, len(self.words)
        own, hashes, checks = ids, _spread(np.full(size, self.lang[0]), self.hashes), _spread(np.full(size, self.lang[1]), self.checks)
        # The first word of the list is the full stop.
        valid, new = ids != 0, np.zeros(size, bool)
        counts = np.bincount(ids[self.seen:], minlength=size)
        counts[0] = 0
        yield _Level(1, hashes, checks, counts, np.full(size, done is None), lambda at: [self.words.take(pa.array(at))])
        for k in range(2, longest + 1):
            if known is None:
                return
            inside = valid & (_holds(known, hashes, k - 1) | (new & ahead))[own]
            starts = np.flatnonzero(inside[:-1] & inside[1:])
            before = np.zeros(len(hashes), bool) if done is None else _holds(done, hashes, k - 1) & ~new
            if frequent is not None:
                wanted = _holds(frequent, _spread(hashes[own[starts]], self.hashes[ids[starts + k - 1]]), k)
                starts = starts[wanted | ~(before[own[starts]] & before[own[starts + 1]]) if ahead else wanted]
            if not len(starts):
                return
            kinds, first, index = _kinds(own[starts] * size + ids[starts + k - 1])
            begin = starts[first]
            new = ~(before[own[begin]] & before[own[begin + 1]])
            shorter, last = kinds // size, kinds % size
            hashes, checks = _spread(hashes[shorter], self.hashes[last]), _spread(checks[shorter], self.checks[last])
            counts = np.bincount(index[starts + k > self.seen], minlength=len(kinds))
            yield _Level(
                k, hashes, checks, counts, new, lambda at: [self.words.take(pa.array(ids[begin[at] + j])) for j in range(k)]
            )
            own, valid = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
            own[starts], valid[starts] = index, True


def _pieces(texts: list[str]) -> Iterator[tuple[bytes, bool]]:
    """Texts in stretches of about ``CHUNK`` bytes, and whether each goes on from the one before.

    A longer text is cut at a space.
    """
    held, size = [], 0
    for text in texts:
        data = text.encode()
        if size + len(data) > CHUNK and held:
            yield b".".join(held), False
            held, size = [], 0
        at = 0
        while len(data) - at > CHUNK:
            cut = data.find(b" ", at + CHUNK)
            if cut < 0:
                break
            yield data[at:cut], at > 0
            at = cut
        if at:
            yield data[at:], True
        else:
            held.append(data)
            size += len(data)
    if held:
        yield b".".join(held), False


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunk]:
    """Chunks of texts (text, lang)."""
    for batch in (part for whole in batches for part in slices(whole, 0, CHUNK)):
        # What earlier work of this worker has left.
        pa.default_memory_pool().release_unused()
        texts, langs = batch.column(0), np.array(batch.column(1).to_pylist(), object)
        for lang in dict.fromkeys(langs.tolist()):
            own = texts.take(pa.array(np.flatnonzero(langs == lang)))
            before: list[bytes] = []
            for data, goes_on in _pieces([text for text in own.to_pylist() if text]):
                context = before[1 - LONGEST:] if goes_on else []
                before = context + tokens_of(data)
                if before:
                    yield _Chunk(lang, before, len(context))


def _value(table: Broadcast | None) -> np.ndarray | None:
    return None if table is None else table.value


def _screening(lengths: set[int], known: Broadcast | None, done: Broadcast | None, ahead: bool):
    """(h, s) of new phrases by their hash, ``s`` the weight of their occurrences; 0 stands for all words, by their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            names, sums = [np.zeros(1, np.uint64)], [np.array([np.count_nonzero(chunk.ids[chunk.seen:])])]
            for level in chunk.levels(max(lengths), _value(known), _value(done), ahead):
                if level.k in lengths:
                    at = level.new & (level.counts > 0)
                    names.append(_named(level.hashes[at], level.k))
                    sums.append(level.counts[at] * _weights(level.checks[at]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(names).view(np.int64)), pa.array(np.concatenate(sums))], names=["h", "s"]
            )

    return run


def _telling(frequent: Broadcast):
    """(h, lang, phrase, weight) of phrases with a frequent hash, each hash told once by a task; the weight is that of one occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        untold = frequent.value.copy()
        for chunk in _chunks(batches):
            for level in chunk.levels(LONGEST, frequent.value, None, False, frequent.value):
                wanted = _holds(untold, level.hashes, level.k) & (level.counts > 0)
                phrases, _ = level.names(wanted)
                names = _named(level.hashes[wanted], level.k)
                slots = _slots(names)
                bits = np.left_shift(np.uint64(1), slots & np.uint64(63))
                np.bitwise_and.at(untold, (slots >> np.uint64(6)).astype(np.int64), ~bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names.view(np.int64)), pa.array([chunk.name] * len(names), pa.string()),
                        phrases.cast(pa.string()), pa.array(_weights(level.checks[wanted])),
                    ],
                    names=["h", "lang", "phrase", "weight"],
                )

    return run


def _naming(asked: Broadcast, frequent: Broadcast, known: Broadcast, done: Broadcast, ahead: bool):
    """(lang, phrase, n) of phrases with an ``asked`` hash, and ahead also of new ones; the empty phrase stands for all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            parts = [(pa.array([b""], pa.binary()), np.array([np.count_nonzero(chunk.ids[chunk.seen:])]))]
            for level in chunk.levels(LONGEST, known.value, done.value, ahead, frequent.value):
                wanted = _holds(asked.value, level.hashes, level.k)
                parts.append(level.names(wanted | level.new if ahead else wanted))
            phrases = pa.concat_arrays([phrases for phrases, _ in parts]).cast(pa.string())
            langs = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(phrases), np.int32)), pa.array([chunk.name]))
            counts = pa.array(np.concatenate([counts for _, counts in parts]))
            yield pa.RecordBatch.from_arrays([langs.cast(pa.string()), phrases, counts], names=["lang", "phrase", "n"])

    return run


def _screened(
    texts: DataFrame, lengths: set[int], least: int, known: Broadcast | None = None, done: Broadcast | None = None, ahead: bool = False
) -> DataFrame:
    """Hashes of phrases that are found ``least`` times or more, with the weight of their occurrences, and 0 for all words.

    Phrases of one hash count together, so no frequent one is missed. From 256 times on the weight
    may be that of slightly more.
    """
    rows = texts.select("text", "lang").mapInArrow(_screening(lengths, known, done, ahead), "h long, s long")
    return saved(rows.groupBy("h").agg(F.sum("s").alias("s")).where((_times("s") >= least) | (F.col("h") == 0)))


def _times(weight: str) -> Column:
    return F.shiftright(weight, UNIT)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word of the table and the bit in it, of hashes."""
    for batch in batches:
        slots = _slots(batch.column(0).to_numpy().view(np.uint64))
        bits = np.left_shift(np.uint64(1), slots & np.uint64(63)).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array((slots >> np.uint64(6)).astype(np.int32)), pa.array(bits)], names=["place", "bits"]
        )


def _table(found: DataFrame) -> np.ndarray:
    """Bits of all hashes but 0. The driver gets at most the whole table, 2 to the power of ``BITS`` bits."""
    places = found.where("h <> 0").select("h").mapInArrow(_places, "place int, bits long")
    rows = places.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (BITS - 6), np.uint64)
    table[rows["place"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return table


def _unknown(table: Broadcast):
    """Rows (h, s) of phrases that the table does not hold and that a longer one may contain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_numpy().view(np.uint64)
            slots = _slots(names)
            held = (table.value[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63))) & np.uint64(1) != 0
            longer = (names & np.uint64(7)).astype(int)
            yield batch.filter(pa.array(~held & (longer >= 1) & (longer < LONGEST)))

    return run


def _words(phrase: str | Column) -> Column:
    return F.split(phrase, " ")


def frequent_phrases(texts: DataFrame, least: int = LEAST, sample: int = SAMPLE) -> DataFrame:
    """(``lang``, ``phrase``, ``n``) of all phrases of ``texts`` (text, lang) that occur ``least`` times or more.

    Counts are exact and the result is complete whatever the sample. A part of the
    documents proposes phrases of one, two, and more words. A pass over all documents
    then counts them and their border, the phrases whose parts are all proposed,
    by hash. What turns out frequent in the border, words included, may have frequent
    extensions that nobody counted: further passes count the border that they add, until
    no frequent phrase is in it.

    The words of a frequent hash are looked up in that part of the documents. They have the hash's
    occurrences if the weight of all of these is a multiple of theirs. The last pass
    counts by their words the others: what that part does not have, and phrases of one hash, which so
    come apart.

    Where failures have few occurrences the last pass looks ahead instead of another
    one: it counts every extension of theirs whose other parts are known. That
    closes the border at once, as a frequent phrase still uncounted would
    have a shortest uncounted part. The empty phrase has the number of all words of a language.
    """
    context = texts.sparkSession.sparkContext
    lengths = set(range(1, LONGEST + 1))
    asked = saved(texts.where(F.pmod(F.xxhash64("text", "row"), F.lit(sample)) == 0))
    lowered = max(1, int(least / sample * LOWERED))
    proposed = np.zeros(1 << (BITS - 6), np.uint64)
    # Of three words on phrases are few, so that all longer ones are looked at in one pass.
    for k in ({1}, {2}, set(range(3, LONGEST))):
        known = context.broadcast(proposed) if proposed.any() else None
        proposed = proposed | _table(_screened(asked, k, lowered, known, ahead=True))

    known = done = context.broadcast(proposed)
    found = _screened(texts, lengths, least, known)
    hashed = found
    total = found.where("h = 0").agg(F.sum("s")).first()[0] or 0
    frequent, ahead = _table(found), False
    while True:
        failed = saved(found.mapInArrow(_unknown(known), "h long, s long"))
        occurrences = failed.agg(F.sum(_times("s"))).first()[0] or 0
        if not occurrences:
            break
        ahead = occurrences <= LOOK_AHEAD * total
        done, known = known, context.broadcast(known.value | _table(failed))
        if ahead:
            break
        found = _screened(texts, lengths - {1}, least, known, done)
        frequent, hashed = frequent | _table(found), hashed.union(found)

    every = context.broadcast(frequent)
    told = asked.select("text", "lang").mapInArrow(_telling(every), "h long, lang string, phrase string, weight long")
    told = told.groupBy("h").agg(F.min(F.struct("lang", "phrase", "weight")).alias("told"))
    hashed = hashed.where("h <> 0").groupBy("h").agg(F.sum("s").alias("s")).join(told, "h", "left")
    hashed = saved(hashed.select("h", "s", "told", (F.col("s") % F.col("told.weight") == 0).alias("alike")))
    left = context.broadcast(_table(hashed.where("alike is not true")))
    rows = texts.select("text", "lang").mapInArrow(
        _naming(left, every, known, done, ahead), "lang string, phrase string, n long"
    )
    counted = rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    alike = hashed.where("alike").select("told.lang", "told.phrase", F.expr("s div told.weight").alias("n"))
    # The last pass may count some of these, too, where the table holds them by chance.
    both = counted.union(alike).where((F.col("n") >= least) | (F.col("phrase") == ""))
    return saved(both.groupBy("lang", "phrase").agg(F.max("n").alias("n")))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, sample: int = SAMPLE) -> DataFrame:
    """The ``top`` phrases of each language by their weakest cut: lang, rank, phrase, a, l, r, n, score.

    A cut's score is floor(1000 a n / (l r)) for a phrase that occurs ``a`` times, its
    parts ``l`` and ``r`` times, among ``n`` words. Phrases that never occur
    outside a longer one are dropped. A null text is empty, a null language ``und``;
    rows may repeat and count each time. Needs ``text`` and ``lang`` alone; ``doc_id``, where there is one,
    helps to spread copies over the sample. An empty table gives none.
    """
    row = F.col("doc_id") if "doc_id" in docs.columns else F.monotonically_increasing_id()
    texts = docs.select(
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"), row.alias("row")
    )
    counted = frequent_phrases(texts, least, sample)
    totals = counted.where("phrase = ''").select("lang", F.col("n").alias("all_words"))
    phrases = counted.where("phrase <> ''").where(F.col("n") >= least)

    words = phrases.select("lang", "phrase", F.col("n").alias("a"), _words("phrase").alias("w")).where("size(w) > 1")
    size = F.size("w")
    cuts = F.sequence(F.lit(1), size - 1)
    halves = words.select("lang", "phrase", "a", size.alias("k"), "w", F.explode(cuts).alias("cut")).select(
        "lang", "phrase", "a", "k", "cut",
        F.inline(F.array(
            F.struct(F.lit(0).alias("side"), F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("part"), F.col("cut").alias("part_k")),
            F.struct(F.lit(1).alias("side"), F.array_join(F.slice("w", F.col("cut") + 1, F.col("k")), " ").alias("part"), (F.col("k") - F.col("cut")).alias("part_k")),
        )),
    )
    # A phrase inside a longer one of equal count is inside one that is longer by a word, too.
    around = (
        halves.where((F.col("part_k") == F.col("k") - 1) & (F.col("part_k") > 1))
        .groupBy("lang", F.col("part").alias("phrase"))
        .agg(F.max("a").alias("longer"))
    )
    parts = phrases.select("lang", F.col("phrase").alias("part"), "n")
    cut = halves.join(parts, ["lang", "part"]).groupBy("lang", "phrase", "a", "cut").agg(
        F.max(F.when(F.col("side") == 0, F.col("n"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("n"))).alias("r")
    )

    def exact(name: str) -> Column:
        return F.col(name).cast("decimal(19,0)")

    over, under = exact("a") * F.lit(1000).cast("decimal(4,0)") * exact("all_words"), exact("l") * exact("r")
    # A language may have most of the rows, so its total goes to every part of them.
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
    totals = totals.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(TOP_PARTS - 1).cast("long"))))
    scored = cut.withColumn("part", part).join(totals, ["lang", "part"]).drop("part").withColumn("score", F.call_function("div", over.cast("decimal(38,0)"), under.cast("decimal(38,0)")))
    weakest = scored.groupBy("lang", "phrase", "a", "all_words").agg(F.min(F.struct("score", "cut", "l", "r")).alias("weakest"))
    kept = weakest.join(around, ["lang", "phrase"], "left").where("longer is null or longer < a")
    kept = kept.select("lang", "phrase", "a", "weakest.l", "weakest.r", F.col("all_words").alias("n"), "weakest.score")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = kept.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best)))
    ranked = some.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
