"""Quality rules under weak supervision.

Rules vote good or bad on a document, or abstain. How often each votes good on good
and on bad documents is estimated from the votes on all documents by
expectation-maximisation, without labels, and the posterior probability that a document is good decides.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import SPACES, let, words_of

WINDOW = 8
#: Words of a block in which different words are counted: their share falls with
#: the length of clean prose, so it is taken at one length.
BLOCK = 256
#: A letter of any script, or a mark on one.
LETTER = r"[\p{L}\p{M}]"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = [*COUNTS, "n_lines", "n_chars_all", "n_capitals", "n_bangs", "n_distinct", "n_letters", "n_letter_words"]


def _repeat_words(words: Column) -> Column:
    """Words in windows of 8 that are found twice or more in the array of words.

    Windows are compared by a 64-bit hash within one document. Only documents
    with a repeated window sort their windows.
    """

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda at, j: F.least(F.coalesce(F.get(starts, j + 1) - at, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def repeated(placed: Column) -> Column:
        twice = F.filter(
            placed,
            lambda one, j: (F.get(placed, j - 1)["h"] == one["h"]) | (F.get(placed, j + 1)["h"] == one["h"]),
        )
        return let(F.sort_array(F.transform(twice, lambda one: one["i"])), covered)

    def of_windows(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(placed, repeated))

    def of_hashes(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1))
        return let(F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, WINDOW))), of_windows)

    hashes = F.transform(words, lambda word: F.xxhash64(word))
    return F.when(F.size(words) > WINDOW, let(hashes, of_hashes)).otherwise(0)


def _distinct_words(words: Column) -> Column:
    """Different words of each block of consecutive words, added up over the whole text."""

    def of_block(start: Column) -> Column:
        return F.size(F.array_distinct(F.slice(words, start, BLOCK)))

    starts = F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)), F.lit(BLOCK))
    return F.aggregate(starts, F.lit(0), lambda total, start: total + of_block(start))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the measures of their whole texts as long columns.

    A null text has none of anything. Columns with the names of measures are
    replaced. The first five are ``COUNTS``; ``n_lines`` counts lines with a word,
    ``n_distinct`` the different words of each block of ``BLOCK``, ``n_letter_words`` the
    words with a letter.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    names = [name for name in docs.columns if name not in MEASURES]
    split = docs.select(
        *names,
        words_of(F.col("text")).alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    words, lines = F.col("_words"), F.col("_lines")
    values = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(words),
        "n_lines": F.size(lines),
        "n_chars_all": F.length(text),
        "n_capitals": F.regexp_count(text, F.lit("[A-Z]")),
        "n_bangs": F.regexp_count(text, F.lit("!")),
        "n_distinct": _distinct_words(words),
        "n_letters": F.regexp_count(text, F.lit(LETTER)),
        "n_letter_words": F.size(F.filter(words, lambda word: word.rlike(LETTER))),
    }
    return split.select(*names, *[value.cast("long").alias(name) for name, value in values.items()])


def votes() -> dict[str, Column]:
    """Vote of each rule from the measures: true for good, false for bad, else null.

    Each rule looks at one measure: it votes good where clean prose lies, bad where it
    hardly ever does, and abstains between and on texts without words. Rules overlap:
    symbols in a text lower its share of letters or of words with a letter, and repeated lines repeat windows.
    """
    words, length = F.col("n_words"), F.col("word_chars")

    def rule(good: Column, bad: Column) -> Column:
        return F.when(words > 0, F.when(good, True).when(bad, False))

    def at_most(measure: str, good: float, bad: float, of: Column = words) -> Column:
        return rule(F.col(measure) <= good * of, F.col(measure) > bad * of)

    def at_least(measure: str, good: float, bad: float, of: Column = words) -> Column:
        return rule(F.col(measure) >= good * of, F.col(measure) < bad * of)

    return {
        "symbols": at_most("n_symbols", 0.02, 0.1),
        "lines": at_most("n_dup_lines", 0.1, 0.3, F.col("n_lines")),
        "windows": at_most("n_repeat_words", 0.1, 0.2),
        "word_length": rule(length.between(4 * words, 7 * words), (length < 3 * words) | (length > 9 * words)),
        "capitals": at_most("n_capitals", 0.1, 0.3, F.col("n_chars_all")),
        "bangs": at_most("n_bangs", 0.02, 0.2),
        "variety": at_least("n_distinct", 0.5, 0.4),
        "letters": at_least("n_letters", 0.85, 0.7, length),
        "letter_words": at_least("n_letter_words", 0.9, 0.8),
    }


#: Where the estimates start, and what they are drawn to: how often a rule votes good on a
#: good and on a bad document (most bad ones have one defect of many), and the share of good ones.
ON_GOOD, ON_BAD, BALANCE = 0.98, 0.8, 0.5
#: Votes that stand for the start: so many, and a share of those cast.
LEAST, DRAW = 100, 0.25


@dataclass(frozen=True)
class RuleModel:
    """How often each rule, if it votes, votes good on good and on bad documents.

    A rule that is right on bad documents (it sees their defect) outweighs several that
    find nothing, and one whose bad votes fall on documents that all others find good is outvoted by them.
    """

    on_good: dict[str, float]
    on_bad: dict[str, float]
    balance: float

    def weights(self, name: str) -> tuple[float, float]:
        """What a good and a bad vote of a rule add to the log-odds of good."""
        good, bad = self.on_good[name], self.on_bad[name]
        return math.log(good / bad), math.log((1 - good) / (1 - bad))

    def posterior(self) -> Column:
        """Probability of good given the votes of :func:`votes`; silence says nothing."""
        odds = F.lit(math.log(self.balance / (1 - self.balance)))
        for name, vote in votes().items():
            good, bad = self.weights(name)
            odds = odds + F.when(vote, good).when(~vote, bad).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))

    def probability(self, names: list[str], pattern: tuple) -> float:
        """The same for one pattern of votes."""
        odds = math.log(self.balance / (1 - self.balance))
        for name, vote in zip(names, pattern):
            if vote is not None:
                odds += self.weights(name)[0 if vote else 1]
        return 1 / (1 + math.exp(-odds))


def _drawn(found: float, of: float, start: float) -> float:
    more = LEAST + DRAW * of
    return (found + start * more) / (of + more)


def estimated(patterns: Iterable[tuple[tuple, int]], names: list[str], rounds: int = 100) -> RuleModel:
    """Expectation-maximisation over vote patterns (votes, documents).

    Each estimate includes a quarter as many votes again, and a hundred, that go as the
    start says. So a few documents change little, no rate reaches 0 or 1, and beyond some
    thousand documents a table and many copies of it give the same.
    """
    patterns = list(patterns)
    model = RuleModel(dict.fromkeys(names, ON_GOOD), dict.fromkeys(names, ON_BAD), BALANCE)
    for _ in range(rounds):
        cast = {name: [0.0, 0.0] for name in names}
        found = {name: [0.0, 0.0] for name in names}
        good_ones = every = 0.0
        for pattern, n in patterns:
            p = model.probability(names, pattern)
            good_ones += n * p
            every += n
            for name, vote in zip(names, pattern):
                if vote is not None:
                    for kind, share in enumerate((p, 1 - p)):
                        cast[name][kind] += n * share
                        found[name][kind] += n * share * vote
        model = RuleModel(
            {name: _drawn(found[name][0], cast[name][0], ON_GOOD) for name in names},
            {name: _drawn(found[name][1], cast[name][1], ON_BAD) for name in names},
            _drawn(good_ones, every, BALANCE),
        )
    return model


def fit_rules(measures: DataFrame) -> RuleModel:
    """Model from the votes on all rows of a table of measures.

    The driver gets one row per pattern of votes, at most 3 to the power of the
    number of rules.
    """
    rules = votes()
    rows = measures.select(*[vote.alias(name) for name, vote in rules.items()]).groupBy(*rules).count().collect()
    counted = sorted(((tuple(row)[:-1], row["count"]) for row in rows), key=str)
    return estimated(counted, list(rules))


def judged(measures: DataFrame, model: RuleModel, least: float = 0.5) -> DataFrame:
    """Measures with ``base_failed``, ``posterior`` and ``kept``.

    Texts of fewer than 20 words, and those with over 30% of their words in
    repeated windows, fail before the rules are asked.
    """
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measures.withColumns({"base_failed": failed, "posterior": model.posterior()}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= least)
    )
