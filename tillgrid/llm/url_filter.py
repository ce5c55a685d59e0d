"""URL filter: host and path rules, and a character model ratio for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import saved, witten_bell

ORDER = 4
#: (verdict, rule); a rule is a host and the start of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Uniform share of a character before any is counted.
UNIFORM = 1 / 256
#: Bins of the calibration: so many for one unit of the score, and at most so far from 0.
BINS, FARTHEST = 50, 20


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, F.lit("://"))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """``host`` and ``path`` of ``url``; both empty without ``://`` or for null."""
    rest = F.coalesce(_after_scheme(F.col("url")), F.lit(""))
    return pages.withColumns(
        {
            "host": F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), CAPITALS, SMALL),
            "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        }
    )


def with_rule(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``rule``: the longest that fits host and path, and its ``rule_verdict``; else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda one: len(one[1])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(slash + path)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return pages.withColumns({"rule": rule, "rule_verdict": verdict})


def _grams(url: Column) -> Column:
    """Each character of the part after the scheme, and the end, after its three predecessors."""
    chars = F.split(F.concat(F.lit("\x02" * (ORDER - 1)), _after_scheme(url), F.lit("\x03")), "")
    joined = F.transform(F.array(chars), lambda own: F.transform(
        F.sequence(F.lit(1), F.size(own) - (ORDER - 1)), lambda i: F.array_join(F.slice(own, i, ORDER), "")
    ))
    return joined[0]


def gram_ratios(grams: DataFrame) -> DataFrame:
    """Log ratio of both models for each ``gram``, from counts ``allowed`` and ``blocked``."""
    chances = witten_bell(grams, ORDER, ["allowed", "blocked"], UNIFORM)
    return chances.select("gram", (F.log("p_allowed") - F.log("p_blocked")).alias("ratio"))


def url_scores(pages: DataFrame) -> DataFrame:
    """(``url_key``, ``score``) of each different url: mean log ratio per character.

    Models are counted over all pages that a rule decides; the counts combine
    before the shuffle, so common characters cost no more than rare ones. A very
    frequent url is scored once.
    """
    urls = pages.where("url is not null").select(
        F.unhex(F.md5("url")).alias("url_key"),
        "url",
        (F.col("rule_verdict") == "allow").cast("long").alias("allow"),
        (F.col("rule_verdict") == "block").cast("long").alias("block"),
    )
    urls = saved(
        urls.groupBy("url_key").agg(
            F.first("url").alias("url"),
            F.coalesce(F.sum("allow"), F.lit(0)).alias("allow"),
            F.coalesce(F.sum("block"), F.lit(0)).alias("block"),
        )
    )
    placed = urls.select("url_key", "allow", "block", F.explode(_grams(F.col("url"))).alias("gram"))
    counts = saved(placed.groupBy("gram").agg(F.sum("allow").alias("allowed"), F.sum("block").alias("blocked")))
    ratios = saved(gram_ratios(counts))
    return placed.select("url_key", "gram").join(ratios, "gram").groupBy("url_key").agg(F.avg("ratio").alias("score"))


def calibrated_threshold(scored: DataFrame) -> float:
    """Score from which on a url is accepted: it parts allowed from blocked pages best.

    Of the bin borders, the one with the largest difference between the shares of
    allowed and of blocked pages above it, the nearest to 0 of several; 0 if one
    kind is missing. The driver gets one row per bin, 2,001 at most.
    """
    bins = F.greatest(F.lit(-BINS * FARTHEST), F.least(F.lit(BINS * FARTHEST), F.floor(F.col("score") * BINS))).cast("int")
    rows = (
        scored.where("rule_verdict is not null and score is not null")
        .groupBy(bins.alias("bin"))
        .agg(F.count_if(F.col("rule_verdict") == "allow").alias("a"), F.count_if(F.col("rule_verdict") == "block").alias("b"))
        .collect()
    )
    allowed, blocked = sum(row["a"] for row in rows), sum(row["b"] for row in rows)
    if not allowed or not blocked:
        return 0.0
    best = None
    for border in range(-BINS * FARTHEST, BINS * FARTHEST + 1):
        above = [row for row in rows if row["bin"] >= border]
        gain = sum(row["a"] for row in above) / allowed - sum(row["b"] for row in above) / blocked
        if best is None or (gain, -abs(border)) > best[0]:
            best = ((gain, -abs(border)), border / BINS)
    return best[1]


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` and ``verdict``.

    The rule's verdict holds where one fits; else a score at or above the
    calibrated threshold allows. A null url has the score 0; rows that repeat keep
    their number, and an empty table stays empty. Columns of these names are
    replaced.
    """
    made = ["host", "path", "rule", "rule_verdict", "score", "verdict", "url_key"]
    given = pages.drop(*made)
    ruled = with_rule(with_host_and_path(given), rules).withColumn("url_key", F.unhex(F.md5("url")))
    scores = saved(url_scores(ruled))
    scored = ruled.join(scores, "url_key", "left")
    threshold = calibrated_threshold(scored)
    score = F.coalesce(F.col("score"), F.lit(0.0))
    by_score = F.when(score >= threshold, "allow").otherwise("block")
    return scored.select(
        *given.columns, "host", "path", "rule", score.alias("score"),
        F.coalesce(F.col("rule_verdict"), by_score).alias("verdict"),
    )
