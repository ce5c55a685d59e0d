"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.llm import (
    classifier,
    lm_scores,
    mixing,
    near_vectors,
    passages,
    phrases,
    pieces,
    rules,
    secret_scan,
    shards,
    simhash,
    url_filter,
    whitening,
)
from tillgrid.llm.common import saved


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op2_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classified(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(found["fp"]).alias("fingerprint"), "component_id")


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.entropy_differences(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.with_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    measures = saved(rules.measured(docs))
    judged = rules.judged(measures, rules.fit_rules(measures))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "kept", "posterior")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.document_shards(_table(spark, sf_dir, "documents"))


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = passages.without_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.with_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of_kinds(*kinds: str) -> Column:
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in secret_scan.BASE],
        F.sha2(listed(of_kinds(*secret_scan.BASE)), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_vectors": op1_near_vectors,
        "op2_classifier": op2_classifier,
        "op3_mixing": op3_mixing,
        "op4_simhash": op4_simhash,
        "op5_lm_scores": op5_lm_scores,
        "op6_url_filter": op6_url_filter,
        "op7_pieces": op7_pieces,
        "op8_quality_rules": op8_quality_rules,
        "op9_sharding": op9_sharding,
        "op10_passages": op10_passages,
        "op11_phrases": op11_phrases,
        "op12_whitening": op12_whitening,
        "op13_secrets": op13_secrets,
    }


#: Every pair of a label by cosine, and everything reachable over links.
NEAR_VECTORS_SQL = """
with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings),
usable as (
  select * from v where label is not null and e is not null and len(e) > 0
    and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from usable a
    join usable b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.93),
reach(node, other) as (
  select vec_id, vec_id from v
  union
  select r.node, l.b from reach r join links l on l.a = r.other),
counted as (select a, count(*) as n from links group by a),
lowest as (select node, min(other) as component_id from reach group by node)
select v.vec_id, coalesce(c.n, 0) as n_links, l.component_id, v.vec_id = l.component_id as kept
from v join lowest l on l.node = v.vec_id left join counted c on c.a = v.vec_id"""

#: Every window of 13 words, the first document of each, and the words that none covers.
PASSAGES_SQL = """
with d as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
    lambda x: x <> '') as w
  from documents),
windows as (
  select doc_id, i, array_to_string(w[i : i + 12], ' ') as win
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d)),
firsts as (select win, min(doc_id) as first from windows group by win),
covered as (
  select distinct x.doc_id, unnest(range(x.i, x.i + 13)) as p
  from windows x join firsts f on f.win = x.win where f.first < x.doc_id),
words as (select doc_id, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from d),
kept as (
  select k.doc_id, count(*) as n, string_agg(k.word, ' ' order by k.p) as text
  from words k anti join covered c on c.doc_id = k.doc_id and c.p = k.p group by k.doc_id)
select d.doc_id, len(d.w) as n_words, len(d.w) - coalesce(k.n, 0) as n_removed,
  sha256(coalesce(k.text, '')) as kept_sha256
from d left join kept k on k.doc_id = d.doc_id"""


#: Every phrase of up to five words counted, every cut scored, phrases inside longer ones dropped.
PHRASES_SQL = """
with d as (
  select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as p from d),
w as (select lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
totals as (select lang, cast(sum(len(w)) as bigint) as n from w group by lang),
grams as (
  select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from w cross join (values (1), (2), (3), (4), (5)) s(k))),
f as (select lang, phrase, k, count(*) as n from grams group by lang, phrase, k having count(*) >= 100),
cuts as (
  select c.lang, c.phrase, c.k, c.a, c.j, l.n as l, r.n as r, t.n,
    cast(cast(1000 as hugeint) * c.a * t.n // (cast(l.n as hugeint) * r.n) as bigint) as score
  from (select lang, phrase, k, n as a, string_split(phrase, ' ') as ws, unnest(range(1, k)) as j from f where k > 1) c
    join totals t on t.lang = c.lang
    join f l on l.lang = c.lang and l.phrase = array_to_string(c.ws[1 : c.j], ' ')
    join f r on r.lang = c.lang and r.phrase = array_to_string(c.ws[c.j + 1 : c.k], ' ')),
weakest as (
  select *, row_number() over (partition by lang, phrase order by score, j) as place from cuts),
kept as (
  select p.* from weakest p where place = 1 and not exists (
    select 1 from f q where q.lang = p.lang and q.k > p.k and 100 * q.n >= 100 * p.a
      and contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' '))),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, cast(phrase as blob)) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000"""


def all_oracles() -> dict[str, str]:
    """SQL of those queries that it can express."""
    return {"op1_near_vectors": NEAR_VECTORS_SQL, "op10_passages": PASSAGES_SQL, "op11_phrases": PHRASES_SQL}
