"""The registered queries of the training-data operators, and their SQL.

Each query applies its operator, with production parameters, to the whole of
its table.
"""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.llm import (bpe, divergence, embed_dedup, exact_dedup, hard_negatives, langid, mixing, quality, quality_rules, sharding, simhash,
                            token_store, toxicity)
from moodstream.llm.common import read
from moodstream.session import checkpoint_dir

# The mixing tree of the test tables: a source's domain is its number modulo 4, which the
# last two of any number of digits decide; a source without a number has none.
DOMAIN_SQL = "concat('d', try_cast(regexp_extract(source, '([0-9]{1,2})$', 1) as int) % 4)"
MIX_WEIGHTS = {
    "domain": {"d0": 0.4, "d1": 0.3, "d2": 0.2, "d3": 0.1},
    "lang": {"en": 0.4, "fr": 0.25, "de": 0.2, "es": 0.15},
}
MIX_SHARE, MIX_SEED, MIX_EPOCHS = 0.6, 11, 2


def bpe_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid4().hex}"
    token_store.write_store(read(spark, sf_dir, "documents", "doc_id", "text"), folder, bpe_vocabulary())
    return token_store.read_digests(spark, folder)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return langid.predict(docs, langid.train(docs))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read(spark, sf_dir, "documents", "doc_id", "text"), bpe_vocabulary())


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return quality.score(docs, quality.train(docs, read(spark, sf_dir, "labels", "doc_id", "quality")))


def op7_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_ring(read(spark, sf_dir, "documents", "doc_id", "text"), shards=8)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return mixing.select(docs, MIX_WEIGHTS, MIX_SHARE, F.expr(DOMAIN_SQL), seed=MIX_SEED, epochs=MIX_EPOCHS)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels", "doc_id", "toxic")))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents", "doc_id", "text"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents", "text", "lang", "source"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "quality"))
    return judged.drop("n_lines").withColumn("failed_rules", F.array_join("failed_rules", ","))


QUERIES = {
    f.__name__: f
    for f in (op1_simhash, op2_token_store, op3_language, op4_embedding_dedup, op5_bpe, op6_quality, op7_ring_sharding, op8_mixing,
              op9_toxicity, op10_exact_dedup, op11_hard_negatives, op12_divergence, op13_quality_rules)
}

_WORDS = "[^\\x20\\x09-\\x0D]+"

_CASE = {
    level: "CASE " + " ".join(f"WHEN {level} = '{k}' THEN {w}::DOUBLE" for k, w in table.items()) + " ELSE 1.0::DOUBLE END"
    for level, table in {**{"source": {"(none)": 1.0}}, **MIX_WEIGHTS}.items()
}


def _share_sql(name: str, path: str, parents: str, level: str, above: str) -> str:
    """One level of the tree in SQL: sort children by capacity per weight, the
    first that its level does not fill sets the level."""
    part = f"PARTITION BY {parents} " if parents else ""
    return f"""
{name}_w AS (SELECT {path}, sum(leaf_tokens) * {MIX_EPOCHS}::DOUBLE AS cap, {_CASE[level]} AS weight FROM leaves GROUP BY {path}),
{name}_l AS (SELECT n.*, {above} AS above FROM {name}_w n {f"JOIN {parents.split(',')[-1].strip()}_b USING ({parents})" if parents else ""}),
{name}_r AS (SELECT *, greatest(above - coalesce(sum(cap) OVER ({part}ORDER BY cap / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)
  / sum(weight) OVER ({part}ORDER BY cap / weight, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level0 FROM {name}_l),
{name}_m AS (SELECT *, max(CASE WHEN level0 < cap / weight THEN level0 END) OVER ({f"PARTITION BY {parents}" if parents else ""}) AS level1 FROM {name}_r),
{level}_b AS (SELECT {path}, least(cap, coalesce(level1 * weight, cap)) AS budget FROM {name}_m)"""


_RULES = quality_rules.RULES
_STAT = {name: stat.replace(" div ", " // ") for name, (stat, _) in _RULES.items()}
_LADDERS = ", ".join(f"('{name}', {step}, {cutoff})" for name, (_, ladder) in _RULES.items() for step, cutoff in enumerate(ladder))
_VALUE = "CASE rule " + " ".join(f"WHEN '{name}' THEN {stat}" for name, stat in _STAT.items()) + " END"
# Of a stratum's good documents, each of the rules may reject this share; and the error that each test may have, times the strata.
_RATE, _ERROR = 0.05 / len(_RULES), 0.05 / len(_RULES)
_FAILED = "concat_ws(',', " + ", ".join(f"CASE WHEN {stat} > cutoffs['{name}'] THEN '{name}' END" for name, stat in _STAT.items()) + ")"


ORACLE_SQL = {
    "op4_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98
), r AS (SELECT a AS n, b AS m FROM l UNION SELECT r.n, l.b FROM r JOIN l ON r.m = l.a)
SELECT e.vec_id, coalesce(d.c, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c.m, e.vec_id)) AS component_id,
  least(e.vec_id, coalesce(c.m, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS c FROM l GROUP BY a) d ON d.a = e.vec_id
LEFT JOIN (SELECT n, min(m) AS m FROM r GROUP BY n) c ON c.n = e.vec_id""",
    "op8_mixing": f"""
WITH docs AS (
  SELECT doc_id, 'd' || (regexp_extract(source, '([0-9]+)$', 1)::INT % 4) AS domain, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    len(regexp_extract_all(text, '{_WORDS}'))::BIGINT AS n_tokens FROM documents
), narrow AS (SELECT doc_id, coalesce(domain, '(none)') AS domain, lang, source, n_tokens FROM docs WHERE n_tokens > 0),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::DOUBLE AS leaf_tokens FROM narrow GROUP BY ALL),
{_share_sql("one", "domain", "", "domain", f"(SELECT sum(leaf_tokens) FROM leaves) * {MIX_SHARE}::DOUBLE").strip()},
{_share_sql("two", "domain, lang", "domain", "lang", "budget").strip()},
{_share_sql("three", "domain, lang, source", "domain, lang", "source", "budget").strip()},
plan AS (SELECT domain, lang, source, leaf_tokens, floor(budget + 1e-6)::BIGINT AS leaf_budget FROM leaves JOIN source_b USING (domain, lang, source)),
stream AS (
  SELECT n.*, leaf_budget, e.epoch::BIGINT AS epoch, md5('{MIX_SEED}/' || e.epoch || '/' || doc_id) AS o
  FROM narrow n JOIN plan USING (domain, lang, source), (SELECT unnest(range({MIX_EPOCHS})) AS epoch) e WHERE leaf_budget > 0
), placed AS (
  SELECT *, (sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY epoch, o, n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens)::BIGINT AS first_token FROM stream
)
SELECT doc_id, domain, lang, source, epoch, n_tokens, first_token, leaf_budget FROM placed WHERE first_token < leaf_budget""",
    "op10_exact_dedup": r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[ 	-
]+', '', 'g') AS t FROM documents),
g AS (SELECT doc_id, t, count(*) OVER (PARTITION BY t) AS group_size,
  first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0 AND NOT (a.label = b.label AND a.vec_id = b.vec_id)
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INT AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5""",
    "op12_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), o AS (SELECT k, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS everywhere FROM o GROUP BY lang, term HAVING count(DISTINCT k) >= 30),
langs AS (SELECT lang, count(*) AS terms, sum(everywhere) AS lang_total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
f AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * terms) AS p,
    1 + (1000000000::HUGEINT * (everywhere + 5)) // (lang_total + 5 * terms) AS q
  FROM g JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN f y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY a.lang, a.source, b.source
), told AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM f WHERE n > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM told QUALIFY part = 'pair' OR rank <= 50""",
    "op13_quality_rules": rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, word, pos, lead(word) OVER o AS b, lead(word, 2) OVER o AS c FROM (
  SELECT k, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM (SELECT k, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)
) WINDOW o AS (PARTITION BY k ORDER BY pos)),
rep AS (SELECT k, count(DISTINCT spot) AS n FROM (SELECT k, unnest([pos, pos + 1, pos + 2]) AS spot FROM (
  SELECT k, pos, count(*) OVER (PARTITION BY k, word, b, c) AS n FROM w WHERE c IS NOT NULL) WHERE n > 1) GROUP BY k),
lines AS (SELECT k, count(*) AS n, count(DISTINCT line) AS own FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
s AS (
  SELECT d.k, doc_id, coalesce(c.n, 0) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(lines.n, 0) AS n_lines,
    coalesce(lines.n - own, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN (SELECT k, count(*) AS n FROM w GROUP BY k) c USING (k) LEFT JOIN lines USING (k) LEFT JOIN rep USING (k)
), f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {quality_rules.BANDS} AS stratum FROM s),
known AS (SELECT doc_id, max(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
hold AS (
  SELECT f.*, good FROM f JOIN known USING (doc_id) WHERE NOT base_failed
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) = 1
), l(rule, step, cutoff) AS (VALUES {_LADDERS}),
e AS (SELECT stratum, rule, step, cutoff, good, {_VALUE} > cutoff AS failed FROM hold, l),
tests AS (SELECT stratum, rule, step, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (good AND failed) AS lost,
  count(*) FILTER (NOT good AND failed) AS caught FROM e GROUP BY stratum, rule, step, cutoff),
sizes AS (SELECT stratum, max(n) AS n FROM tests GROUP BY stratum),
tails AS (SELECT stratum, i, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RATE}::DOUBLE) + (n - i) * ln(1 - {_RATE}::DOUBLE)))
  OVER (PARTITION BY stratum ORDER BY i) AS tail FROM (SELECT stratum, n, unnest(range(0, ceil(n * {_RATE}::DOUBLE)::BIGINT + 1)) AS i FROM sizes) WHERE i < n OR n = 0),
allowed AS (SELECT stratum, max(CASE WHEN tail <= {_ERROR}::DOUBLE / (SELECT count(*) FROM sizes) THEN i ELSE -1 END) AS most FROM tails GROUP BY stratum),
proven AS (SELECT *, bool_and(lost <= most) OVER (PARTITION BY stratum, rule ORDER BY step) AS ok FROM tests JOIN allowed USING (stratum)),
best AS (SELECT stratum, rule, cutoff FROM proven WHERE ok AND caught > lost
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY caught - lost DESC, step) = 1),
cut AS (SELECT stratum, map(list(rule), list(cutoff)) AS cutoffs FROM best GROUP BY stratum),
j AS (SELECT f.*, CASE WHEN base_failed OR cutoffs IS NULL THEN '' ELSE {_FAILED} END AS failed_rules FROM f LEFT JOIN cut USING (stratum))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept, stratum, failed_rules
FROM j""",
}
