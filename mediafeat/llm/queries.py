"""Contract queries of this subpackage: each applies its operator, with production
parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediafeat.llm import (
    conversation_trie,
    fingerprint,
    hard_negatives,
    hyperminhash,
    jaccard_join,
    language_id,
    lm_score,
    mixing,
    piece_sampling,
    quality_rules,
    sharding,
    suffix_dedup,
    toxicity,
)
from mediafeat.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 100-byte strings that start earlier."""
    return suffix_dedup.report(table(spark, sf_dir, "documents"), 100)


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents, learned from those outside fold 1 of 5."""
    return lm_score.score_documents(table(spark, sf_dir, "documents"), 5, 1)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the source targets over 16 output shards."""
    return mixing.mix_report(table(spark, sf_dir, "documents"), shards=16)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every whole text: size, token ids and their
    checksum, scores, and whether decoding gives the text back."""
    return piece_sampling.encode(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those outside fold 2 of 4."""
    return language_id.identify(table(spark, sf_dir, "documents"), 4, 2)


def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 24 shards of nearly equal bytes."""
    out = sharding.shard_documents(table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    out, _ = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edit."""
    return fingerprint.edited_report(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels outside fold 2 of 4."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), 4, 2)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents that link at a 4-word shingle Jaccard of 0.85."""
    return jaccard_join.link_classes(table(spark, sf_dir, "documents"), 4, 85, 100)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector against all vectors."""
    return hard_negatives.mine(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")), every=100)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt on their neighbours' first turns."""
    return conversation_trie.trie(conversation_trie.rebuilt(table(spark, sf_dir, "conversations")))


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents that link at a 4-word shingle Jaccard of 0.8."""
    return hyperminhash.classes(table(spark, sf_dir, "documents"), 4, 80, 100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_suffix_dedup, op2_lm_score, op3_mix_sources, op4_sentencepiece, op5_language_id, op6_shard,
    op7_quality_rules, op8_fingerprint, op9_toxicity, op10_jaccard_join, op11_hard_negatives, op12_conversation_trie,
    op13_minhash_dedup)}


def _classes_sql(percent: int, more: str = "") -> str:
    """Every pair that shares a shingle, then reachability: for the small tables."""
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS x FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(x) = 0 THEN [] WHEN len(x) < 4 THEN [array_to_string(x, ' ')]
    ELSE list_transform(range(1, len(x) - 2), lambda i: array_to_string(x[i:i + 3], ' ')) END) AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= {percent} * (any_value(a.n) + any_value(b.n) - count(*))),
r AS (SELECT u, v FROM p UNION SELECT r.u, p.v FROM r JOIN p ON r.v = p.u),
c AS (SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles,
       least(s.doc_id, coalesce((SELECT min(v) FROM r WHERE r.u = s.doc_id), s.doc_id)) AS component_id FROM s)
SELECT *{more} FROM c"""


_HARD_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN ("label" + 1) % 10 ELSE "label" END AS l,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND "label" IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r, a.vec_id AS a, b.vec_id AS b, a.l = b.l AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.e, b.e), lambda z: coalesce(z[1] * z[2], 0))), 0) AS BIGINT) AS s
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r),
p AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY s DESC, b) AS k FROM s WHERE same QUALIFY k <= 5),
n AS (
  SELECT p.a, p.b AS p, p.s AS ps, s.b AS n, s.s AS ns, row_number() OVER (PARTITION BY p.r, p.k ORDER BY s.s DESC, s.b) AS k
  FROM p JOIN s ON s.r = p.r AND NOT s.same AND 30 * p.s <= 100 * s.s AND 100 * s.s <= 90 * p.s)
SELECT a AS anchor_id, p AS positive_id, CAST(k AS INTEGER) AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score
FROM n WHERE k <= 10"""

#: the checksum bit by bit; then every prefix against every node, for the small tables
_TRIE = """
WITH h AS (
  SELECT conv_id AS c, conv_id - conv_id % 20 AS b,
         xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, i: xor(s >> 1, CAST(3988292384 AS BIGINT) * (s & 1)))),
             CAST(4294967295 AS BIGINT)) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
         struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS x
  FROM conversations),
r AS (
  SELECT h.c, 0 AS own, pos, x FROM h JOIN t ON t.c = h.b AND t.pos <= h.h
  UNION ALL SELECT h.c, 1, pos, x FROM h JOIN t ON t.c = h.c AND t.pos > h.h),
s AS (SELECT h.c, coalesce(list(x ORDER BY own, pos) FILTER (x IS NOT NULL), []) AS s FROM h LEFT JOIN r ON r.c = h.c GROUP BY h.c),
n AS (
  SELECT s[1:d] AS p, d, min(c) AS c, count(*) AS n, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(s) = d), '') AS ends
  FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM s) GROUP BY ALL),
w AS (SELECT *, CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(p[d].text, '[^\\x20\\x09-\\x0D]+')) END AS words,
             (SELECT count(*) FROM n k WHERE k.d = n.d + 1 AND k.p[1:n.d] = n.p) AS kids FROM n)
SELECT v.c AS conv_id, CAST(v.d AS BIGINT) AS depth, (SELECT k.c FROM n k WHERE v.d > 0 AND k.d = v.d - 1 AND k.p = v.p[1:v.d - 1]) AS parent_conv_id,
       v.n AS n_convs, v.kids AS n_children, CAST(sum(CASE WHEN u.kids = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
       CAST(sum((u.n - 1) * u.words) AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM w v JOIN w u ON u.d >= v.d AND u.p[1:v.d] = v.p
GROUP BY v.c, v.d, v.p, v.n, v.kids, v.ends"""

ORACLE: dict[str, str] = {
    "op10_jaccard_join": _classes_sql(85),
    "op11_hard_negatives": _HARD_NEGATIVES,
    "op12_conversation_trie": _TRIE,
    "op13_minhash_dedup": _classes_sql(80, ", doc_id = component_id AS kept"),
}
