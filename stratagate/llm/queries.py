"""Registered queries of the numbered operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stratagate.llm.archive import archive_pages
from stratagate.llm.decontaminate import contamination
from stratagate.llm.fingerprints import fingerprints
from stratagate.llm.hard_negatives import hard_negatives
from stratagate.llm.langid import languages
from stratagate.llm.packing import pack_documents
from stratagate.llm.pii import personal_data
from stratagate.llm.prefix_trie import prefix_trie
from stratagate.llm.quality import judge
from stratagate.llm.rendering import rendered
from stratagate.llm.repeats import remove_repeats
from stratagate.llm.simhash import near_duplicates
from stratagate.llm.tables import table
from stratagate.llm.token_files import token_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


@query
def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


ORACLES["op4_archive"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
     d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
                  max(page_id) OVER (PARTITION BY payload) AS answer
           FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> answer THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> answer THEN answer END AS refers_to
FROM d
"""


@query
def op4_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).drop("record_bytes")


@query
def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(table(spark, sf_dir, "documents"), path, end_id=0, capacity=2048)


@query
def op6_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered(table(spark, sf_dir, "pages"))


@query
def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_documents(table(spark, sf_dir, "documents"), path, end_id=2)


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


# CRC-32 bit by bit; a node's key is the chain of its turns' hashes
ORACLES["op12_trie"] = """
WITH RECURSIVE said AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
         sha256(concat_ws(':', length(coalesce(role, '')), coalesce(role, ''), coalesce(text, ''))) AS digest
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(digest, 1, 32)) AS place
  FROM said
), convs AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base FROM own
), bits AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS digits, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM convs
  UNION ALL
  SELECT conv_id, digits, i + 1,
         xor((CASE WHEN i % 8 = 0 THEN xor(v, CAST(ascii(substr(digits, i // 8 + 1, 1)) AS BIGINT)) ELSE v END) >> 1,
             3988292384 * ((CASE WHEN i % 8 = 0 THEN xor(v, CAST(ascii(substr(digits, i // 8 + 1, 1)) AS BIGINT)) ELSE v END) & 1))
  FROM bits WHERE i < 8 * length(digits)
), grafted AS (
  SELECT conv_id, base, xor(v, CAST(4294967295 AS BIGINT)) % 6 AS h
  FROM bits JOIN convs USING (conv_id) WHERE i = 8 * length(digits)
), rebuilt AS (
  SELECT g.conv_id, o.place, o.digest, o.text FROM grafted g JOIN own o ON o.conv_id = g.base AND o.place <= g.h
  UNION ALL
  SELECT g.conv_id, 1000 + o.place, o.digest, o.text FROM grafted g JOIN own o ON o.conv_id = g.conv_id AND o.place > g.h
), chained AS (
  SELECT conv_id, length(text) AS tokens,
         string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS key,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM rebuilt
), members AS (
  SELECT conv_id, tokens, key, n FROM chained
  UNION ALL
  SELECT conv_id, 0, '', (SELECT count(*) FROM rebuilt r WHERE r.conv_id = convs.conv_id) FROM convs
), node AS (
  SELECT key, length(key) // 64 AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * max(tokens) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = length(key) // 64), '')) AS ends_sha256
  FROM members GROUP BY key
), linked AS (
  SELECT a.*, p.conv_id AS parent_conv_id,
         (SELECT count(*) FROM node c WHERE c.depth = a.depth + 1 AND starts_with(c.key, a.key)) AS n_children
  FROM node a LEFT JOIN node p ON p.depth = a.depth - 1 AND p.key = substr(a.key, 1, 64 * (a.depth - 1))
)
SELECT v.conv_id, v.depth, v.parent_conv_id, v.n_convs, v.n_children,
       count(*) FILTER (u.n_children = 0) AS n_leaves,
       CAST(sum(u.saved) AS BIGINT) AS saved_tokens, v.ends_sha256
FROM linked v JOIN linked u ON starts_with(u.key, v.key)
GROUP BY v.conv_id, v.depth, v.parent_conv_id, v.n_convs, v.n_children, v.ends_sha256
"""


@query
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


ORACLES["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))
