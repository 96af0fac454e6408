"""The queries of this subpackage over whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from inkloom.llm import bpe, cover_tree, decontaminate, licences, minhash, quality, sstable, suffix_dedup, token_counts, url_filter
from inkloom.llm.common import shared_dir, table

URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents"), length=100)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents")).drop("paragraphs")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.encode_to_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), shared_dir(spark), end=1)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.93)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_sections(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, rule="first")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_licence_scan": op3_licence_scan,
    "op4_minhash": op4_minhash,
    "op5_token_shards": op5_token_shards,
    "op6_url_filter": op6_url_filter,
    "op7_quality": op7_quality,
    "op8_cover_tree": op8_cover_tree,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_token_counts": op10_token_counts,
}

ORACLES: dict[str, str] = {
    "op4_minhash": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
sized AS MATERIALIZED (SELECT doc_id, len(s) AS n, s FROM sets),
items AS MATERIALIZED (SELECT doc_id, n, md5_number(x) AS h FROM (SELECT doc_id, n, unnest(s) AS x FROM sized)),
links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.h = b.h AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sized UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, min(r.y) AS component_id, s.doc_id = min(r.y) AS kept
FROM sized s JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, s.n
""",
    "op6_url_filter": r"""
WITH rest AS (
  SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN ''
    ELSE regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    substr(r, length(regexp_extract(r, '^[^/]*')) + 1) AS path FROM rest),
rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
hits AS (
  SELECT page_id, rh || rp AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS k
  FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT p.page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM parts p LEFT JOIN hits h ON p.page_id = h.page_id AND k = 1
""",
    "op8_cover_tree": r"""
WITH RECURSIVE vecs AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vecs a JOIN vecs b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, m.y AS component_id, e.vec_id = m.y AS kept
FROM embeddings e JOIN (SELECT x, min(y) AS y FROM reach GROUP BY x) m ON m.x = e.vec_id LEFT JOIN counts c ON c.x = e.vec_id
""",
}
