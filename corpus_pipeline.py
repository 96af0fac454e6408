"""A corpus pipeline of five of the training-data operators.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before
it kept, and returns a DataFrame with the columns of `documents`; the last returns the
encoded corpus.  Rows with a null doc_id pass the stages that decide by id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.llm import bpe, decontaminate, minhash, quality, suffix_dedup
from inkloom.llm.common import cut, table

WORDS, PERCENT = 5, 80
REPEAT_BYTES = 100


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    groups = minhash.near_duplicates(docs, words=WORDS, percent=PERCENT)
    return docs.join(groups.where(~F.col("kept")).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without long strings that start earlier in the corpus; n_chars follows."""
    return suffix_dedup.dedup(docs, REPEAT_BYTES, count_col="n_chars")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document, encoded and decoded again."""
    return bpe.digest_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", keep_quality),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("byte_level_bpe", encode),
]

#: The classifier and the tiling have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each cut from the lineage of the one before."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
