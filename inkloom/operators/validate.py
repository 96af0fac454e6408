"""Rules of the persistent tables, which Spark doesn't enforce, as queries for what breaks them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.functions.text import content_hash, squeeze
from inkloom.operators.lifecycle import STATES

# Kinds of chunks and venues, and the length of a stored vector.
CHUNK_TYPES = ["abstract", "body", "conclusion", "caption", "equation", "other"]
VENUE_TYPES = ["journal", "conference", "preprint", "book", "thesis", "report"]
VECTOR_DIM = 768


def not_unique(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys, without nulls, that occur more than once, and how often."""
    return rows.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(rows: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows whose parent is missing; a null key has none to miss."""
    return rows.where(F.col(key).isNotNull()).join(parents.select(F.col(parent_key or key).alias(key)), key, "left_anti")


def cascade(rows: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Rows that stay when these parents go."""
    return rows.join(deleted.select(key), key, "left_anti")


def with_generated(chunks: DataFrame) -> DataFrame:
    """Chunks with word_count, null for text without words, and content_hash."""
    flat = squeeze(F.col("content"))
    return chunks.withColumn("word_count", F.when(flat != "", F.size(F.split(flat, " ")))).withColumn("content_hash", content_hash(F.col("content")))


def _broken(rules: dict[str, Column]) -> Column:
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()]), lambda x: x.isNotNull())


def chunk_violations(chunks: DataFrame, dim: int = VECTOR_DIM) -> DataFrame:
    """Chunks with the names of the rules that they break."""
    rules = {
        "chunk_type": ~F.col("chunk_type").isin(CHUNK_TYPES), "section_order": F.col("section_order") < 0, "chunk": F.col("chunk") < 0, "token_count": F.col("token_count") <= 0,
        "word_count": F.col("word_count").isNull() | (F.col("word_count") <= 0), "embedding": F.col("embedding").isNotNull() & (F.size("embedding") != dim),
    }
    return chunks.withColumn("broken", _broken(rules)).where(F.size("broken") > 0)


def paper_violations(papers: DataFrame) -> DataFrame:
    rules = {"processing_status": ~F.col("processing_status").isin(STATES), "venue_type": ~F.col("venue_type").isin(VENUE_TYPES), "title": F.col("title").isNull(), "paper_id": F.col("paper_id").isNull()}
    return papers.withColumn("broken", _broken(rules)).where(F.size("broken") > 0)
