"""Where chunks, documents and dumps go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.operators import dedup

CHUNK_DDL = """CREATE TABLE IF NOT EXISTS {name} (
  paper_id BIGINT, section STRING, section_order INT, chunk INT, chunk_type STRING, content STRING, word_count INT, content_hash STRING,
  embedding ARRAY<FLOAT>, embedding_adapter STRING, embedding_normalized BOOLEAN, token_count INT, embedding_model STRING) USING parquet PARTITIONED BY (embedding_model)"""
PAPER_DDL = """CREATE TABLE IF NOT EXISTS {name} (
  id BIGINT, paper_id STRING, doi STRING, arxiv_id STRING, pmid STRING, pmcid STRING, s2_id STRING, title STRING, abstract STRING, year SMALLINT, date_published DATE,
  authors ARRAY<STRUCT<name: STRING, first: STRING, last: STRING, affiliation: STRING, orcid: STRING, email: STRING>>, affiliations ARRAY<STRUCT<name: STRING, department: STRING, country: STRING>>,
  venue STRING, venue_type STRING, publisher STRING, volume STRING, issue STRING, pages STRING, keywords ARRAY<STRING>, fields_of_study ARRAY<STRING>, language STRING, pdf_url STRING,
  open_access BOOLEAN, license STRING, references_count INT, citations_count INT, source STRING, source_metadata MAP<STRING, STRING>, grobid_version STRING,
  processing_status STRING, error_message STRING, created_at TIMESTAMP, updated_at TIMESTAMP) USING parquet"""


def ensure_schema(spark: SparkSession, papers: str = "papers", chunks: str = "document_chunks") -> None:
    """Both tables, made if they aren't there; running it again changes nothing."""
    spark.sql(PAPER_DDL.format(name=papers))
    spark.sql(CHUNK_DDL.format(name=chunks))


def append_new(chunks: DataFrame, path: str, key: str = "chunk_id", partition: str = "embedding_model") -> None:
    """Append the chunks whose key isn't there yet, laid out by model; a repeated batch adds nothing."""
    spark = chunks.sparkSession
    try:
        stored = spark.read.parquet(path).select(key)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stored = chunks.select(key).limit(0)
    dedup.insert_new(chunks, stored, key).sortWithinPartitions(partition).write.mode("append").partitionBy(partition).parquet(path)


def dump_json(chunks: DataFrame, path: str, now, key: str = "arxiv_id") -> None:
    """One JSON line for each paper: its id, the time, the number of its chunks and the chunks; fields without a value are left out."""
    rest = [c for c in chunks.columns if c != key]
    found = chunks.groupBy(key).agg(F.count("*").alias("total_chunks"), F.array_sort(F.collect_list(F.struct(*rest))).alias("chunks"))
    found.select(F.to_json(F.struct(key, F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), "total_chunks", "chunks")).alias("value")).write.mode("overwrite").text(path)


def dump_groups(groups: DataFrame, path: str) -> None:
    groups.write.mode("overwrite").json(path)
