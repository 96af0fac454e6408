"""The ingestion from candidates to stored chunks, as one lazy plan for each step that has an action."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.functions import text as t
from inkloom.operators import chunking, dedup, embed, lifecycle, sections
from inkloom.sources import sinks

#: Columns that every chunk has from its paper.
INHERITED = ["authors", "categories", "published", "doi"]


def discover(candidates: DataFrame, events: DataFrame, now: Column, topic: str = "topic") -> tuple[DataFrame, DataFrame]:
    """New candidates, one row of each paper, and the summary of topics; both by canonical id."""
    state = dedup.blocking(dedup.current_state(events), now)
    known = candidates.withColumn("arxiv_id", t.canonical_id(F.col("raw_id")))
    fresh = dedup.only_new(known, state).dropDuplicates(["arxiv_id"])
    return fresh, dedup.topic_summary(known, state, topic=topic)


def clean_sections(found: DataFrame, least: int = t.MIN_CHARS, normalise: bool = True) -> DataFrame:
    """Sections with cleaned text of some length."""
    return found.withColumn("text", t.clean(F.col("text"), normalise)).where(F.length("text") >= least)


def chunk_papers(papers: DataFrame, spans: DataFrame, size: int = chunking.CHUNK_CHARS, overlap: int = chunking.OVERLAP_CHARS) -> DataFrame:
    """Chunks of the papers that can be parsed, with what they inherit.

    papers: arxiv_id, title, abstract, local_pdf_path, skip_reason and INHERITED;
    spans: arxiv_id, span_idx, page, text, size.
    """
    usable = lifecycle.parseable(papers)
    parsed = sections.segment(spans.join(usable.select("arxiv_id"), "arxiv_id", "left_semi"), "arxiv_id")
    whole = clean_sections(sections.with_abstract(parsed, usable, "arxiv_id"))
    numbered = whole.withColumn("section_order", F.col("section_order") + 1)
    chunks = chunking.chunk_rows(numbered, "arxiv_id", size, overlap)
    return chunks.join(usable.select("arxiv_id", F.coalesce("title", F.lit("")).alias("title"), *INHERITED), "arxiv_id")


def embed_and_store(chunks: DataFrame, factory: Callable[[], embed.Embedder], path: str) -> DataFrame:
    """Store what isn't stored, each distinct text embedded once; gives (arxiv_id, stored, status)."""
    distinct = chunks.select("text").distinct()
    vectors = embed.with_embeddings(distinct, factory, "text")
    sinks.append_new(embed.embedded_only(chunks.join(vectors, "text")), path)
    stored = chunks.sparkSession.read.parquet(path).select("chunk_id", "embedding")
    return lifecycle.stored_summary(chunks.join(stored, "chunk_id", "left"))


def finished(summary: DataFrame, now: Column) -> DataFrame:
    """Events that mark the papers processed."""
    return summary.where("status = 'ok'").select("arxiv_id", F.lit("processed").alias("event"), now.alias("ts"))


def forced(arxiv_id: Column, now: Column) -> Column:
    """Events that take a paper through again: its state is reset, then it is queued."""
    later = now + F.make_dt_interval(secs=F.lit(1))
    return F.array(F.struct(arxiv_id.alias("arxiv_id"), F.lit("reset").alias("event"), now.alias("ts")), F.struct(arxiv_id.alias("arxiv_id"), F.lit("queued").alias("event"), later.alias("ts")))
