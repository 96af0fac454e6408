"""Paper metadata from captured Atom feeds, and the searches over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.functions.text import canonical_id, entry_id, squeeze

#: Orders of a search; others count as the first.
SORTS = {"submittedDate": "published", "lastUpdatedDate": "updated", "relevance": "score"}

ENTRY = (
    "id string, title string, summary string, published string, updated string, author array<struct<name:string>>, category array<struct<_term:string>>, "
    "link array<struct<_href:string,_title:string>>, doi string, journal_ref string"
)


def read_atom(spark: SparkSession, path: str) -> DataFrame:
    """Entries of Atom files below `path` as paper metadata."""
    return metadata(spark.read.format("xml").option("rowTag", "entry").option("ignoreNamespace", "true").schema(ENTRY).load(path))


def metadata(entries: DataFrame) -> DataFrame:
    """(raw_id, arxiv_id, title, abstract, authors, categories, primary_category, published, updated, pdf_url, doi, journal_ref)."""
    names = lambda c, f: F.coalesce(F.filter(F.transform(c, lambda x: x[f]), lambda x: x.isNotNull()), F.array().cast("array<string>"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    pdf = F.get(F.filter("link", lambda x: x["_title"] == "pdf"), F.lit(0))["_href"]
    return entries.select(
        entry_id(F.col("id")).alias("raw_id"), canonical_id(F.col("id")).alias("arxiv_id"), squeeze(F.col("title")).alias("title"), squeeze(F.col("summary")).alias("abstract"),
        names("author", "name").alias("authors"), names("category", "_term").alias("categories"), F.lit("").alias("primary_category"), text("published").alias("published"), text("updated").alias("updated"),
        F.coalesce(pdf, F.lit("")).alias("pdf_url"), text("doi").alias("doi"), text("journal_ref").alias("journal_ref"),
    )


def search(papers: DataFrame, topic: str, limit: int, sort: str = "submittedDate") -> DataFrame:
    """The newest papers of a topic; the limit is the feature."""
    by: Column = F.desc(SORTS.get(sort, "published")) if SORTS.get(sort, "published") in papers.columns else F.desc("published")
    return papers.where(F.array_contains("categories", topic)).orderBy(by, "arxiv_id").limit(limit)


def look_up(papers: DataFrame, arxiv_id: str) -> DataFrame:
    """The paper; none is an error when it is read."""
    found = papers.where(F.col("arxiv_id") == arxiv_id)
    present = found.agg(F.count("*").alias("n")).select(F.assert_true(F.col("n") > 0, F.lit(f"no paper {arxiv_id}")).alias("ok"))
    return present.join(found, F.col("ok").isNull()).drop("ok")
