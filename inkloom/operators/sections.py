"""Sections of a document from its text spans, as windows over the spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkloom.functions.text import strip

#: A heading is this much larger than the median and shorter than this.
HEADING_RATIO, HEADING_CHARS, DEFAULT_SIZE, FIRST_TITLE = 1.2, 120, 12.0, "Introduction"


def upper_median(rows: DataFrame, key: str, value: str, out: str = "median") -> DataFrame:
    """(key, median): the upper of the two middle values, as it occurs.

    Equal values are counted before they meet, so a key of very many rows sends its
    distinct values only.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    at = Window.partitionBy(key)
    upto = F.sum("_n").over(at.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.select(key, value, upto.alias("_upto"), "_n", F.sum("_n").over(at).alias("_all"))
    middle = F.expr("_all div 2 + 1")
    return ranked.where((F.col("_upto") >= middle) & (F.col("_upto") - F.col("_n") < middle)).select(key, F.col(value).alias(out))


def segment(spans: DataFrame, key: str = "doc_id", order: str = "span_idx") -> DataFrame:
    """(key, section_order, title, text, page_start, page_end) from spans with text, size and page.

    Blank spans are passed over.  A heading is at least HEADING_RATIO times the
    document's median size, shorter than HEADING_CHARS and doesn't end in a comma.  Of
    headings in a row the odd ones open a section (the even ones within the first
    section, which has no text yet) and the others are text.  A section ends on
    the page of the heading that closes it; the last one needs text.
    """
    solid = spans.where(strip(F.col("text")) != "").withColumn("_t", strip(F.col("text")))
    median = upper_median(solid, key, "size", "_median")
    known = solid.join(median, key, "left").withColumn("_h", (F.col("size") >= HEADING_RATIO * F.coalesce("_median", F.lit(DEFAULT_SIZE))) & (F.length("_t") < HEADING_CHARS) & ~F.col("_t").endswith(","))
    line = Window.partitionBy(key).orderBy(order)
    known = known.withColumn("_run", F.sum(F.coalesce((F.lag("_h").over(line) != F.col("_h")).cast("int"), F.lit(1))).over(line))
    known = known.withColumn("_pos", F.row_number().over(Window.partitionBy(key, "_run").orderBy(order)))
    opens = F.col("_h") & F.when(F.col("_run") == 1, F.col("_pos") % 2 == 0).otherwise(F.col("_pos") % 2 == 1)
    known = known.withColumn("_open", opens).withColumn("section_order", F.sum(F.col("_open").cast("int")).over(line))
    body = F.array_sort(F.collect_list(F.when(~F.col("_open"), F.struct(F.col(order).alias("i"), F.col("_t").alias("t")))))
    found = known.groupBy(key, "section_order").agg(
        F.max(F.when(F.col("_open"), F.col("_t"))).alias("title"), body.alias("_body"), F.max(F.when(F.col("_open"), F.col("page"))).alias("_first"), F.max_by("page", order).alias("_last")
    )
    after = Window.partitionBy(key).orderBy("section_order")
    found = found.withColumn("_next", F.lead("_first").over(after))
    text = F.concat(F.array_join(F.transform("_body", lambda b: b["t"]), " "), F.lit(" "))
    return found.where(F.size("_body") > 0).select(
        key,
        F.col("section_order").cast("int").alias("section_order"),
        F.coalesce("title", F.lit(FIRST_TITLE)).alias("title"),
        text.alias("text"),
        F.coalesce("_first", F.lit(0)).cast("int").alias("page_start"),
        F.coalesce("_next", "_last").cast("int").alias("page_end"),
    )


def with_abstract(sections: DataFrame, papers: DataFrame, key: str = "doc_id") -> DataFrame:
    """Sections with the abstract, where there is one, as section -1 on page 0."""
    first = papers.where(F.coalesce("abstract", F.lit("")) != "").select(key, F.lit(-1).alias("section_order"), F.lit("Abstract").alias("title"), F.col("abstract").alias("text"), F.lit(0).alias("page_start"), F.lit(0).alias("page_end"))
    return first.unionByName(sections)


def full_text(sections: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, full_text): non-empty texts in order, a blank line between."""
    parts = F.array_sort(F.collect_list(F.struct("section_order", "text")))
    return sections.groupBy(key).agg(F.array_join(F.filter(F.transform(parts, lambda s: s["text"]), lambda t: t != ""), "\n\n").alias("full_text"))
