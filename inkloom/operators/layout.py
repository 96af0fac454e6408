"""Layout JSON, pages of typed items, grouped under their titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkloom.functions.text import image_link, strip

#: Items that are no content, and the shortest paragraph.
NO_CONTENT = ["page_header", "page_footnote", "page_number"]
PARAGRAPH_CHARS = 15
UNTITLED = "Untitled"
_ITEM = "struct<type:string,content:string>"
_PIECES = "array<struct<type:string,content:string>>"


def items(docs: DataFrame, key: str = "doc_id", json: str = "layout") -> DataFrame:
    """(key, pos, type, content): items in reading order from pages of items or from a flat list; content is JSON text.  What can't be read gives no rows."""
    paged = F.from_json(json, f"array<array<{_ITEM}>>", {"mode": "PERMISSIVE"})
    flat = F.from_json(json, f"array<{_ITEM}>", {"mode": "PERMISSIVE"})
    return docs.select(key, F.posexplode(F.when(F.regexp_like(F.col(json), F.lit(r"(?s)^\s*\[\s*\[")), F.flatten(paged)).otherwise(flat)).alias("pos", "i")).select(key, "pos", "i.type", "i.content").where("type is not null")


def _pieces(content: Column, field: str) -> Column:
    return F.from_json(F.get_json_object(content, f"$.{field}"), _PIECES)


def _joined(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: F.replace(F.coalesce(p["content"], F.lit("")), F.lit("\xa0"), F.lit(" "))), " ")


def clean_items(rows: DataFrame) -> DataFrame:
    """Without headers, footnotes and page numbers; paragraphs as the text of their text and formula pieces, if long enough."""
    solid = rows.where(~F.col("type").isin(NO_CONTENT))
    kept = F.filter(_pieces(F.col("content"), "paragraph_content"), lambda p: p["type"].isin("text", "equation_inline"))
    text = strip(F.array_join(F.transform(kept, lambda p: F.coalesce(p["content"], F.lit(""))), " "))
    return solid.withColumn("content", F.when(F.col("type") == "paragraph", F.coalesce(text, F.lit(""))).otherwise(F.col("content"))).where((F.col("type") != "paragraph") | (F.length("content") > PARAGRAPH_CHARS))


def group_by_title(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, group_order, title, paragraphs, assets) of cleaned items.

    A title opens a group; what comes before the first is in a group of its own,
    named Untitled.  Charts and pictures become image links.
    """
    line = Window.partitionBy(key).orderBy("pos")
    grouped = rows.where(F.col("type").isin("title", "paragraph", "chart", "image")).withColumn("group_order", F.sum((F.col("type") == "title").cast("int")).over(line).cast("int"))
    caption = lambda kind: F.coalesce(strip(_joined(_pieces(F.col("content"), f"{kind}_caption"))), F.get_json_object("content", f"$.{kind}_caption"), F.lit(""))
    link = image_link(F.when(F.col("type") == "chart", caption("chart")).otherwise(caption("image")), F.coalesce(F.get_json_object("content", "$.image_source.path"), F.lit("")))
    listed = lambda cond, value: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct(F.col("pos").alias("p"), value.alias("v"))))), lambda x: x["v"])
    return grouped.groupBy(key, "group_order").agg(
        F.coalesce(F.max(F.when(F.col("type") == "title", _joined(_pieces(F.col("content"), "title_content")))), F.lit(UNTITLED)).alias("title"),
        listed(F.col("type") == "paragraph", F.col("content")).alias("paragraphs"),
        listed(F.col("type").isin("chart", "image"), link).alias("assets"),
    )
