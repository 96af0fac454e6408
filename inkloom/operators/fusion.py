"""Fusion of extracted assets with the figure references of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.functions.text import caption_similarity, ordinals
from inkloom.functions.vectors import flip, iou

# Thresholds and weights of a match.
IOU_THRESHOLD, CAPTION_THRESHOLD = 0.3, 0.1


def match_score(a: Column, r: Column, iou_threshold: float = IOU_THRESHOLD, caption_threshold: float = CAPTION_THRESHOLD, tidy_boxes: bool = False) -> Column:
    """The best of the signals of an asset and a reference; a spatial hit decides at once."""
    page = a["page_number"]
    same = F.coalesce(page == r["coords"]["page"], F.lit(False))
    overlap = F.coalesce(iou(flip(a["bbox"], tidy=tidy_boxes), r["coords"]), F.lit(0.0))
    boxed = same & a["bbox"].isNotNull()
    number = lambda text: F.get(ordinals(F.coalesce(text, F.lit(""))), F.lit(0))
    similar = caption_similarity(F.coalesce(a["caption"], F.lit("")), F.coalesce(r["caption"], F.lit("")))
    signals = F.greatest(
        F.when(boxed & (overlap > 0), 0.25 + 0.35 * overlap).otherwise(F.lit(0.0)),
        F.when(same & a["bbox"].isNull(), F.lit(0.15)).otherwise(F.lit(0.0)),
        F.when(page.isNotNull() & r["coords"].isNull(), F.lit(0.10)).otherwise(F.lit(0.0)),
        F.when(F.coalesce(number(r["label"]) == number(a["caption"]), F.lit(False)), F.when(same, F.lit(0.70)).otherwise(F.lit(0.55))).otherwise(F.lit(0.0)),
        F.when((similar >= caption_threshold) & (similar > 0), 0.35 + 0.55 * similar).otherwise(F.lit(0.0)),
    )
    return F.when(boxed & (overlap >= iou_threshold), F.least(F.lit(1.0), 0.60 + 0.40 * overlap)).otherwise(signals)


def greedy(pairs: DataFrame, key: str = "doc_id", left: str = "ai", right: str = "ri", score: str = "score") -> DataFrame:
    """(key, left, right, score) of a greedy matching: best score first, of equals the least left, then right; scores above 0 only."""
    kind = f"array<struct<ns:double,l:{dict(pairs.dtypes)[left]},r:{dict(pairs.dtypes)[right]}>>"
    listed = pairs.where(F.col(score) > 0).groupBy(key).agg(F.array_sort(F.collect_list(F.struct((-F.col(score)).cast("double").alias("ns"), F.col(left).alias("l"), F.col(right).alias("r")))).alias("c"))
    taken = F.aggregate("c", F.array().cast(kind), lambda acc, t: F.when(F.exists(acc, lambda z: (z["l"] == t["l"]) | (z["r"] == t["r"])), acc).otherwise(F.array_append(acc, t)))
    return listed.select(key, F.explode(taken).alias("m")).select(key, F.col("m.l").alias(left), F.col("m.r").alias(right), (-F.col("m.ns")).alias(score))


def fuse(assets: DataFrame, refs: DataFrame, caption_threshold: float = CAPTION_THRESHOLD, iou_threshold: float = IOU_THRESHOLD, tidy_boxes: bool = False, key: str = "doc_id") -> DataFrame:
    """Every asset with its reference, if it got one, the confidence, and the caption and label that hold."""
    a = assets.select(key, "ai", F.struct("asset_type", "caption", "text", "page_number", "bbox").alias("a"))
    r = refs.select(key, "ri", F.struct("fig_id", "label", "caption", "coords").alias("r"))
    pairs = a.join(r, key).select(key, "ai", "ri", match_score(F.col("a"), F.col("r"), iou_threshold, caption_threshold, tidy_boxes).alias("score"))
    best = greedy(pairs, key)
    out = a.join(best, [key, "ai"], "left").join(r, [key, "ri"], "left")
    return out.select(
        key, "ai", "ri", F.coalesce("score", F.lit(0.0)).alias("match_confidence"), F.col("a.asset_type").alias("asset_type"),
        F.coalesce(F.nullif(F.col("a.caption"), F.lit("")), F.col("r.caption")).alias("caption"), F.col("r.label").alias("label"),
    )


def fuse_ready(tei: DataFrame, layout: DataFrame, **options) -> DataFrame:
    """fuse() for documents where both services succeeded (boolean `ok`)."""
    both = tei.where("ok").select("doc_id").join(layout.where("ok").select("doc_id"), "doc_id").distinct()
    pick = lambda t, c: t.join(both, "doc_id", "left_semi").select("doc_id", F.posexplode(c)).select("doc_id", "pos", "col.*")
    return fuse(pick(layout, "assets").withColumnRenamed("pos", "ai"), pick(tei, "figure_refs").withColumnRenamed("pos", "ri"), **options)


def fused_report(fused: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of assets by kind and by whether they matched."""
    of = lambda kind: F.count_if(F.col("asset_type") == kind)
    return fused.groupBy(key).agg(
        F.count("*").alias("assets"), of("picture").alias("figures"), of("table").alias("tables"), of("formula").alias("formulas"), F.count("ri").alias("matched"), F.count_if(F.col("ri").isNull()).alias("unmatched")
    )
