"""Which papers and chunks are new."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkloom.functions.text import content_hash

#: Fixed value: how long a queued paper blocks another try.
QUEUED_HOURS = 48


def current_state(events: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """(key, status, ts): the state that queued, processed and reset events leave; processed outlives later queueing, reset clears both."""
    by = Window.partitionBy(key)
    last_reset = F.max(F.when(F.col("event") == "reset", F.col("ts"))).over(by)
    live = events.withColumn("_reset", last_reset).where("(_reset is null or ts > _reset) and event in ('queued', 'processed')")
    return live.groupBy(key).agg(F.when(F.count_if(F.col("event") == "processed") > 0, "processed").otherwise("queued").alias("status"), F.max("ts").alias("ts"))


def blocking(state: DataFrame, now, hours: int = QUEUED_HOURS) -> DataFrame:
    """States that keep a paper from being queued: processed, or queued for less than `hours`."""
    return state.where((F.col("status") == "processed") | (F.col("ts") > now - F.make_interval(hours=F.lit(hours))))


def only_new(candidates: DataFrame, state: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """Candidates without a state; the plan decides which side to broadcast."""
    return candidates.join(state.select(key), key, "left_anti")


def topic_summary(candidates: DataFrame, state: DataFrame, key: str = "arxiv_id", topic: str = "topic") -> DataFrame:
    """(topic, new, skipped)."""
    known = state.select(key).distinct().withColumn("_known", F.lit(True))
    return candidates.join(known, key, "left").groupBy(topic).agg(F.count_if(F.col("_known").isNull()).alias("new"), F.count_if("_known").alias("skipped"))


def skip_embedded(chunks: DataFrame, stored: DataFrame, key: str = "paper_id") -> DataFrame:
    """Chunks whose content isn't stored with an embedding for the same paper."""
    done = stored.where("embedding is not null").select(key, "content_hash").distinct()
    return chunks.withColumn("content_hash", content_hash(F.col("content"))).join(done, [key, "content_hash"], "left_anti")


def first_by_hash(rows: DataFrame, text: str, order: str) -> DataFrame:
    """One row of each content, that with the least `order`, and how many there were."""
    hashed = rows.withColumn("content_hash", content_hash(F.col(text)))
    return hashed.groupBy("content_hash").agg(F.min(order).alias(order), F.count("*").alias("copies"))


def insert_new(batch: DataFrame, stored: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Rows of the batch to append: the first of each key that isn't stored."""
    first = batch.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(c) for c, t in batch.dtypes if c != key and not t.startswith("map")]))).where("_k = 1").drop("_k")
    return first.join(stored.select(key), key, "left_anti")


def upsert(stored: DataFrame, batch: DataFrame, key: str, version: str) -> DataFrame:
    """Stored rows with those of the batch in their place, whatever their versions; of several rows of a key in the batch the greatest version wins."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
    return both.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_new"), F.desc(version)))).where("_k = 1").drop("_k", "_new")
