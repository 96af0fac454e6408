"""Queues, dead letters, states and health of the ingestion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkloom.functions.vectors import megabytes

# Seconds that a message may wait, messages put back at once, and the legal states.
QUEUE_TTL = {"scrape": 3600, "process": 7200, "embed": 14400}
DRAIN_LIMIT = 50
STATES = ["pending", "indexing", "done", "failed"]
LEGAL_STEPS = [("pending", "indexing"), ("indexing", "done"), ("indexing", "failed"), ("failed", "pending")]
MAX_PDF_MB = 50
#: Stage of a task by its name.
ROUTES = {"scrape_topic": "scrape", "scrape_paper_metadata": "scrape", "download_pdf": "scrape", "parse_pdf": "process", "clean_text": "process", "chunk_document": "process", "generate_embeddings": "embed", "store_chunks": "embed"}


def route(task: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ROUTES.items() for x in kv]), task), F.lit("default"))


#: A task as it travels.
TASK_TYPE = "struct<task:string,args:array<string>,options:map<string,string>,retries:int>"


def task_message(task: Column, args: Column, options: Column | None = None, retries: Column | None = None) -> Column:
    """A task with its arguments as JSON; what has no value is left out."""
    fields = [task.alias("task"), args.alias("args"), *([options.alias("options")] if options is not None else []), (F.lit(0) if retries is None else retries).alias("retries")]
    return F.to_json(F.struct(*fields))


def task_of(message: Column) -> Column:
    """TASK_TYPE of a message; null if it can't be read."""
    found = F.from_json(message, TASK_TYPE)
    return F.when(found["task"].isNotNull(), found)


def expire(messages: DataFrame, now: Column, ttl: dict[str, int] = QUEUE_TTL) -> DataFrame:
    """Messages with the queue they are in now: that of dead letters (dlx.<queue>) if they have waited longer than theirs allows."""
    most = F.try_element_at(F.create_map(*[F.lit(x) for kv in ttl.items() for x in kv]), F.col("queue"))
    late = F.coalesce(F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("enqueued_at").cast("timestamp")) > most.cast("long") * 1_000_000, F.lit(False))
    return messages.withColumn("queue", F.when(late, F.concat(F.lit("dlx."), F.col("queue"))).otherwise(F.col("queue")))


def drain(messages: DataFrame, limit: int = DRAIN_LIMIT) -> DataFrame:
    """Messages with the first `limit` of each queue of dead letters put back and marked `requeued`; `pos` tells the messages of a queue apart.

    Only the first of each queue are ranked, within the tasks before they meet;
    the last of them, one row a queue, marks the others.
    """
    dead = messages.where(F.col("queue").startswith("dlx."))
    first = dead.select("queue", "pos", F.row_number().over(Window.partitionBy("queue").orderBy("pos")).alias("_k")).where(F.col("_k") <= limit)
    marked = messages.join(first.groupBy("queue").agg(F.max("pos").alias("_last")), "queue", "left").withColumn("requeued", F.coalesce(F.col("pos") <= F.col("_last"), F.lit(False))).drop("_last")
    return marked.withColumn("queue", F.when(F.col("requeued"), F.substring("queue", F.lit(5), F.length("queue"))).otherwise(F.col("queue"))).select(*messages.columns, "requeued")


def drain_summary(before: DataFrame, limit: int = DRAIN_LIMIT) -> DataFrame:
    """(dlq, requeued, left)."""
    return before.where(F.col("queue").startswith("dlx.")).groupBy(F.col("queue").alias("dlq")).agg(F.least(F.count("*"), F.lit(limit)).cast("long").alias("requeued"), F.greatest(F.count("*") - limit, F.lit(0)).cast("long").alias("left"))


def depths(messages: DataFrame) -> DataFrame:
    return messages.groupBy("queue").agg(F.count("*").alias("depth"))


def health(messages: DataFrame, state: DataFrame, files: DataFrame) -> DataFrame:
    """One row: messages waiting, papers known, PDFs and their megabytes."""
    return messages.agg(F.count("*").alias("waiting")).crossJoin(state.agg(F.count("*").alias("known"))).crossJoin(files.agg(F.count("*").alias("pdf_count"), megabytes(F.coalesce(F.sum("length"), F.lit(0)), 2).alias("pdf_mb")))


def purge_summary(files: DataFrame, now: Column, days: int) -> DataFrame:
    """(deleted, freed_mb) of files last changed more than `days` ago."""
    return files.where(F.col("modificationTime") < now - F.make_interval(days=F.lit(days))).agg(F.count("*").alias("deleted"), megabytes(F.coalesce(F.sum("length"), F.lit(0)), 2).alias("freed_mb"))


def skip_reason(length: Column, most: int = MAX_PDF_MB) -> Column:
    """Why a file of that many bytes is left out; megabytes are exact and of two equally near tenths the even one is shown, as C and Python do (Java rounds up)."""
    tenfold = length.cast("long") * 10
    whole, rest = F.shiftright(tenfold, 20), tenfold.bitwiseAND(1048575)
    tenths = whole + F.when((rest > 524288) | ((rest == 524288) & (whole % 2 == 1)), 1).otherwise(0)
    shown = F.format_string("PDF too large (%d.%d MB)", F.floor(tenths / 10), tenths % 10)
    return F.when(length / 1048576 > most, shown)


def parseable(papers: DataFrame) -> DataFrame:
    """Papers with a local file and no reason to be skipped."""
    return papers.where((F.coalesce("local_pdf_path", F.lit("")) != "") & (F.coalesce("skip_reason", F.lit("")) == ""))


def illegal_steps(history: DataFrame, key: str = "paper_id", order: str = "ts") -> DataFrame:
    """Changes of status that the state machine doesn't have; the first status must be pending."""
    line = Window.partitionBy(key).orderBy(order)
    steps = history.withColumn("previous", F.lag("status").over(line)).where("previous is null or previous <> status")
    legal = F.coalesce(F.concat_ws(">", "previous", "status").isin([f"{a}>{b}" for a, b in LEGAL_STEPS]), F.lit(False))
    return steps.where(~F.when(F.col("previous").isNull(), F.col("status") == "pending").otherwise(legal)).select(key, order, "previous", "status")


def average_tokens(chunks: DataFrame, key: str) -> DataFrame:
    """(key, chunks, avg_tokens), the average cut to a whole number."""
    return chunks.groupBy(key).agg(F.count("*").alias("chunks"), F.floor(F.try_divide(F.sum("token_count"), F.count("*"))).cast("long").alias("avg_tokens"))


def stored_summary(chunks: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """(key, stored, status)."""
    stored = F.count_if(F.size("embedding") > 0)
    return chunks.groupBy(key).agg(stored.alias("stored"), F.when(stored > 0, "ok").otherwise("skipped").alias("status"))


def embedding_queue(chunks: DataFrame, key: str = "paper_id", created: str = "created_at") -> DataFrame:
    """Chunks without an embedding in the order in which they are to get one, as `place` within the paper."""
    return chunks.where("embedding is null").withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(created, "section_order", "chunk")))


def reading_order(chunks: DataFrame, key: str = "paper_id") -> DataFrame:
    return chunks.orderBy(key, "section_order", "chunk")
