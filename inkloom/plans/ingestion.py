"""Queries over events as papers, queues and states, and over conversations as layout items."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from inkloom.functions import text as t
from inkloom.functions import vectors as v
from inkloom.operators import dedup, layout, lifecycle
from inkloom.plans.registry import query


def _state(read):
    e = read("events").where("event_type in ('signup', 'purchase')")
    return dedup.current_state(e.select(F.col("user_id").alias("arxiv_id"), F.when(F.col("event_type") == "purchase", "processed").otherwise("queued").alias("event"), "ts"))


_STATE = "state AS (SELECT user_id AS arxiv_id, CASE WHEN count_if(event_type = 'purchase') > 0 THEN 'processed' ELSE 'queued' END AS status, max(ts) AS ts FROM events WHERE event_type IN ('signup', 'purchase') GROUP BY user_id)"


@query(f"WITH {_STATE} SELECT event_id, user_id FROM events WHERE event_type = 'view' AND NOT EXISTS (SELECT 1 FROM state WHERE arxiv_id = user_id AND status = 'processed' AND arxiv_id % 2 = 0)")
def dedup_anti_join(read, spark):
    state = _state(read).where("status = 'processed' and arxiv_id % 2 = 0").select(F.col("arxiv_id").alias("user_id"))
    return dedup.only_new(read("events").where("event_type = 'view'"), state, "user_id").select("event_id", "user_id")


@query(f"WITH {_STATE} SELECT status, count(*) AS papers FROM state GROUP BY status")
def state_counts(read, spark):
    return _state(read).groupBy("status").agg(F.count("*").alias("papers"))


@query(f"WITH {_STATE}, n AS (SELECT max(ts) AS now FROM events) SELECT arxiv_id, status FROM state, n WHERE status = 'processed' OR ts > now - INTERVAL 48 HOUR")
def blocking_state(read, spark):
    now = read("events").agg(F.max("ts").alias("now"))
    return dedup.blocking(_state(read).crossJoin(F.broadcast(now)), F.col("now")).select("arxiv_id", "status")


@query("SELECT event_type, CAST(count_if(user_id % 3 <> 0) AS BIGINT) AS new, CAST(count_if(user_id % 3 = 0) AS BIGINT) AS skipped FROM events GROUP BY event_type")
def topic_summary(read, spark):
    e = read("events")
    return dedup.topic_summary(e, e.where("user_id % 3 = 0"), "user_id", "event_type")


@query("SELECT event_type, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) <= 50")
def topic_latest_n(read, spark):
    latest = Window.partitionBy("event_type").orderBy(F.desc("ts"), "event_id")
    return read("events").withColumn("k", F.row_number().over(latest)).where("k <= 50").select("event_type", "event_id", "ts")


def _messages(read):
    queue = F.when(F.col("event_type") == "signup", "scrape").when(F.col("event_type") == "purchase", "process").when(F.col("event_type") == "view", "embed").otherwise("default")
    return read("events").select(queue.alias("queue"), F.col("event_id").alias("pos"), F.col("ts").alias("enqueued_at"))


_EXPIRED = """m AS (SELECT event_id AS pos, ts, CASE event_type WHEN 'signup' THEN 'scrape' WHEN 'purchase' THEN 'process' WHEN 'view' THEN 'embed' ELSE 'default' END AS q, (SELECT max(ts) FROM events) AS now FROM events),
x AS (SELECT pos, q AS old, CASE WHEN q <> 'default' AND epoch_us(now) - epoch_us(ts) > CASE q WHEN 'scrape' THEN 3600 WHEN 'process' THEN 7200 ELSE 14400 END * 1000000::BIGINT THEN 'dlx.' || q ELSE q END AS queue FROM m)"""


def _expired(read):
    now = read("events").agg(F.max("ts").alias("now"))
    return lifecycle.expire(_messages(read).crossJoin(F.broadcast(now)), F.col("now")).drop("now")


@query(f"WITH {_EXPIRED} SELECT pos, queue FROM x")
def ttl_expiry(read, spark):
    return _expired(read).select("pos", "queue")


@query(f"WITH {_EXPIRED}, d AS (SELECT *, starts_with(queue, 'dlx.') AND row_number() OVER (PARTITION BY queue ORDER BY pos) <= 50 AS r FROM x) SELECT pos, CASE WHEN r THEN old ELSE queue END AS queue, r AS requeued FROM d")
def dead_letter_drain(read, spark):
    return lifecycle.drain(_expired(read)).select("pos", "queue", "requeued")


@query(f"WITH {_EXPIRED} SELECT queue AS dlq, least(count(*), 50) AS requeued, greatest(count(*) - 50, 0) AS \"left\" FROM x WHERE starts_with(queue, 'dlx.') GROUP BY queue")
def dead_letter_summary(read, spark):
    return lifecycle.drain_summary(_expired(read))


@query(f"WITH {_EXPIRED} SELECT queue, count(*) AS depth FROM x GROUP BY queue")
def queue_depths(read, spark):
    return lifecycle.depths(_expired(read))


@query(f"WITH {_STATE} SELECT (SELECT count(*) FROM events) AS waiting, (SELECT count(*) FROM state) AS known, (SELECT count(*) FROM documents) AS pdf_count, (SELECT round(sum(n_chars) / 1048576.0, 2) FROM documents) AS pdf_mb")
def health_report(read, spark):
    return lifecycle.health(_messages(read), _state(read), read("documents").select(F.col("n_chars").alias("length")))


@query("SELECT count(*) AS deleted, round(coalesce(sum(event_id), 0) / 1048576.0, 2) AS freed_mb FROM events WHERE ts < TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 7 DAY")
def purge_summary(read, spark):
    files = read("events").select(F.col("ts").alias("modificationTime"), F.col("event_id").alias("length"))
    return lifecycle.purge_summary(files, F.lit("2024-01-30 00:00:00").cast("timestamp_ntz"), 7)


@query("""WITH h AS (SELECT user_id AS paper_id, event_id, CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'indexing' WHEN 'purchase' THEN 'done' ELSE 'failed' END AS status FROM events),
s AS (SELECT *, lag(status) OVER (PARTITION BY paper_id ORDER BY event_id) AS previous FROM h)
SELECT paper_id, event_id, previous, status FROM s WHERE (previous IS NULL AND status <> 'pending') OR (previous <> status AND previous || '>' || status NOT IN ('pending>indexing', 'indexing>done', 'indexing>failed', 'failed>pending'))""")
def lifecycle_transitions(read, spark):
    status = F.when(F.col("event_type") == "signup", "pending").when(F.col("event_type") == "view", "indexing").when(F.col("event_type") == "purchase", "done").otherwise("failed")
    return lifecycle.illegal_steps(read("events").select(F.col("user_id").alias("paper_id"), "event_id", status.alias("status")), order="event_id")


@query("SELECT event_id, (60 * (event_id % 4 + 1))::BIGINT AS linear, (60 * pow(2, event_id % 4))::BIGINT AS doubling FROM events")
def retry_delays(read, spark):
    r = F.col("event_id") % 4
    return read("events").select("event_id", v.retry_delay(r, 60, False).alias("linear"), v.retry_delay(r, 60).alias("doubling"))


@query("SELECT event_id, CASE event_type WHEN 'signup' THEN 'scrape' WHEN 'view' THEN 'process' WHEN 'purchase' THEN 'embed' ELSE 'default' END AS queue FROM events")
def task_routes(read, spark):
    task = F.when(F.col("event_type") == "signup", "scrape_topic").when(F.col("event_type") == "view", "parse_pdf").when(F.col("event_type") == "purchase", "store_chunks").otherwise("other")
    return read("events").select("event_id", lifecycle.route(task).alias("queue"))


@query("""WITH g AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM conversations)
SELECT conv_id, CAST(g AS INT) AS group_order, coalesce(max(CASE WHEN role = 'user' THEN text END), 'Untitled') AS title, CAST(count_if(role <> 'user') AS BIGINT) AS paragraphs FROM g GROUP BY conv_id, g""")
def running_group_by_title(read, spark):
    """Turns of users as titles, the others as paragraphs, through the operator for layout items."""
    content = F.when(F.col("role") == "user", F.to_json(F.struct(F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("content"))).alias("title_content")))).otherwise(F.col("text"))
    items = read("conversations").select("conv_id", F.col("turn").alias("pos"), F.when(F.col("role") == "user", "title").otherwise("paragraph").alias("type"), content.alias("content"))
    return layout.group_by_title(items, "conv_id").select("conv_id", "group_order", "title", F.size("paragraphs").cast("long").alias("paragraphs"))


@query("SELECT doc_id, doc_id || '.12345' AS stripped, doc_id || '.12345v2' AS entry, doc_id || '.12345' AS canonical FROM documents")
def paper_ids(read, spark):
    url = F.concat(F.lit("http://arxiv.org/abs/"), "doc_id", F.lit(".12345v2"))
    return read("documents").select("doc_id", t.strip_version(t.entry_id(url)).alias("stripped"), t.entry_id(url).alias("entry"), t.canonical_id(url).alias("canonical"))


@query("SELECT doc_id FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 5 <> 0")
def parseable_papers(read, spark):
    papers = read("documents").withColumn("local_pdf_path", F.when(F.col("doc_id") % 3 != 0, F.lit("x.pdf")).otherwise("")).withColumn("skip_reason", F.when(F.col("doc_id") % 5 == 0, F.lit("too large")))
    return lifecycle.parseable(papers).select("doc_id")


@query("SELECT doc_id, CASE WHEN n_chars * 4096 / 1048576 > 50 THEN printf('PDF too large (%.1f MB)', n_chars * 4096 / 1048576) END AS skip_reason FROM documents")
def pdf_size_limit(read, spark):
    return read("documents").select("doc_id", lifecycle.skip_reason(F.col("n_chars") * 4096).alias("skip_reason"))
