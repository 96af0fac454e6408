"""Queue papers by hand: python -m inkloom.cli STATE_DIR --feed DIR --topic cs.CL --max 50, or --id 2401.12345."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from inkloom.plans import papers
from inkloom.sources import arxiv
from inkloom.sources.settings import Settings

EVENTS = "arxiv_id string, event string, ts timestamp"


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Append events to the state folder; gives the number of papers queued."""
    settings = Settings.from_env()
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("state")
    parser.add_argument("--feed", help="folder of Atom files")
    parser.add_argument("--topic", action="append", help="topics; those of the settings if none is given")
    parser.add_argument("--max", type=int, default=settings.max_results)
    parser.add_argument("--id", help="one paper, whatever its state")
    args = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("inkloom").getOrCreate()
    now = F.current_timestamp()
    if args.id:
        events = spark.range(1).select(F.explode(papers.forced(F.lit(args.id), now)).alias("e")).select("e.*")
        events.write.mode("append").parquet(args.state)
        return 1
    try:
        known = spark.read.schema(EVENTS).parquet(args.state)
        known.limit(0).count()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        known = spark.createDataFrame([], EVENTS)
    feed, found = arxiv.read_atom(spark, args.feed), None
    for topic in args.topic or settings.topics:
        part = arxiv.search(feed, topic, args.max).withColumn("topic", F.lit(topic))
        found = part if found is None else found.unionByName(part)
    fresh, _ = papers.discover(found, known, now)
    queued = fresh.select("arxiv_id", F.lit("queued").alias("event"), now.alias("ts")).persist()
    n = queued.count()
    queued.write.mode("append").parquet(args.state)
    queued.unpersist()
    return n


if __name__ == "__main__":
    print(f"queued {main()} papers")
