"""The ingestion as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from inkloom.operators.dedup import QUEUED_HOURS


def new_papers(events: DataFrame, key: str = "arxiv_id", ts: str = "ts", hours: int = QUEUED_HOURS) -> DataFrame:
    """Each paper once within `hours`; state older than the watermark is dropped."""
    return events.withWatermark(ts, f"{hours} hours").dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, ts: str = "ts", kind: str = "event", late: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """(start, kind, n) of fixed windows, final once the watermark has passed."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")


def write_stage(stream: DataFrame, step: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, key: str | None = None, every: int | None = None) -> StreamingQuery:
    """Run a batch function on all that is there, once or every so many seconds, and append its rows; with a key, a batch that comes again adds nothing."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        from inkloom.sources.sinks import append_new

        out = step(batch)
        if key is None:
            out.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        else:
            append_new(out, path, key, partition="batch_day") if "batch_day" in out.columns else append_new(out.withColumn("batch_day", F.lit("all")), path, key, partition="batch_day")

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=f"{every} seconds")).start()


class FailureLog(StreamingQueryListener):
    """Keeps what happened to the queries of a session."""

    def __init__(self) -> None:
        self.events: list[tuple[str, str]] = []

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.events.append(("started", str(event.id)))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.events.append(("progress", str(event.progress.id)))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.events.append(("failed" if event.exception else "ended", str(event.id)))


def drain_to_memory(stream: DataFrame, name: str, checkpoint: str | None = None) -> DataFrame:
    """Everything that is there now, through a memory table; for tests and small looks."""
    writer = stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True)
    query = (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def read_events(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)
