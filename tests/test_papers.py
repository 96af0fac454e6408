from pyspark.sql import functions as F
from test_io import FEED

from inkloom import cli
from inkloom.operators import dedup, embed
from inkloom.plans import papers


def test_from_candidates_to_stored_chunks(spark, tmp_path):
    now = F.lit("2024-01-03 00:00:00").cast("timestamp")
    candidates = spark.createDataFrame([("2401.1v2", "cs"), ("2401.1v3", "cs"), ("2401.2v1", "cs"), ("2401.3", "ml")], "raw_id string, topic string")
    events = spark.createDataFrame([("2401.2", "processed", "2023-01-01"), ("2401.3", "queued", "2023-01-01")], "arxiv_id string, event string, ts string").withColumn("ts", F.to_timestamp("ts"))
    fresh, summary = papers.discover(candidates, events, now)
    assert sorted(r["arxiv_id"] for r in fresh.collect()) == ["2401.1", "2401.3"]
    assert {tuple(r) for r in summary.collect()} == {("cs", 2, 1), ("ml", 1, 0)}
    body = "This sentence is long enough to be kept, and it goes on for a while. " * 3
    meta = spark.createDataFrame(
        [("2401.1", "A title", "An abstract. " * 12, "a.pdf", None, ["X"], ["cs"], "2024", ""), ("2401.3", "B", "short", "b.pdf", "PDF too large (60.0 MB)", [], [], "", "")],
        "arxiv_id string, title string, abstract string, local_pdf_path string, skip_reason string, authors array<string>, categories array<string>, published string, doi string",
    )
    spans = spark.createDataFrame([(p, i, i, s, z) for p in ("2401.1", "2401.3") for i, (s, z) in enumerate([("intro [1, 2] " + body, 10.0), ("Method", 14.0), (body, 10.0), ("tiny", 10.0)])], "arxiv_id string, span_idx int, page int, text string, size double")
    chunks = papers.chunk_papers(meta, spans)
    rows = {r["chunk_id"]: r for r in chunks.collect()}
    assert sorted(rows) == ["2401.1_0_0", "2401.1_1_0", "2401.1_2_0"]
    assert rows["2401.1_1_0"]["text"].startswith("intro This") and rows["2401.1_2_0"]["section"] == "Method" and rows["2401.1_0_0"]["authors"] == ["X"]
    for _ in range(2):
        done = papers.embed_and_store(chunks, embed.HashingEmbedder, str(tmp_path / "store"))
        assert [tuple(r) for r in done.collect()] == [("2401.1", 3, "ok")]
    assert spark.read.parquet(str(tmp_path / "store")).count() == 3
    after = dedup.current_state(events.unionByName(papers.finished(done, now)))
    assert {r["arxiv_id"]: r["status"] for r in after.collect()}["2401.1"] == "processed"


def test_queueing_by_hand(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "f.xml").write_text(FEED)
    state, feed = str(tmp_path / "state"), str(tmp_path / "feed")
    assert [cli.main([state, "--feed", feed, "--topic", "cs.CL"], spark) for _ in range(2)] == [2, 0]
    assert cli.main([state, "--id", "2401.1"], spark) == 1
    assert spark.read.parquet(state).where("arxiv_id = '2401.1'").count() == 3
