import json

import pytest
from pyspark.sql import functions as F

from inkloom.operators import embed
from inkloom.sources import arxiv, files, settings, sinks
from inkloom.streaming import ingest

FEED = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/2401.1v2</id><title>A
 title</title><summary> Sum  mary </summary><published>2024-01-02</published><updated>2024-01-03</updated><author><name>A</name></author><author><name>B</name></author><category term="cs.CL"/><link href="p" title="pdf"/></entry>
<entry><id>http://arxiv.org/abs/hep-th/9901001v1</id><title>Old</title><summary>s</summary><published>1999-01-01</published><updated>1999-01-01</updated><author><name>C</name></author><category term="hep-th"/><category term="cs.CL"/><link href="q"/></entry></feed>"""


def test_atom_feed(spark, tmp_path):
    (tmp_path / "f.xml").write_text(FEED)
    papers = arxiv.read_atom(spark, str(tmp_path))
    found = {r["arxiv_id"]: (r["title"], r["abstract"], r["authors"], r["pdf_url"]) for r in papers.collect()}
    assert found == {"2401.1": ("A title", "Sum mary", ["A", "B"], "p"), "hep-th/9901001": ("Old", "s", ["C"], "")}
    assert [r["arxiv_id"] for r in arxiv.search(papers, "cs.CL", 1).collect()] == ["2401.1"]
    assert arxiv.look_up(papers, "2401.1").count() == 1
    with pytest.raises(Exception, match="no paper"):
        arxiv.look_up(papers, "x").collect()


def test_pdf_spans_and_service(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one|two")
    (tmp_path / "b.txt").write_bytes(b"no")
    pdfs = files.read_pdfs(spark, str(tmp_path))
    spans = files.read_spans(pdfs, lambda content: [(0, s, 10.0, "F", False) for s in content.decode().split("|")]).collect()
    assert [(r["doc_id"], r["span_idx"], r["text"]) for r in spans] == [("a", 0, "one"), ("a", 1, "two")]

    def call(service, content, options):
        return (200, f"<TEI>{options['n']}</TEI>") if content == b"one|two" else (500, "x" * 900)

    found = files.call_service(pdfs, call, options={"n": 2, "m": None}, defaults={"n": 1, "m": 3}).collect()
    assert [(r["doc_id"], r["tei_xml"], r["ok"]) for r in found] == [("a", "<TEI>2</TEI>", True)]
    out = spark.createDataFrame([(200, "x"), (204, None), (500, "y" * 900)], "s int, b string").select(files.service_outcome(F.col("s"), F.col("b")).alias("o")).collect()
    assert [(r["o"]["ok"], len(r["o"]["error"] or "")) for r in out] == [(True, 0), (False, 29), (False, 500)]
    with pytest.raises(ValueError):
        files.call_service(pdfs, call, service="other")


def test_settings():
    s = settings.Settings.from_env({"INKLOOM_TOPICS": " a, b ,", "INKLOOM_MAX_RESULTS": "7"})
    assert s.topics == ("a", "b") and s.max_results == 7 and s.max_pdf_mb == 50


def test_append_twice_adds_nothing(spark, tmp_path):
    chunks = embed.with_embeddings(spark.createDataFrame([("p_0_0", "p", "x"), ("p_0_1", "p", "y")], "chunk_id string, arxiv_id string, text string"), embed.HashingEmbedder)
    for _ in range(2):
        sinks.append_new(chunks, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    sinks.dump_json(chunks.select("chunk_id", "arxiv_id", "text"), str(tmp_path / "json"), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    line = json.loads(spark.read.text(str(tmp_path / "json")).first()[0])
    assert line["total_chunks"] == 2 and line["timestamp"] == "2024-01-01T00:00:00" and [c["chunk_id"] for c in line["chunks"]] == ["p_0_0", "p_0_1"]


def test_tables_are_made_once(spark):
    for _ in range(2):
        sinks.ensure_schema(spark, "papers_t", "chunks_t")
    assert spark.table("chunks_t").columns[-1] == "embedding_model" and len(spark.table("papers_t").columns) == 34


def test_streams(spark, tmp_path):
    events = spark.createDataFrame([("a", "q", "2024-01-01 00:00:00"), ("a", "q", "2024-01-01 05:00:00"), ("b", "q", "2024-01-01 06:00:00")], "arxiv_id string, event string, ts string").withColumn("ts", F.to_timestamp("ts"))
    events.write.parquet(str(tmp_path / "in"))
    stream = ingest.read_events(spark, str(tmp_path / "in"), events.schema)
    assert sorted(r["arxiv_id"] for r in ingest.drain_to_memory(ingest.new_papers(stream), "fresh").collect()) == ["a", "b"]
    for _ in range(2):
        ingest.write_stage(stream, lambda b: b.select("arxiv_id", "event"), str(tmp_path / "out"), str(tmp_path / "cp"), key="arxiv_id").awaitTermination()
    assert sorted(r["arxiv_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
    counted = ingest.drain_to_memory(ingest.windowed_counts(stream, late="0 seconds"), "counted")
    assert {(str(r["start"]), r["n"]) for r in counted.collect()} == {("2024-01-01 00:00:00", 1), ("2024-01-01 05:00:00", 1)}


def test_downloads(spark, tmp_path):
    papers = spark.createDataFrame([("a", "ok"), ("b", "down"), ("c", "big"), ("d", ""), ("e", "ok")], "arxiv_id string, pdf_url string")

    def fetch(url):
        if url == "down":
            raise ConnectionError("no route")
        return b"x" * (3 << 20) if url == "big" else b"pdf"

    found = {r["arxiv_id"]: (r["content"] and len(r["content"]), r["skip_reason"]) for r in files.fetch_pdfs(papers, papers.where("arxiv_id = 'e'"), fetch, most_mb=2, pause=lambda k: 0).collect()}
    assert found == {"a": (3, None), "b": (None, "download failed: no route"), "c": (None, "PDF too large (3.0 MB)"), "d": (None, "no address")}
    (tmp_path / "x.pdf").write_bytes(b"1")
    assert files.remove(spark, [str(tmp_path / "x.pdf"), str(tmp_path / "y.pdf")]) == 1
    answers = iter([False, True])
    files.wait_until_ready(lambda: next(answers), pause=0)
    with pytest.raises(TimeoutError):
        files.wait_until_ready(lambda: False, 2, 0)
    assert settings.redacted("redis://u:secret@h:1/0") == "redis://u:***@h:1/0" and settings.redacted("redis://h:1") == "redis://h:1"


def test_assets(spark):
    row = spark.createDataFrame([("", "t", "l", [(2, 1.0, 2.0, 3.0, 4.0)])], "o string, t string, l string, prov array<struct<page_no:int,l:double,t:double,r:double,b:double>>").select(files.picked_asset_text(F.col("o"), F.col("t"), F.col("l")), files.asset_place(F.col("prov"))).first()
    assert row[0] == "t" and row[1]["page_number"] == 2 and tuple(row[1]["bbox"]) == (1.0, 2.0, 3.0, 4.0)
    assert tuple(files.convert_summary(spark.createDataFrame([(True,), (False,)], "ok boolean")).first()) == (1, 2)


def test_pauses_grow_between_attempts():
    assert [files.backoff(k) for k in range(7)] == [4, 4, 4, 8, 16, 30, 30]


def test_answers_come_in_order(spark):
    pdfs = spark.createDataFrame([(f"d{i}", bytes([i]), None, 9 - i) for i in range(10)], "doc_id string, content binary, skip_reason string, pos int")
    found = files.call_in_order(pdfs, lambda service, content, options: (200, str(content[0])), "pos").collect()
    assert [r["tei_xml"] for r in found] == [str(i) for i in range(9, -1, -1)]
    with pytest.raises(ValueError, match="text"):
        files.call_text_service(pdfs, lambda *a: (200, ""), "processFulltextDocument")


def test_models_that_are_plugged_in():
    slept = []
    api = embed.ApiEmbedder("api", 2, lambda texts: [[float(len(t)), 1.0] for t in texts], batch=2, per_minute=20, sleep=slept.append)
    assert api.embed_batch(["a", "bb", "ccc", "d", "e"]) == [[1, 1], [2, 1], [3, 1], [1, 1], [1, 1]] and slept == [3.0, 3.0]
    with pytest.raises(ValueError, match="length"):
        embed.ApiEmbedder("api", 3, lambda texts: [[0.0] for _ in texts]).embed_batch(["a"])
    seen = []
    model = lambda **k: embed.WindowEmbedder("m", 2, lambda t: [0, *map(len, t.split())], lambda ids: seen.append(len(ids)) or [[[3.0, 4.0], *([float(x), 0.0] for x in row[1:])] for row in ids], window=3, batch=2, **k)
    assert model().embed_batch(["x", "y z w v", ""]) == [[0.6, 0.8]] * 3 and seen == [2, 1]
    assert model(pooling="mean", normalized=False).embed_batch(["xx xxxx xx"]) == [[3.0, 4 / 3]]
    assert model().token_counts(["", "a", "a b c d"]) == [1, 2, 3]
    with pytest.raises(ValueError):
        model(pooling="last")
    made = []
    factory = lambda: made.append(1) or embed.HashingEmbedder(8)
    assert embed.create("own", {"own": factory}) is embed.create("own", {"own": factory}) and made == [1]


def test_database_settings():
    base = settings.Database.from_env({"INKLOOM_DB_HOST": "h", "INKLOOM_DB_PORT": "1", "INKLOOM_DB_PASSWORD": "p"})
    assert base.options()["url"] == "jdbc:postgresql://h:1/papers" and base.options()["numPartitions"] == "10"
    assert settings.redacted(base.address()) == "postgresql://papers:***@h:1/papers"
    with pytest.raises(ValueError):
        settings.Database.from_env({"INKLOOM_DB_PORT": "x"})
