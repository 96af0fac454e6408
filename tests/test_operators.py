import math
import random
import re

import pytest
from pyspark.sql import functions as F

from inkloom.functions import vectors as v
from inkloom.operators import chunking, dedup, embed, fusion, layout, lifecycle, search, sections, validate


def brute_sections(spans):
    solid = [(s.strip(), z, p) for s, z, p in spans if s.strip()]
    sizes = sorted(z for _, z, _ in solid)
    median = sizes[len(sizes) // 2] if sizes else 12.0
    out, title, text, start, end = [], "Introduction", "", 0, 0
    for s, z, p in solid:
        if z >= 1.2 * median and len(s) < 120 and s[-1] != "," and text.strip():
            out.append((title, text, start, p))
            title, text, start = s, "", p
        else:
            text += s + " "
        end = p
    if text.strip():
        out.append((title, text, start, end))
    return out


def test_sections_follow_the_reader(spark):
    rng = random.Random(3)
    docs = {d: [(rng.choice(["Head", "body text", "  ", "x,", "y" * 119, "z" * 120]), rng.choice([10.0, 12.0, 14.4]), i // 3) for i in range(rng.randint(0, 25))] for d in range(60)}
    rows = [(d, i, s, z, p) for d, spans in docs.items() for i, (s, z, p) in enumerate(spans)]
    found = sections.segment(spark.createDataFrame(rows, "doc_id int, span_idx int, text string, size double, page int")).collect()
    for d, spans in docs.items():
        own = [(r["title"], r["text"], r["page_start"], r["page_end"]) for r in sorted(found, key=lambda r: r["section_order"]) if r["doc_id"] == d]
        assert own == brute_sections(spans), d


def brute_pack(parts, most, least, split):
    out, buf, n = [], [], 0
    for p in parts:
        w = len(p.split())
        if split and w > most:
            if buf:
                out.append(" ".join(buf))
                buf, n = [], 0
            out += brute_pack(re.split(r"(?<=[.!?])\s+", p), most, 0, False)
        elif n + w > most and buf:
            out.append(" ".join(buf))
            buf, n = [p], w
        else:
            buf, n = [*buf, p], n + w
    if buf:
        out.append(" ".join(buf))
    return [c for c in out if len(c.split()) >= least and (split or c.strip())]


def test_packing(spark):
    rng = random.Random(4)
    docs = [(i, [" ".join(rng.choice(["a", "b.", "c!", "dd", "e?"]) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 8))]) for i in range(80)]
    found = dict(spark.createDataFrame(docs, "i int, ps array<string>").select("i", chunking.pack_paragraphs(F.col("ps"), 15, 3)).collect())
    assert found == {i: brute_pack(ps, 15, 3, True) for i, ps in docs}


def test_recursive_splitting():
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice(["word ", "x", ". ", "\n", "\n\n", "longerword"]) for _ in range(rng.randint(0, 80)))
        chunks = chunking.split_recursively(text, 40, 10)
        assert all(len(c) <= 40 and c == c.strip() and c for c in chunks)
        assert all(w in " ".join(chunks) for w in re.findall("[a-z]+", text) if len(w) < 10)
    assert chunking.split_recursively("aaaa bbbb cccc dddd", 10, 5) == ["aaaa bbbb", "bbbb cccc", "cccc dddd"]
    assert chunking.split_recursively("abcdefghij", 4, 1) == ["abcd", "defg", "ghij"]


def test_chunk_ids_have_gaps(spark):
    rows = spark.createDataFrame([("p", 0, "T", "x" * 150, "u"), ("p", 1, None, "y" * 99, "u"), ("p", 2, None, ("z" * 60 + " ") * 3, "u")], "arxiv_id string, section_order int, title string, text string, pdf_url string")
    found = {r["chunk_id"]: (r["section"], r["token_count"]) for r in chunking.chunk_rows(rows, size=130, overlap=0).collect()}
    assert found == {"p_0_0": ("T", 32), "p_2_0": ("Body", 30)}


def test_match_scores(spark):
    box = "struct<x1:double,y1:double,x2:double,y2:double>"
    kind = f"doc_id int, ai int, asset_type string, caption string, text string, page_number int, bbox {box}"
    refs = "doc_id int, ri int, fig_id string, label string, caption string, coords struct<page:int,x1:double,y1:double,x2:double,y2:double>"
    h = v.PAGE_HEIGHT
    a = spark.createDataFrame([(1, 0, "picture", "Figure 1: loss curve", None, 1, (0.0, h - 10, 10.0, h - 0.0)), (1, 1, "table", "", None, 2, None), (1, 2, "picture", None, None, None, None), (2, 0, "formula", "x", None, 1, None)], kind)
    r = spark.createDataFrame([(1, 0, "f0", "Figure 1", "loss curve", (1, 0.0, 0.0, 10.0, 10.0)), (1, 1, "t", "Table 2", "sizes", (2, 0.0, 0.0, 1.0, 1.0))], refs)
    out = {(x["doc_id"], x["ai"]): (x["ri"], round(x["match_confidence"], 6), x["caption"]) for x in fusion.fuse(a, r).collect()}
    assert out == {(1, 0): (0, 1.0, "Figure 1: loss curve"), (1, 1): (1, 0.15, "sizes"), (1, 2): (None, 0.0, None), (2, 0): (None, 0.0, "x")}
    report = {x["doc_id"]: (x["assets"], x["matched"], x["unmatched"], x["figures"]) for x in fusion.fused_report(fusion.fuse(a, r)).collect()}
    assert report == {1: (3, 2, 1, 2), 2: (1, 0, 1, 0)}


def brute_greedy(scores):
    out, used_a, used_r = {}, set(), set()
    while True:
        best = max(((s, -a, -r) for (a, r), s in scores.items() if s > 0 and a not in used_a and r not in used_r), default=None)
        if best is None:
            return out
        s, a, r = best
        out[-a] = (-r, s)
        used_a.add(-a)
        used_r.add(-r)


def test_greedy_matching(spark):
    rng = random.Random(6)
    docs = {d: {(a, r): rng.choice([0.0, 0.1, 0.5, 0.7]) for a in range(rng.randint(1, 5)) for r in range(rng.randint(1, 5))} for d in range(40)}
    rows = [(d, a, r, s) for d, m in docs.items() for (a, r), s in m.items()]
    found = {}
    for x in fusion.greedy(spark.createDataFrame(rows, "doc_id int, ai int, ri int, score double")).collect():
        found.setdefault(x["doc_id"], {})[x["ai"]] = (x["ri"], x["score"])
    assert {d: found.get(d, {}) for d in docs} == {d: brute_greedy(m) for d, m in docs.items()}


def test_boxes(spark):
    b = lambda *c: F.struct(*[F.lit(float(x)).alias(n) for x, n in zip(c, ("x1", "y1", "x2", "y2"), strict=True)])
    row = spark.range(1).select(
        v.iou(b(0, 0, 2, 2), b(1, 1, 3, 3)), v.iou(b(0, 0, 1, 1), b(2, 2, 3, 3)), v.flip(b(0, 1, 2, 3), 10.0), v.coords_box(F.lit("2,1,2,3,4;2,0,5,9,1;x")), v.coords_box(F.lit("bad")), v.coords_box(F.lit("8,10,20,3,4"), as_size=True)
    ).first()
    assert (row[0], row[1], tuple(row[2]), tuple(row[3]), row[4], tuple(row[5])) == (1 / 7, 0.0, (0, 7, 2, 9), (2, 0, 2, 9, 4), None, (8, 10, 20, 13, 24))


LAYOUT = """[[{"type":"paragraph","content":{"paragraph_content":[{"type":"text","content":"before any title, long enough"}]}},
{"type":"page_header","content":{}}],[{"type":"title","content":{"title_content":[{"type":"text","content":"A\u00a0B"}],"level":1}},
{"type":"paragraph","content":{"paragraph_content":[{"type":"text","content":"see"},{"type":"equation_inline","content":"x=1"},{"type":"other","content":"no"},{"type":"text","content":"and more text"}]}},
{"type":"paragraph","content":{"paragraph_content":[{"type":"text","content":"fifteen chars.."}]}},
{"type":"chart","content":{"chart_caption":[{"type":"text","content":"Cap\u00a01"}],"image_source":{"path":"c.png"}}}]]"""


def test_layout_groups(spark):
    rows = layout.group_by_title(layout.clean_items(layout.items(spark.createDataFrame([("d", LAYOUT), ("bad", "{"), ("none", None)], "doc_id string, layout string"))))
    found = [(r["doc_id"], r["group_order"], r["title"], r["paragraphs"], r["assets"]) for r in rows.orderBy("group_order").collect()]
    assert found == [("d", 0, "Untitled", ["before any title, long enough"], []), ("d", 1, "A B", ["see x=1 and more text"], ["![Cap 1](c.png) Cap 1"])]


def test_states_and_expiry(spark):
    e = spark.createDataFrame([("a", "queued", 1), ("a", "processed", 2), ("b", "processed", 1), ("b", "reset", 2), ("b", "queued", 3), ("c", "queued", 1), ("c", "reset", 5)], "arxiv_id string, event string, h int").selectExpr("arxiv_id", "event", "timestamp'2024-01-01' + make_interval(0,0,0,0,h) as ts")
    state = dedup.current_state(e)
    assert {r["arxiv_id"]: r["status"] for r in state.collect()} == {"a": "processed", "b": "queued"}
    at = lambda minutes: F.expr(f"timestamp'2024-01-01 03:00:00' + make_interval(0,0,2,0,0,{minutes})".replace("0,0,2,", "0,0,0,2,"))
    assert {r["arxiv_id"] for r in dedup.blocking(state, at(-1)).collect()} == {"a", "b"}
    assert {r["arxiv_id"] for r in dedup.blocking(state, at(0)).collect()} == {"a"}


@pytest.mark.parametrize("n", [49, 50, 51])
def test_drain_takes_fifty(spark, n):
    m = spark.range(n).selectExpr("'dlx.scrape' as queue", "id as pos", "timestamp'2024-01-01' as enqueued_at")
    assert {r["queue"]: r["count"] for r in lifecycle.drain(m).groupBy("queue").count().collect()} == {k: c for k, c in (("scrape", min(n, 50)), ("dlx.scrape", n - 50)) if c > 0}


def test_only_one_row_of_a_key_is_inserted(spark):
    batch = spark.createDataFrame([("k1", 2), ("k1", 1), ("k2", 1), (None, 1)], "chunk_id string, x int")
    stored = spark.createDataFrame([("k2", 0)], "chunk_id string, x int")
    assert {tuple(r) for r in dedup.insert_new(batch, stored).collect()} == {("k1", 1), (None, 1)}
    assert {tuple(r) for r in dedup.upsert(stored, batch.where("x = 1"), "chunk_id", "x").collect()} == {("k1", 1), ("k2", 1), (None, 1)}


def test_embeddings(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "i int, text string")
    found = {r["i"]: r for r in embed.with_embeddings(rows, embed.HashingEmbedder).collect()}
    assert math.isclose(sum(x * x for x in found[1]["embedding"]), 1, rel_tol=1e-5) and found[2]["embedding"] is None and found[1]["embedding_dim"] == 64
    with pytest.raises(ValueError, match="unknown"):
        embed.create("nothing")


def test_knn_against_brute_force(spark):
    rng = random.Random(8)
    vecs = {i: [rng.gauss(0, 1) for _ in range(5)] for i in range(60)} | {60: [0.0] * 5, 61: None}
    df = spark.createDataFrame(list(vecs.items()), "vec_id long, embedding array<float>")
    import numpy as np

    live = {i: np.float32(x).astype(float) for i, x in vecs.items() if x is not None and any(x)}
    unit = {i: x / np.linalg.norm(x) for i, x in live.items()}
    for most in (search.QUERY_BYTES, 200):
        found = {}
        for r in search.knn(df.where("vec_id % 7 = 0"), df, 4, most=most).collect():
            found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
        for q in range(0, 60, 7):
            best = sorted((i for i in unit if i != q), key=lambda i: (-float(unit[q] @ unit[i]), i))[:4]
            assert [i for _, i in sorted(found[q])] == best


def test_rules(spark):
    chunks = validate.with_generated(spark.createDataFrame([("body", 0, 0, 1, "two words", None), ("odd", -1, 0, 0, "  ", [1.0])], "chunk_type string, section_order int, chunk int, token_count int, content string, embedding array<float>"))
    assert [r["broken"] for r in validate.chunk_violations(chunks).collect()] == [["chunk_type", "section_order", "token_count", "word_count", "embedding"]]
    papers = spark.createDataFrame([("p", "t", "done", "journal"), ("q", None, "lost", "blog")], "paper_id string, title string, processing_status string, venue_type string")
    assert [r["broken"] for r in validate.paper_violations(papers).collect()] == [["processing_status", "venue_type", "title"]]
    history = spark.createDataFrame([("p", 1, "pending"), ("p", 2, "indexing"), ("p", 3, "done"), ("q", 1, "done"), ("q", 2, "pending")], "paper_id string, ts int, status string")
    assert {(r["paper_id"], r["ts"]) for r in lifecycle.illegal_steps(history).collect()} == {("q", 1), ("q", 2)}


def test_size_in_reason_is_rounded_as_sql_does(spark):
    """Halves go to the even tenth, and what is just beside them to the nearest."""
    quarter = 1 << 18
    sizes = [None, 0, 50 << 20, (50 << 20) + 1, *(k * quarter + d for k in range(200, 232) for d in (-1, 0, 1)), *(n * 4096 for n in range(12790, 13400)), (1 << 50) + quarter, (1 << 50) + 3 * quarter]
    found = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "i int, n long").select("i", lifecycle.skip_reason(F.col("n"))).collect()
    assert dict(map(tuple, found)) == {i: f"PDF too large ({n / 1048576:.1f} MB)" if n is not None and n > 50 << 20 else None for i, n in enumerate(sizes)}
