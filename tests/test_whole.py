"""Queries and operators do the whole job: all pairs, all rows, whole texts."""

import math
from hashlib import md5

import duckdb
import numpy as np
import pytest

from inkloom.operators import embed, search
from inkloom.plans import registry

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def close():
    """Vectors of which pairs lie on both sides of 0.93, some with copies; a zero one and a null."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(60):
        base = rng.normal(size=64)
        base /= np.linalg.norm(base)
        for c in (1.0, 1.0, 0.99, 0.96, 0.945, 0.935, 0.925):
            off = rng.normal(size=64)
            off -= off @ base * base
            rows.append(np.float32(c * base + math.sqrt(1 - c * c) * off / np.linalg.norm(off)).tolist())
    return [(i, v) for i, v in enumerate([*rows, [0.0] * 64, None])]


def test_similar_pairs_are_all_pairs(spark, close):
    live = {i: np.asarray(v, dtype=float) for i, v in close if v is not None and any(v)}
    at, m = list(live), np.stack([v / np.linalg.norm(v) for v in live.values()])
    score = m @ m.T
    expected = {(at[i], at[j]): score[i, j] for i, j in zip(*np.nonzero(score >= 0.93), strict=True) if i < j}
    df = spark.createDataFrame(close, "vec_id long, embedding array<float>")
    for block in (search.BLOCK_ROWS, 20):
        found = search.similar_pairs(df.unionByName(df), 0.93, block=block).collect()
        assert len(found) == len({(r["a"], r["b"]) for r in found})
        assert {(r["a"], r["b"]) for r in found} == set(expected)
        assert all(math.isclose(r["cosine"], expected[r["a"], r["b"]], rel_tol=1e-9) for r in found)
    named = spark.createDataFrame([(f"v{i}", v) for i, v in close], "vec_id string, embedding array<float>")
    assert {(r["a"], r["b"]) for r in search.similar_pairs(named, 0.93).collect()} == {tuple(sorted((f"v{i}", f"v{j}"))) for i, j in expected}


def test_approximate_pairs_query(spark, close, tmp_path):
    """The registered query against its SQL on a table that has such pairs."""
    spark.createDataFrame(close, "vec_id long, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    expected = {(a, b): c for a, b, c in duck.execute(registry.ORACLES["approximate_pairs"]).fetchall()}
    found = {(r["a"], r["b"]): r["cosine"] for r in registry.QUERIES["approximate_pairs"](spark, str(tmp_path)).collect()}
    assert len(expected) > 300 and set(found) == set(expected)
    assert all(math.isclose(found[k], c, rel_tol=1e-9) for k, c in expected.items())


def test_greedy_match_takes_all_orders(spark):
    """The query against a matching by hand of every order."""
    lines = {}
    for r in registry.table(spark, DIR, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity").collect():
        lines.setdefault(r[0], []).append((r[1], float(r[2])))
    expected = set()
    for order, rows in lines.items():
        scores = {}
        for ai, x in rows:
            for ri, y in rows:
                w, h = min(x + 20, y + 24) - max(x, y + 4), min(ai * 10.0 + 12, ri * 10.0 + 17) - max(ai * 10.0, ri * 10.0 + 5)
                both = w * h if w > 0 and h > 0 else 0.0
                scores[ai, ri] = max(scores.get((ai, ri), 0.0), both / (480 - both))
        used_a, used_r = set(), set()
        for (ai, ri), s in sorted(scores.items(), key=lambda x: (-x[1], x[0])):
            if s > 0 and ai not in used_a and ri not in used_r:
                used_a.add(ai)
                used_r.add(ri)
                expected.add((order, ai, ri, round(s, 6)))
    found = registry.QUERIES["greedy_match"](spark, DIR).collect()
    assert len(found) == len(expected) and {(r["doc_id"], r["ai"], r["ri"], round(r["score"], 6)) for r in found} == expected


@pytest.mark.parametrize(("name", "table"), [("iou_pairs", "lineitem"), ("flip_boxes", "lineitem"), ("abstract_sections", "documents")])
def test_no_row_is_left_out(spark, name, table):
    """tests/test_queries.py holds these against their SQL; here every row of the table must be met."""
    key = {"lineitem": "l_orderkey", "documents": "doc_id"}[table]
    there = {r[0] for r in registry.table(spark, DIR, table).where("true" if table == "lineitem" else "text <> ''").select(key).collect()}
    assert {r[0] for r in registry.QUERIES[name](spark, DIR).select(key).collect()} == there


def brute_embedding(text, dim=64):
    out = [0] * dim
    for word in text.lower().split():
        h = int.from_bytes(md5(word.encode()).digest()[8:], "little")
        out[(h >> 20) % dim] += 1 if (h >> 60) & 1 else -1
    length = math.sqrt(sum(x * x for x in out))
    return [x / length if length else 0.0 for x in out]


def test_embeddings_read_whole_texts_and_words(spark):
    """The vectors of whole documents, some of more than 512 words, against a sum over all their words."""
    docs = {r["doc_id"]: r["text"] for r in registry.table(spark, DIR, "documents").collect()}
    assert max(len(t.split()) for t in docs.values()) > 1000
    found = embed.with_embeddings(registry.table(spark, DIR, "documents"), embed.HashingEmbedder).collect()
    assert len(found) == len(docs)
    for r in found:
        assert np.allclose(r["embedding"], brute_embedding(docs[r["doc_id"]]), atol=1e-6), r["doc_id"]
    start = "same " * 600
    one, other, longer, alike = embed.HashingEmbedder().embed_batch([start + "dataset", start + "model", "internationalisation", "internationalise"])
    assert one != other and longer != alike


INJECTED = {
    "clean_citations": ["[1, 2]", "[3-5]", "(Smith et al., 2020; Doe, 1999a)"], "clean_captions": ["Figure 3:", "fig. 12.", "Table 4:", "Algorithm 1."], "clean_latex": [r"\mathbf", r"\alpha", r"\beta"],
    "clean_page_numbers": ["Page 7", "\n12\n"], "clean_hyphen": ["pro-\n", "re-\n"], "clean_arxiv_header": ["arXiv:"],
}


@pytest.mark.parametrize("name", sorted(INJECTED))
def test_whole_texts_are_cleaned(spark, name):
    """tests/test_queries.py holds these against their SQL; here each result has the whole text and nothing of the injected part."""
    docs = {r["doc_id"]: len("".join(r["text"].split())) for r in registry.table(spark, DIR, "documents").collect()}
    found = {r["doc_id"]: r["cleaned"] for r in registry.QUERIES[name](spark, DIR).collect()}
    assert set(found) == set(docs)
    for d, cleaned in found.items():
        assert len("".join(cleaned.split())) >= 2 * docs[d], d
        assert not any(x in cleaned for x in INJECTED[name]), d
