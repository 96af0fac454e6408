import os
import random

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F
from test_queries import DIR, TABLES, compare

import __spark_entry__ as entry
from inkloom.llm import queries

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


def test_stages_by_brute_force(spark, tmp_path):
    """Each stage against what its decision means, on the stage's own input."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DIR).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
            now = {r["doc_id"]: r["text"] for r in after.collect()}
            assert set(now) <= set(before) and after.count() == len(now)
        if name == "quality_classifier":
            truth = dict(spark.read.parquet(f"{DIR}/labels.parquet").select("doc_id", "quality").collect())
            wrong = [i for i in before if i in truth and bool(truth[i]) != (i in now)]
            assert len(wrong) <= 0.03 * len(truth)
        if name == "minhash_near_dedup":
            sets = {i: {tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))} for i, w in ((i, t.lower().split()) for i, t in before.items())}
            for i in now:
                assert all(len(sets[i] & sets[j]) < 0.8 * len(sets[i] | sets[j]) for j in now if j < i)
            for i in set(before) - set(now):
                assert any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in before if j != i)
        if name == "suffix_array_dedup":
            seen = set()
            for i in sorted(before):
                b = before[i].encode()
                windows = [b[j : j + 100] for j in range(len(b) - 99)]
                touched = any(w in seen or w in windows[:j] for j, w in enumerate(windows))
                assert (now[i] != before[i]) == touched
                seen.update(windows)
            assert after.where(F.length("text") != F.col("n_chars")).count() == 0
        if name == "benchmark_decontamination":
            items = [r["text"] for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
            assert {i for i, t in before.items() if not any(x in t for x in items)} == set(now)
        docs = after
    assert after.count() == len(before)


def test_run_is_the_chain(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert sorted(map(tuple, corpus_pipeline.run(spark, DIR).collect())) == sorted(map(tuple, docs.collect()))


TABLES_OF_IT = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}


def written(spark, folder, **tables):
    """Tables in a folder; those not given are empty."""
    for name, schema in TABLES_OF_IT.items():
        rows = tables.get(name)
        (rows if rows is not None else spark.createDataFrame([], schema)).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_pipeline_of_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path)).count() == 0


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in every column, repeated ids and rows, long texts and columns of clashing names; without labels the classifier keeps all."""
    words = [f"w{i}" for i in range(400)]
    item = " ".join(f"v{i}" for i in range(30))
    rng = random.Random(2)
    own = lambda n: " ".join(rng.choice(words) for _ in range(n))
    near = own(80).split()
    passage = own(40)
    rows = [(1, " ".join(near), "en", "a", 5), (2, " ".join([*near[:79], "other"]), None, None, None), (3, f"{own(30)} {passage}", "en", None, 1), (4, f"{passage} {own(30)}", "fr", "b", 2), (5, f"{own(20)} {item} {own(20)}", "en", "a", 3)]
    rows += [(6, None, None, None, None), (7, "", "en", "a", 0), (7, "", "en", "a", 0), (8, own(9000), "en", "a", 9), (9, own(20), "en", "a", 9), (9, own(21), "en", "a", 9), (None, own(25), "en", "a", 9), (None, None, None, None, None)]
    kind = TABLES_OF_IT["documents"]
    extra = ["id", "rep", "mark", "row", "seeds", "item_id", "component", "quality", "kind", "bucket", "rest", "kept"]
    docs = spark.createDataFrame(rows, kind).select("*", *[F.lit(1).alias(c) for c in extra])
    found = corpus_pipeline.run(spark, written(spark, tmp_path, documents=docs, benchmark=spark.createDataFrame([(1, item), (None, item), (2, None), (3, "short")], TABLES_OF_IT["benchmark"])))
    left = sorted(r["doc_id"] if r["doc_id"] is not None else 0 for r in found.select("doc_id").collect())
    assert left == [0, 0, 1, 3, 4, 6, 7, 7, 8, 9, 9]
    # the passage that repeats goes from the later text
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    cut = {r["doc_id"]: r["text"] for r in corpus_pipeline.cut_repeats(spark, docs, str(tmp_path)).where("doc_id in (3, 4)").collect()}
    assert passage in cut[3] and passage not in cut[4] and docs.columns == corpus_pipeline.cut_repeats(spark, docs, str(tmp_path)).columns


def test_registered():
    assert {f"op{n}_" for n in range(1, 11)} == {q.split("_")[0] + "_" for q in queries.QUERIES if q != "pipeline"}
    assert set(queries.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    compare(spark, duck, name, queries.QUERIES, queries.ORACLES)
