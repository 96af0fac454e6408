"""Queries over vectors, boxes and captions."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkloom.functions import text as t
from inkloom.functions import vectors as v
from inkloom.operators import embed, fusion, search
from inkloom.plans.registry import query

_KNN = """hits AS (
  SELECT q.vec_id AS query_id, b.vec_id, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS c FROM embeddings q JOIN embeddings b ON q.vec_id <> b.vec_id WHERE q.vec_id % 100 = 0),
top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, vec_id) AS rank FROM hits QUALIFY rank <= 10)
"""


def _queries(read):
    return read("embeddings").where("vec_id % 100 = 0")


@query("WITH " + _KNN + "SELECT query_id, vec_id, round(c, 6) AS cosine, CAST(rank AS INT) AS rank FROM top")
def knn_cosine_topk(read, spark):
    return search.knn(_queries(read), read("embeddings"), 10).withColumn("cosine", F.round("cosine", 6))


@query("WITH " + _KNN + ", votes AS (SELECT query_id, label, count(*) AS votes FROM top JOIN embeddings USING (vec_id) GROUP BY query_id, label) SELECT query_id, label, votes FROM votes QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, label) = 1")
def knn_label_vote(read, spark):
    return search.label_vote(search.knn(_queries(read), read("embeddings"), 10), read("embeddings"))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))), 5) AS length, round(CAST(embedding[1] AS DOUBLE) / sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))), 5) AS first FROM embeddings")
def l2_normalize(read, spark):
    return read("embeddings").select("vec_id", F.round(v.norm(F.col("embedding")), 5).alias("length"), F.round(v.normalised(F.col("embedding"))[0], 5).alias("first"))


@query("SELECT label, count(*) AS vectors, CAST(count_if(len(embedding) <> 64) AS BIGINT) AS wrong FROM embeddings GROUP BY label")
def dim_check(read, spark):
    return read("embeddings").groupBy("label").agg(F.count("*").alias("vectors"), F.count_if(F.size("embedding") != 64).alias("wrong"))


@query("SELECT vec_id FROM embeddings WHERE vec_id % 3 <> 0")
def drop_missing_embedding(read, spark):
    return embed.embedded_only(read("embeddings").withColumn("embedding", F.when(F.col("vec_id") % 3 != 0, F.col("embedding")))).select("vec_id")


@query("SELECT vec_id, 'model' || (label % 2) AS embedding_model FROM embeddings WHERE label % 2 <> 0")
def stale_model(read, spark):
    return embed.stale(read("embeddings").withColumn("embedding_model", F.concat(F.lit("model"), (F.col("label") % 2).cast("string"))), "model0").select("vec_id", "embedding_model")


@query("""WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '')) AS w FROM documents), h AS (SELECT doc_id, md5_number_lower(w) AS h FROM w),
s AS (SELECT doc_id, (h >> 20) % 64 AS k, sum(CASE WHEN (h >> 60) & 1 = 1 THEN 1 ELSE -1 END) AS v FROM h GROUP BY ALL),
n AS (SELECT doc_id, list(k) FILTER (v > 0) AS p, list(k) FILTER (v < 0) AS m FROM s GROUP BY doc_id)
SELECT d.doc_id, array_to_string(list_transform(range(64), lambda i: CASE WHEN list_contains(p, i::UBIGINT) THEN '+' WHEN list_contains(m, i::UBIGINT) THEN '-' ELSE '0' END), '') AS signs FROM documents d LEFT JOIN n USING (doc_id)""")
def hashing_embeddings(read, spark):
    sign = F.transform("embedding", lambda x: F.when(x > 0, "+").when(x < 0, "-").otherwise("0"))
    return embed.with_embeddings(read("documents"), embed.HashingEmbedder).select("doc_id", F.array_join(sign, "").alias("signs"))


@query("SELECT a, b, cosine FROM (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id) WHERE isfinite(cosine) AND cosine >= 0.93")
def approximate_pairs(read, spark):
    return search.similar_pairs(read("embeddings"), 0.93)


_STOPS = "['figure','fig','table','tab','the','a','an','of','in','and','is','are','for']"


@query(f"""WITH n AS (SELECT p_partkey, list_distinct(list_filter(regexp_extract_all(lower('The ' || p_name || ' of ' || p_type), '\\w+'), lambda w: NOT list_contains({_STOPS}, w))) AS a,
  list_distinct(list_filter(regexp_extract_all(lower('a ' || p_type || ' ring'), '\\w+'), lambda w: NOT list_contains({_STOPS}, w))) AS b FROM part)
SELECT p_partkey, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) AS similarity FROM n""")
def caption_jaccard(read, spark):
    a, b = F.concat(F.lit("The "), "p_name", F.lit(" of "), "p_type"), F.concat(F.lit("a "), "p_type", F.lit(" ring"))
    return read("part").select("p_partkey", F.round(t.caption_similarity(a, b), 6).alias("similarity"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN [CAST(p_size AS VARCHAR), CAST(p_partkey AS VARCHAR)] WHEN 1 THEN [] ELSE ['0' || p_size] END AS numbers FROM part")
def ordinals_match(read, spark):
    text = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("Fig. "), "p_size", F.lit(" and "), "p_partkey")).when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.lit(" II"))).otherwise(F.concat("p_type", F.lit("0"), "p_size", F.lit("a")))
    return read("part").select("p_partkey", t.ordinals(text).alias("numbers"))


def _boxes(read):
    lines = read("lineitem")
    box = lambda dx, dy: F.struct((F.col("l_quantity") + dx).alias("x1"), (F.col("l_linenumber") * 10.0 + dy).alias("y1"), (F.col("l_quantity") + dx + 20).alias("x2"), (F.col("l_linenumber") * 10.0 + dy + 12).alias("y2"))
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", box(0.0, 0.0).alias("a"), box(4.0, 5.0).alias("b"))


def _iou_pairs(boxes):
    x, y = boxes.alias("x"), boxes.alias("y")
    pairs = x.join(y, F.col("x.l_orderkey") == F.col("y.l_orderkey"))
    return pairs.select(F.col("x.l_orderkey").alias("l_orderkey"), F.col("x.l_linenumber").alias("ai"), F.col("x.l_partkey").alias("ap"), F.col("y.l_linenumber").alias("ri"), F.col("y.l_partkey").alias("rp"), F.round(v.iou(F.col("x.a"), F.col("y.b")), 6).alias("iou"))


def _flip_boxes(boxes):
    f = v.flip(F.col("a"))
    return boxes.select("l_orderkey", "l_linenumber", "l_partkey", f["x1"].alias("x1"), F.round(f["y1"], 6).alias("y1"), f["x2"].alias("x2"), F.round(f["y2"], 6).alias("y2"))


_IOU = "CASE WHEN least(a.x + 20, c.x + 24) > greatest(a.x, c.x + 4) AND least(a.y + 12, c.y + 17) > greatest(a.y, c.y + 5) THEN ((least(a.x + 20, c.x + 24) - greatest(a.x, c.x + 4)) * (least(a.y + 12, c.y + 17) - greatest(a.y, c.y + 5))) / (480 - (least(a.x + 20, c.x + 24) - greatest(a.x, c.x + 4)) * (least(a.y + 12, c.y + 17) - greatest(a.y, c.y + 5))) ELSE 0 END"


@query(f"WITH b AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_quantity AS x, l_linenumber * 10.0 AS y FROM lineitem) SELECT a.k AS l_orderkey, a.n AS ai, a.p AS ap, c.n AS ri, c.p AS rp, round(CAST({_IOU} AS DOUBLE), 6) AS iou FROM b a JOIN b c ON a.k = c.k")
def iou_pairs(read, spark):
    return _iou_pairs(_boxes(read))


_ALL = "b AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_quantity AS x, l_linenumber * 10.0 AS y FROM lineitem)"


@query(f"""WITH RECURSIVE {_ALL},
pairs AS (SELECT a.k, a.n AS ai, c.n AS ri, max(CAST({_IOU} AS DOUBLE)) AS score FROM b a JOIN b c ON a.k = c.k GROUP BY a.k, a.n, c.n),
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, ai, ri) AS i FROM pairs WHERE score > 0),
walk AS (
  SELECT k, i, ai, ri, score, true AS hit, [ai] AS l, [ri] AS r FROM ranked WHERE i = 1
  UNION ALL
  SELECT p.k, p.i, p.ai, p.ri, p.score, NOT (list_contains(w.l, p.ai) OR list_contains(w.r, p.ri)),
    CASE WHEN list_contains(w.l, p.ai) OR list_contains(w.r, p.ri) THEN w.l ELSE list_append(w.l, p.ai) END, CASE WHEN list_contains(w.l, p.ai) OR list_contains(w.r, p.ri) THEN w.r ELSE list_append(w.r, p.ri) END
  FROM walk w JOIN ranked p ON p.k = w.k AND p.i = w.i + 1)
SELECT k AS doc_id, ai, ri, round(score, 6) AS score FROM walk WHERE hit""")
def greedy_match(read, spark):
    x, y = _boxes(read).alias("x"), _boxes(read).alias("y")
    pairs = x.join(y, F.col("x.l_orderkey") == F.col("y.l_orderkey")).select(F.col("x.l_orderkey").alias("doc_id"), F.col("x.l_linenumber").alias("ai"), F.col("y.l_linenumber").alias("ri"), v.iou(F.col("x.a"), F.col("y.b")).alias("score"))
    return fusion.greedy(pairs.groupBy("doc_id", "ai", "ri").agg(F.max("score").alias("score"))).withColumn("score", F.round("score", 6))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS x1, CAST(round(841.89 - (l_linenumber * 10.0 + 12), 6) AS DOUBLE) AS y1, l_quantity + 20 AS x2, CAST(round(841.89 - l_linenumber * 10.0, 6) AS DOUBLE) AS y2 FROM lineitem")
def flip_boxes(read, spark):
    return _flip_boxes(_boxes(read))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 4 ELSE CAST(p_partkey % 9 + 1 AS INT) END AS page,
CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN p_partkey % 40 ELSE least(p_size, p_partkey % 40) END::DOUBLE AS x1, CASE WHEN p_partkey % 7 <> 0 THEN 1.5 END::DOUBLE AS y1,
CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN p_partkey % 40 + 10 ELSE greatest(p_size + 5, p_partkey % 40 + 10) END::DOUBLE AS x2, CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 8 ELSE 9 END::DOUBLE AS y2 FROM part""")
def coords_union(read, spark):
    """Two places for each part, some of which can't be read."""
    key, far = F.col("p_partkey"), F.col("p_partkey") % 40
    first = F.when((key % 5 == 0) | (key % 7 == 0), F.lit("bad,1")).otherwise(F.concat_ws(",", key % 9 + 1, "p_size", F.lit(2), F.col("p_size") + 5, F.lit(9)))
    second = F.when(key % 7 == 0, F.lit("4,x,1,2,3")).otherwise(F.concat_ws(",", F.lit(4), far, F.lit(1.5), far + 10, F.lit(8)))
    c = v.coords_box(F.concat_ws(";", first, second))
    return read("part").select("p_partkey", c["page"].alias("page"), c["x1"].alias("x1"), c["y1"].alias("y1"), c["x2"].alias("x2"), c["y2"].alias("y2"))


_GRAMS = "list_distinct(flatten(list_transform(regexp_extract_all(lower({x}), '[a-z0-9]+'), lambda w: list_transform(range(1, length(w) + 2), lambda i: ('  ' || w || ' ')[i:i + 2]))))"


@query(f"WITH g AS (SELECT p_partkey, p_name, {_GRAMS.format(x='p_name')} AS a, {_GRAMS.format(x=chr(39) + 'blue widgets' + chr(39))} AS b FROM part), s AS (SELECT p_partkey, p_name, len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) AS s FROM g) SELECT p_partkey, p_name, round(s, 6) AS similarity FROM s WHERE s >= 0.3")
def trigram_similarity(read, spark):
    return search.similar_titles(read("part"), "p_name", "blue widgets").select("p_partkey", "p_name", F.round("similarity", 6).alias("similarity"))


@query("SELECT p_partkey FROM part WHERE list_has_any(string_split(p_name, ' '), ['red', 'ring']) AND list_has_all(string_split(p_name || ' ' || lower(p_type), ' '), ['small'])")
def array_containment(read, spark):
    names = F.split("p_name", " ")
    return read("part").where(search.holds_any(names, ["red", "ring"]) & search.holds_all(F.split(F.concat_ws(" ", "p_name", F.lower("p_type")), " "), ["small"])).select("p_partkey")
