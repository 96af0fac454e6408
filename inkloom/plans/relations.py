"""Queries over the star schema: names, rules of the tables, inherited columns, sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkloom.functions import text as t
from inkloom.operators import dedup, lifecycle, validate
from inkloom.plans.registry import query


@query("SELECT c_custkey, c_name || ' (' || n_name || '; ' || r_name || ') <' || c_custkey || '@x.org>' AS author FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def author_format(read, spark):
    joined = read("customer").join(F.broadcast(read("nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(read("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("c_custkey", t.author_line(F.col("c_name"), F.array("n_name", "r_name"), F.concat("c_custkey", F.lit("@x.org"))).alias("author"))


@query("SELECT p_partkey, p_brand || ', ' || p_type || '. ' || p_name || '. (' || p_size || ')' AS reference FROM part")
def reference_format(read, spark):
    return read("part").select("p_partkey", t.reference_line(F.array("p_brand", "p_type"), F.col("p_name"), F.lit(""), F.col("p_size").cast("string")).alias("reference"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 7 <> 0)")
def fk_violations(read, spark):
    return validate.orphans(read("orders"), read("customer").where("c_custkey % 7 <> 0"), "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey FROM orders WHERE o_custkey % 11 <> 0")
def cascade_delete(read, spark):
    gone = read("customer").where("c_custkey % 11 = 0").select(F.col("c_custkey").alias("o_custkey"))
    return validate.cascade(read("orders").where("o_custkey is not null"), gone, "o_custkey").select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def unique_violations(read, spark):
    return validate.not_unique(read("lineitem"), "l_orderkey", "l_linenumber")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, list_filter([CASE WHEN l_returnflag NOT IN ('A', 'R') THEN 'chunk_type' END, CASE WHEN l_quantity <= 2 THEN 'token_count' END], lambda x: x IS NOT NULL) AS broken
FROM lineitem WHERE l_returnflag NOT IN ('A', 'R') OR l_quantity <= 2""")
def check_violations(read, spark):
    kind = F.when(F.col("l_returnflag") == "A", "body").when(F.col("l_returnflag") == "R", "caption").otherwise("elsewhere")
    chunks = read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", kind.alias("chunk_type"), F.lit(0).alias("section_order"), F.lit(0).alias("chunk"), (F.col("l_quantity") - 2).cast("int").alias("token_count"), F.lit(1).alias("word_count"), F.lit(None).cast("array<float>").alias("embedding"))
    return validate.chunk_violations(chunks).select("l_orderkey", "l_linenumber", "l_partkey", "broken")


@query("SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '[ \\n]+'), lambda w: w <> '')) AS INT) AS word_count, sha256(text) AS content_hash FROM documents")
def generated_columns(read, spark):
    return validate.with_generated(read("documents").select("doc_id", F.col("text").alias("content"))).select("doc_id", "word_count", "content_hash")


@query("SELECT d.doc_id, lang, source, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def inherit_metadata_join(read, spark):
    return read("documents").select("doc_id", "lang", "source").join(read("labels"), "doc_id")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 2 <> 0")
def insert_on_conflict_skip(read, spark):
    """All orders are the batch; those with an even key are stored already."""
    orders = read("orders").select("o_orderkey", "o_orderstatus")
    return dedup.insert_new(orders, orders.where("o_orderkey % 2 = 0"), "o_orderkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'new' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS version FROM orders")
def upsert(read, spark):
    stored = read("orders").select("o_orderkey", "o_orderstatus", F.lit(0).alias("version"))
    batch = read("orders").where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("new").alias("o_orderstatus"), F.lit(1).alias("version"))
    return dedup.upsert(stored, batch, "o_orderkey", "version")


@query("SELECT c_custkey, trim(c_name || ' ' || c_mktsegment) AS full_name, lower(c_mktsegment) AS section FROM customer")
def names_and_headings(read, spark):
    return read("customer").select("c_custkey", t.full_name(F.col("c_name"), F.col("c_mktsegment")).alias("full_name"), t.section_key(F.concat(F.lit("3.1  "), "c_mktsegment")).alias("section"))


@query("SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty, count(*) AS n FROM lineitem GROUP BY ALL")
def report_counts(read, spark):
    return read("lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.count("*").alias("n"))


@query("SELECT l_orderkey AS paper_id, l_linenumber AS chunk, l_partkey AS section_order, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_linenumber) AS INT) AS place FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem WHERE l_quantity > 20)")
def embedding_queue(read, spark):
    rows = read("lineitem").withColumn("embedding", F.when(F.col("l_quantity") <= 20, F.array(F.lit(1.0))))
    chunks = rows.select(F.col("l_orderkey").alias("paper_id"), F.col("l_linenumber").alias("chunk"), F.col("l_partkey").alias("section_order"), F.col("l_shipdate").alias("created_at"), "embedding").distinct()
    return lifecycle.embedding_queue(chunks).select("paper_id", "chunk", "section_order", "place")
