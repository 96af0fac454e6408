"""Connected components of links by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.llm.common import cut


def _down(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Every node has one smaller neighbour, which has none: nothing is left to do."""
    more = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    chained = edges.select(F.col("v").alias("u")).distinct().join(edges.select("u"), "u", "left_semi")
    return more.unionByName(chained).isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id that has a link; component is the smallest id reachable.

    Each round is joins and aggregates keyed by node; the number of rounds grows
    with the logarithm of the longest path.  The least neighbours of all nodes, summed up
    before they are shuffled, are cut from the lineage first, so that the join
    has two plain shuffles and its partitions with a node of very many links
    can be split at run time.  Every round ends in a reliable checkpoint.  Null ends
    and links of an id with itself are left out; no links give no rows.  Only the answer whether it is done comes to the driver.
    """
    now = cut(_down(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(f"`{a}` is not null and `{b}` is not null")), 3)
    while not _is_stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), 3)
        large = _down(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))))
        small = large.groupBy("u").agg(F.min("v").alias("m"))  # after the large star no node has many links to smaller ones
        joined = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(_down(joined.unionByName(small.select("u", F.col("m").alias("v")))), 3)
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def in_blocks(rows: DataFrame, key: str, blocks, salt: str) -> DataFrame:
    """Rows with `block_i`, `block_j` so that any two rows of a key meet in a group of at most two blocks.

    blocks: column, the same for all rows of a key.  With one block the rows
    appear once; with n blocks each row goes to the n groups of its block.
    """
    n = F.greatest(blocks.cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64(salt), n).cast("int")
    spread = rows.withColumn("_n", n).withColumn("_own", own)
    spread = spread.withColumn("_other", F.explode(F.expr("CASE WHEN _n = 1 THEN array(0) ELSE sequence(0, _n - 1) END")))
    # a block meets itself in each of its groups, so (i, i) is only needed where there is no other
    spread = spread.where("_n = 1 or _other <> _own")
    return spread.withColumn("block_i", F.least("_own", "_other")).withColumn("block_j", F.greatest("_own", "_other")).drop("_n", "_own", "_other")
