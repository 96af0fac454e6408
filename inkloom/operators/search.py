"""Top-k vectors, trigram similarity and containment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkloom.functions.text import trigram_similarity

#: Bytes of query vectors that may be broadcast; more go in blocks.
QUERY_BYTES = 8 << 20
#: Scores that are in memory at once.
TILE = 1 << 21
#: Vectors of a group that meets another in one task, and the least number of groups.
BLOCK_ROWS, LEAST_GROUPS = 4096, 8


def knn(queries: DataFrame, vectors: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding", exclude_self: bool = True, most: int = QUERY_BYTES) -> DataFrame:
    """(query_id, id, cosine, rank): exact top k by cosine, of equals the least id.

    The queries are a stated set.  They are taken in blocks of proven size; a task
    multiplies its vectors with a block and keeps its own best k of each query, so
    only k rows a query and task are shuffled.  The driver holds one block: the hits
    of a block that others follow are checkpointed before the next is fetched.
    Null or zero vectors take no part.
    """
    out, best = None, Window.partitionBy("query_id").orderBy(F.desc("cosine"), id_col)
    ids, vs = [], []

    def hits() -> DataFrame:
        found = _block(vectors, ids, vs, k, id_col, vector, exclude_self)
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    for row in queries.select(id_col, vector).where(F.col(vector).isNotNull()).toLocalIterator():
        if ids and len(ids) * len(vs[0]) * 8 >= most:
            part = hits().checkpoint(eager=True)
            out = part if out is None else out.unionByName(part)
            ids, vs = [], []
        ids.append(row[0])
        vs.append(row[1])
    return hits() if out is None else out.unionByName(hits())


def _block(vectors: DataFrame, ids: list, vs: list, k: int, id_col: str, vector: str, exclude_self: bool) -> DataFrame:
    kind = vectors.schema[id_col].dataType.simpleString()
    q = np.asarray(vs, dtype=np.float64).reshape(len(ids), -1)
    length = np.linalg.norm(q, axis=1) if len(ids) else np.zeros(0)
    keep = length > 0
    q, names = q[keep] / length[keep, None], [i for i, ok in zip(ids, keep, strict=True) if ok]

    def run(batches):
        best, who = np.full((len(names), k), -np.inf), np.empty((len(names), k), dtype=object)
        for pdf in batches:
            pdf = pdf[pdf["v"].map(lambda x: x is not None)]
            if not len(pdf) or not names:
                continue
            m = np.stack(pdf["v"].to_numpy()).astype(np.float64)
            n = np.linalg.norm(m, axis=1)
            own = pdf["id"].to_numpy(dtype=object)[n > 0]
            m = m[n > 0] / n[n > 0, None]
            step = max(1, TILE // max(len(own), 1))
            for lo in range(0, len(names), step):
                hi = min(lo + step, len(names))
                score = q[lo:hi] @ m.T
                if exclude_self:
                    score[np.asarray(names[lo:hi], dtype=object)[:, None] == own[None, :]] = -np.inf
                both = np.concatenate([best[lo:hi], score], axis=1)
                last = -np.partition(-both, k - 1, axis=1)[:, k - 1]
                for i in np.flatnonzero((score >= last[:, None]).any(axis=1) & np.isfinite(score).any(axis=1)):
                    at = np.flatnonzero((both[i] >= last[i]) & np.isfinite(both[i]))  # all that tie with the k-th, so that ids decide
                    ids_ = [who[lo + i, j] if j < k else own[j - k] for j in at]
                    top = sorted(zip(-both[i, at], ids_, strict=True))[:k]
                    best[lo + i, : len(top)], who[lo + i, : len(top)] = [-x for x, _ in top], [x for _, x in top]
        rows, ranks = np.nonzero(np.isfinite(best))
        if len(rows):
            yield pd.DataFrame({"query_id": [names[i] for i in rows], id_col: list(who[rows, ranks]), "cosine": best[rows, ranks]})

    return vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("v")).mapInPandas(run, f"query_id {kind}, `{id_col}` {kind}, cosine double")


def label_vote(found: DataFrame, labels: DataFrame, id_col: str = "vec_id", label: str = "label") -> DataFrame:
    """(query_id, label, votes): the commonest label among the hits, of equals the least."""
    votes = found.join(labels.select(id_col, label), id_col).groupBy("query_id", label).agg(F.count("*").alias("votes"))
    return votes.withColumn("_k", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("votes"), label))).where("_k = 1").drop("_k")


def similar_titles(rows: DataFrame, column: str, query: str, least: float = 0.3) -> DataFrame:
    """Rows whose trigrams are at least `least` similar to the query's."""
    return rows.withColumn("similarity", trigram_similarity(F.col(column), F.lit(query))).where(F.col("similarity") >= least)


def similar_pairs(vectors: DataFrame, limit: float, id_col: str = "vec_id", vector: str = "embedding", block: int = BLOCK_ROWS) -> DataFrame:
    """(a, b, cosine) of all pairs a < b at the limit; exact.

    Rows are dealt by their ids into groups of about `block`, and every two groups
    meet in one task, so no task holds more than two of them and the scores of one
    tile.  Null, zero or non-finite vectors take no part.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("v")).where("id is not null and v is not null").distinct()
    groups = max(LEAST_GROUPS, -(-rows.count() // block))
    dealt = rows.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    ahead = dealt.select(F.col("g").alias("x"), F.explode(F.sequence("g", F.lit(groups - 1))).alias("y"), F.lit(True).alias("ahead"), "id", "v")
    behind = dealt.where("g > 0").select(F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("x"), F.col("g").alias("y"), F.lit(False).alias("ahead"), "id", "v")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches))
        m = np.stack(pdf["v"].to_numpy()).astype(np.float64)
        n = np.linalg.norm(m, axis=1)
        ok = np.isfinite(n) & (n > 0)
        m, n, own, first = m[ok], n[ok], pdf["id"].to_numpy()[ok], pdf["ahead"].to_numpy(dtype=bool)[ok]
        same = pdf["x"].iloc[0] == pdf["y"].iloc[0]
        one, other = np.flatnonzero(first), np.arange(len(own)) if same else np.flatnonzero(~first)
        step = max(1, TILE // max(len(other), 1))
        for lo in range(0, len(one), step):
            at = one[lo : lo + step]
            i, j = np.nonzero((score := m[at] @ m[other].T / (n[at, None] * n[other])) >= limit)
            a, b, c = own[at[i]], own[other[j]], score[i, j]
            if not len(a):
                continue
            if same:  # each pair is met twice
                keep = a < b
                a, b, c = a[keep], b[keep], c[keep]
            else:
                turn = b < a
                keep = turn | (a < b)
                a, b, c = np.where(turn, b, a)[keep], np.where(turn, a, b)[keep], c[keep]
            yield pd.DataFrame({"a": a, "b": b, "cosine": c})

    return ahead.unionByName(behind).groupBy("x", "y").applyInPandas(run, f"a {kind}, b {kind}, cosine double").distinct()


def holds_any(column: Column, values: list) -> Column:
    return F.arrays_overlap(column, F.array(*map(F.lit, values)))


def holds_all(column: Column, values: list) -> Column:
    return F.size(F.array_except(F.array(*map(F.lit, values)), column)) == 0
