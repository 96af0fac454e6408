"""URL filter: a trie over reversed host labels and path segments.

A rule is a host and the start of a path.  The trie's first levels are host
labels from the last to the first; each node of a host holds a trie of path
segments, whose nodes hold the rules that end there with the start of a further
segment (empty if the rule ends in a slash).  A look-up walks every host suffix
and path start once and keeps the longest rule.  The trie is broadcast in the
task closure; `MOST_RULE_BYTES` is the proven bound of its size.  A larger rule set
stays a table: every rule lies at its node, a pair of host and whole segments, and
is joined with the nodes that the distinct urls walk.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rule texts that one broadcast may hold.
MOST_RULE_BYTES = 64 << 20


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host: after the first '://' up to / ? # or the end, A-Z lower-cased.  Path: then up to ? or # or the end."""
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    cut = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    rest = rest[:cut]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(_LOWER), path


_LOWER = {i: i + 32 for i in range(65, 91)}


class UrlTrie:
    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        """rules: (verdict, host, path start).  Of equal rules the last one counts."""
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.translate(_LOWER).split(".")) if host else ():
                node = node.setdefault(label, {})
            *whole, rest = path.split("/")
            place = node.setdefault("", {})  # no host label is empty within a rule
            for segment in whole:
                place = place.setdefault("/", {}).setdefault(segment, {})
            place.setdefault("*", {})[rest] = (len(host) + len(path), len(host), f"{host}{path}", verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits; on equal length the one with the longer host."""
        best = None
        node, labels = self.root, reversed(host.split("."))
        segments = path.split("/")
        while True:
            place, i = node.get(""), 0
            while place is not None:
                for rest, rule in place.get("*", {}).items():
                    if (best is None or rule[:2] > best[:2]) and segments[i].startswith(rest):
                        best = rule
                if i >= len(segments) - 1:
                    break
                place = place.get("/", {}).get(segments[i])
                i += 1
            label = next(labels, None)
            if not label or label not in node:
                return best and (best[2], best[3])
            node = node[label]


def judge(pages: DataFrame, rules: DataFrame | list[tuple[str, str, str]], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of each row.

    rules: (verdict, host, path start), a list or a table with these columns, of
    which nulls count as empty.  Up to MOST_RULE_BYTES they make a trie and one narrow pass;
    beyond, the same walk is a join.  Of rules with equal host and path the last of a list
    counts, of a table the greatest verdict.
    A null url or one without '://' has empty host and path; where no rule
    fits, rule is null and the verdict is `default`.  Repeated rows and null
    ids give a row each; other columns are not read; no rows give no rows.
    """
    spark = pages.sparkSession
    if isinstance(rules, DataFrame):
        rules = rules.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("verdict", "host", "path")])
        size = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 16)).first()[0] or 0
        if size > MOST_RULE_BYTES:
            return _judged_by_join(pages, rules, default, id_col, url_col)
        rules = sorted(map(tuple, rules.collect()))
    elif sum(len(h.encode()) + len(p.encode()) + 16 for _, h, p in rules) > MOST_RULE_BYTES:
        last = {(h.translate(_LOWER), p): (v, h, p) for v, h, p in rules}
        return _judged_by_join(pages, spark.createDataFrame(list(last.values()), "verdict string, host string, path string"), default, id_col, url_col)
    trie = UrlTrie(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = batch.column(1).dictionary_encode()  # a url is judged once a batch
            parts = [host_and_path(u) for u in urls.dictionary.to_pylist()]
            found = [trie.find(*p) for p in parts]
            missing = trie.find("", "")
            parts.append(("", ""))
            found.append(missing)
            at = urls.indices.fill_null(len(parts) - 1)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([p[0] for p in parts], pa.string()).take(at),
                    pa.array([p[1] for p in parts], pa.string()).take(at),
                    pa.array([f and f[0] for f in found], pa.string()).take(at),
                    pa.array([f[1] if f else default for f in found], pa.string()).take(at),
                ],
                names=[id_col, "host", "path", "rule", "verdict"],
            )

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(pages[id_col], pages[url_col].cast("string").alias("url")).mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")


def _lowered(host: Column) -> Column:
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _judged_by_join(pages: DataFrame, rules: DataFrame, default: str, id_col: str, url_col: str) -> DataFrame:
    """The same rows from rules of any number: nodes of distinct urls meet those of the rules; hot nodes are left to the skew join."""
    url = F.coalesce(pages[url_col].cast("string"), F.lit(""))
    rest = F.when(F.instr(F.col("_u"), "://") > 0, F.regexp_extract(F.expr("substr(_u, instr(_u, '://') + 3)"), "^[^?#]*", 0)).otherwise("")
    host = F.substring_index("_r", "/", 1)
    parts = pages.select(pages[id_col].alias("_id"), url.alias("_u")).withColumn("_r", rest).select("_id", _lowered(host).alias("host"), F.expr("substr(_r, length(substring_index(_r, '/', 1)) + 1)").alias("path"))
    urls = parts.select("host", "path").distinct()
    labels, segments = F.split("host", r"\.", -1), F.split("path", "/", -1)
    # an empty label ends the walk from the right, as it does in the trie
    open_labels = F.expr("CASE WHEN size(filter(_l, x -> x = '')) = 0 THEN size(_l) ELSE array_position(reverse(_l), '') - 1 END")
    walked = urls.withColumn("_l", labels).withColumn("_s", segments).withColumn("_n", open_labels.cast("int"))
    walked = walked.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n"))))
    walked = walked.withColumn("node", F.expr("array_join(slice(_l, size(_l) - _k + 1, _k), '.')")).withColumn("_d", F.explode(F.sequence(F.lit(0), F.size("_s") - 1)))
    walked = walked.select("host", "path", "node", F.expr("array_join(slice(_s, 1, _d), '/')").alias("whole"), F.col("_d").alias("depth"), F.expr("_s[_d]").alias("next"))
    rule = rules.groupBy(_lowered(F.col("host")).alias("node"), F.col("path").alias("rule_path")).agg(F.max(F.struct("verdict", "host")).alias("r")).select("*", "r.verdict", F.col("r.host").alias("spelled"))
    rule = rule.withColumn("depth", F.size(F.split("rule_path", "/", -1)) - 1).withColumn("whole", F.expr("array_join(slice(split(rule_path, '/', -1), 1, depth), '/')"))
    rule = rule.withColumn("rest", F.expr("element_at(split(rule_path, '/', -1), -1)"))
    hits = walked.join(rule, ["node", "whole", "depth"]).where(F.expr("startswith(next, rest)"))
    name = F.concat("spelled", "rule_path")
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length(name).alias("n"), F.length("node").alias("h"), name.alias("rule"), F.col("verdict").alias("v"))).alias("best"))
    return parts.join(best, ["host", "path"], "left").select(F.col("_id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.v", F.lit(default)).alias("verdict"))
