"""Embedding near-duplicates by dual traversal of cover trees; every pair at the threshold, none below.

Vectors are compared by chord distance of their unit vectors, a metric, in
which cosine >= c means distance <= sqrt(2 - 2c).

1. Equal vectors of a group form a class; one of them stands for it.
2. The upper levels of the tree are tables.  A cell, first a whole group, that has more
   than CELL_ROWS vectors is cut: an r-net with halving radii over PIVOT_SAMPLE of
   its vectors gives centres, and each vector goes to the nearest, which
   makes a child cell with a covering radius.  This goes on as long as a cell
   is large and its net has more than one centre.  The centres only route.
3. Every vector walks down from its group's cell to all cells that could hold
   something near: those whose centre is no farther than the threshold and
   the covering radius together.  A cell that stays large, because its vectors are
   all alike or all far from each other, is dealt out in parts, which meet each other.
4. Where two cells meet, a task builds their cover trees: nested levels with
   halving radii, each node with its covering radius.  Node pairs farther apart
   than the threshold and both radii are pruned; the rest are opened until points are
   left, whose cosine is computed in double precision.  A distance is computed
   when a node is dealt to a centre or a node pair is visited, never ahead.
5. Per vector the links are counted, and a spanning forest goes on to the
   components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkloom.llm.common import cut
from inkloom.llm.graph import components
from inkloom.llm.minhash import _groups

#: Vectors of one cell in one task.
CELL_ROWS = 2048
#: Vectors of a large cell from which its centres are taken, and centres of a cell at most.
PIVOT_SAMPLE = 1024
FANOUT = 64
#: Vectors of a cell that one task deals out to its children.
ROUTE_ROWS = 1 << 16
#: Distances that a traversal computes at once.
FRONT = 1 << 20
SLACK = 1e-9


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Chord distances of unit vectors."""
    return np.sqrt(np.maximum(0, 2 - 2 * (x @ y.T)))


class CoverTree:
    """Nodes with a centre (row), a covering radius, and children; a leaf is one row."""

    def __init__(self, unit: np.ndarray):
        n = len(unit)
        self.unit, self.measured = unit, 0
        self.centre, self.radius, self.child_from, self.child_to = [], [], [], []
        rows: list[tuple[np.ndarray, np.ndarray]] = []

        def node(centre: int, members: np.ndarray, away: np.ndarray) -> None:
            self.centre.append(centre)
            self.radius.append(float(away.max()) if len(members) > 1 else 0.0)
            self.child_from.append(0)
            self.child_to.append(0)
            rows.append((members, away))

        if n:
            self.measured += n
            node(0, np.arange(n), _apart(unit, unit[:1])[:, 0])
        at, reach = 0, 2.0
        while at < len(rows):
            stop = len(rows)
            reach /= 2
            for k in range(at, stop):
                left, away = rows[k]
                rows[k] = (left[:0], away[:0])
                if len(left) == 1:
                    continue
                self.child_from[k] = len(rows)
                if self.radius[k] <= 1e-7:  # numerically one point: no level tells them apart
                    for m in left:
                        node(int(m), np.array([m]), np.zeros(1))
                else:
                    first = int(self.centre[k])  # the centre stays a centre: levels are nested
                    while len(left):
                        near = (away <= reach) | (left == first)
                        node(first, left[near], away[near])
                        left = left[~near]
                        if len(left):
                            first = int(left[0])
                            self.measured += len(left)
                            away = _apart(unit[left], unit[first : first + 1])[:, 0]
                self.child_to[k] = len(rows)
            at = stop
        self.centre, self.radius = np.array(self.centre, dtype=np.int64), np.array(self.radius)
        self.child_from, self.child_to = np.array(self.child_from, dtype=np.int64), np.array(self.child_to, dtype=np.int64)

    def opened(self, nodes: np.ndarray) -> np.ndarray:
        """The children of nodes."""
        lo, n = self.child_from[nodes], self.child_to[nodes] - self.child_from[nodes]
        return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def near_pairs(a: np.ndarray | CoverTree, b: np.ndarray | CoverTree | None, limit: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of two sets of unit vectors within the distance, or the pairs x < y of one set.

    A node of the first tree goes down with all nodes of the second that may be
    near; whichever side has the larger radius is opened first.
    """
    one = a if isinstance(a, CoverTree) else CoverTree(a)
    two = one if b is None else b if isinstance(b, CoverTree) else CoverTree(b)
    if not len(one.centre) or not len(two.centre):
        return

    def given(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (x, y) if b is not None else (x[x < y], y[x < y])

    def close(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        one.measured += len(p) * len(q)
        return _apart(one.unit[one.centre[p]], two.unit[two.centre[q]]) <= limit + SLACK + one.radius[p][:, None] + two.radius[q]

    stack = [(0, np.zeros(1, dtype=np.int64))]
    if not close(np.zeros(1, dtype=np.int64), stack[0][1]).any():
        return
    while stack:
        p, q = stack.pop()
        own = np.array([p])
        while True:  # the second side down to radii like that of p
            inner = (two.child_to[q] > 0) & (two.radius[q] >= one.radius[p])
            if not inner.any():
                break
            deeper = two.opened(q[inner])
            q = np.concatenate([q[~inner], deeper[close(own, deeper)[0]]])
        if not len(q):
            continue
        if not one.child_to[p]:  # a leaf: radius 0, so q has only leaves left
            yield given(np.full(len(q), one.centre[p]), two.centre[q])
            continue
        kids, points = one.opened(own), two.child_to[q] == 0
        step = max(1, FRONT // len(q))
        for at in range(0, len(kids), step):
            part = kids[at : at + step]
            near = close(part, q)
            leaf = one.child_to[part] == 0
            x, y = np.nonzero(near & leaf[:, None] & points)
            if len(x):
                yield given(one.centre[part[x]], two.centre[q[y]])
            for i in np.flatnonzero((near & ~(leaf[:, None] & points)).any(axis=1)):
                stack.append((int(part[i]), q[near[i] & ~(leaf[i] & points)]))


def _net(unit: np.ndarray, most: int) -> np.ndarray:
    """Centres of the finest level of halving radii that has no more than `most`."""
    best, reach = unit[:1], 2.0
    while reach > 1e-3:
        centres: list[int] = []
        far = np.full(len(unit), np.inf)
        while (far > reach).any() and len(centres) <= most:
            i = int(np.argmax(far > reach))
            centres.append(i)
            far = np.minimum(far, np.sqrt(np.maximum(0, 2 - 2 * unit @ unit[i])))
        if len(centres) > most:
            break
        best = unit[centres]
        reach /= 2
    return best


def _spanning(n: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row with a link and the least row of its component."""
    label = np.arange(n)
    while True:
        old = label.copy()
        least = np.minimum(label[x], label[y])
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        label = label[label]
        if (label == old).all():
            break
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def _unit(column: pa.Array) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist())).reshape(len(column), -1)
    return raw / np.linalg.norm(raw, axis=1)[:, None]


_MEMBER = "cell long, rep long, copies long, vector binary"


def _with_children(rows: DataFrame, children: DataFrame, sizes: DataFrame, run, schema: str) -> DataFrame:
    """run(children, rows) where the rows of a cell meet its children: in tasks of ROUTE_ROWS rows, each with a copy of the children, of which there are FANOUT at most."""
    dealt = rows.join(sizes, "cell").select(F.lit(1).alias("kind"), "cell", F.pmod(F.xxhash64("rep", F.lit(7)), "salts").cast("int").alias("salt"), "rep", "copies", "vector", "home", F.lit(0.0).alias("radius"))
    heads = children.join(sizes, "cell").select(F.lit(0).alias("kind"), "cell", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("child").alias("rep"), F.lit(0).cast("long").alias("copies"), F.col("centre").alias("vector"), F.lit(0).cast("long").alias("home"), "radius")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, centres = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, kind = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            salt = batch.column(2).to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(cell) != 0) | (np.diff(salt) != 0) | (np.diff(kind) != 0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(lo, hi - lo)
                if kind[lo] == 0:
                    if now != (cell[lo], salt[lo]):
                        now, held = (cell[lo], salt[lo]), []
                    held.append(part)
                    centres = None
                    continue
                if centres is None:
                    known = pa.Table.from_batches(held).combine_chunks()
                    centres = known.column("rep").to_numpy(), _unit(known.column("vector").combine_chunks()), known.column("radius").to_numpy()
                for at in range(0, part.num_rows, 4096):
                    yield run(centres, part.slice(at, 4096))

    both = heads.unionByName(dealt).repartition("cell", "salt").sortWithinPartitions("cell", "salt", "kind")
    return both.mapInArrow(each, schema)


def _meetings(classes: DataFrame, limit: float) -> DataFrame:
    """(cell_group, lo, hi, side, rep, copies, vector): each vector once for each pair of cells, or parts of cells, in which it may have links."""
    placed = classes.select(F.col("cell_group").alias("cell"), "rep", "copies", "vector", F.lit(2.0).alias("away"))
    levels: list[tuple[DataFrame, DataFrame]] = []
    reach = 2.0
    while reach > limit / 4:  # a finer cell has nothing but links
        large = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("r")).where((F.col("n") > CELL_ROWS) & (F.col("r") > limit / 2))
        sizes = large.select("cell", F.ceil(F.col("n") / ROUTE_ROWS).cast("int").alias("salts"))
        by = Window.partitionBy("cell").orderBy(F.xxhash64("rep"), "rep")
        sample = placed.join(large.select("cell"), "cell", "left_semi").select("cell", "vector", F.row_number().over(by).alias("k")).where(F.col("k") <= PIVOT_SAMPLE)

        def centres(table: pa.Table) -> pa.Table:
            found = _net(_unit(table.column("vector").combine_chunks()), FANOUT)
            cell, n = table.column("cell")[0].as_py(), len(found) if len(found) > 1 else 0
            child = [xxhash.xxh3_64_intdigest(f"{cell}/{i}") - (1 << 63) for i in range(n)]
            return pa.table({"cell": pa.array([cell] * n, pa.int64()), "child": pa.array(child, pa.int64()), "centre": pa.array([x.tobytes() for x in found[:n]], pa.binary())})

        heads = cut(sample.groupBy("cell").applyInArrow(centres, "cell long, child long, centre binary"))
        if heads.isEmpty():
            break

        def nearest(known, part: pa.RecordBatch) -> pa.RecordBatch:
            child, centre, _ = known
            d = _apart(_unit(part.column("vector")), centre)
            at = d.argmin(axis=1)
            return pa.record_batch([pa.array(child[at]), *(part.column(c) for c in ("rep", "copies", "vector")), pa.array(d[np.arange(len(at)), at])], names=["cell", "rep", "copies", "vector", "away"])

        split = placed.join(heads.select("cell").distinct(), "cell", "left_semi").withColumn("home", F.lit(0).cast("long"))
        moved = _with_children(split, heads.withColumn("radius", F.lit(0.0)), sizes, nearest, f"{_MEMBER}, away double")
        placed = cut(placed.join(heads.select("cell").distinct(), "cell", "left_anti").unionByName(moved))
        radii = placed.groupBy(F.col("cell").alias("child")).agg(F.max("away").alias("radius"))
        levels.append((heads.join(radii, "child"), sizes))
        reach /= 2

    home = placed.select("rep", F.col("cell").alias("home"))
    front = classes.select(F.col("cell_group").alias("cell"), "rep", "copies", "vector").join(home, "rep")
    for children, sizes in levels:

        def near(known, part: pa.RecordBatch) -> pa.RecordBatch:
            child, centre, radius = known
            i, j = np.nonzero(_apart(_unit(part.column("vector")), centre) <= limit + radius + SLACK)
            took = pa.array(i)
            return pa.record_batch([pa.array(child[j]), *(part.column(c).take(took) for c in ("rep", "copies", "vector", "home"))], names=["cell", "rep", "copies", "vector", "home"])

        parents = children.select("cell").distinct()
        down = _with_children(front.join(parents, "cell", "left_semi"), children, front.groupBy("cell").agg(F.ceil(F.count("*") / ROUTE_ROWS).cast("int").alias("salts")), near, f"{_MEMBER}, home long")
        front = cut(front.join(parents, "cell", "left_anti").select("cell", "rep", "copies", "vector", "home").unionByName(down))
    parts = placed.groupBy("cell").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("parts"))
    front = front.join(parts.withColumnRenamed("parts", "other_parts"), "cell").join(parts.select(F.col("cell").alias("home"), "parts"), "home")
    return (
        front.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
        .withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("other_parts") - 1)))
        .withColumn("own", F.struct(F.col("home").alias("cell"), "part"))
        .withColumn("theirs", F.struct("cell", F.col("other_part").alias("part")))
        .withColumn("side", (F.col("own") > F.col("theirs")).cast("int"))
        .select(F.lit(0).cast("long").alias("cell_group"), F.xxhash64(F.least("own", "theirs")).alias("lo"), F.xxhash64(F.greatest("own", "theirs")).alias("hi"), "side", "rep", "copies", "vector")
    )


def near_duplicates(rows: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of each row; rows are compared only within equal groups.

    A row whose group or vector is null, or whose vector is zero, empty or holds
    a null or non-finite component, has no links and is kept.  Vectors of
    different lengths are not compared.  A row with a null id takes no part.
    Copies count as links of each other.  Repeated rows of an id are one vector
    if they are equal, and give a row each.  Other columns are not read.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must lie in (0, 1]")
    limit = float(np.sqrt(2 - 2 * cosine))
    kind = rows.schema[group_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, marks = [], []
            for i, v in enumerate(batch.column(2)):
                x = None
                if v.is_valid and batch.column(0)[i].is_valid and batch.column(1)[i].is_valid and len(v) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    if not np.isfinite(x).all() or not x.any():
                        x = None
                vectors.append(None if x is None else (x + 0.0).tobytes())
                marks.append(None if x is None else xxhash.xxh3_128_digest(vectors[-1]))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(vectors, pa.binary()), pa.array(marks, pa.binary())], names=["id", "grp", "vector", "mark"])

    base = rows.select(rows[id_col].cast("long").alias("id"), rows[group_col].alias("grp"), rows[vector_col].cast("array<double>").alias("v")).mapInArrow(read, f"id long, grp {kind}, vector binary, mark binary")
    base = cut(base.withColumn("cell_group", F.xxhash64("grp", F.length("vector"))))
    classes = cut(base.where("vector is not null").groupBy("cell_group", "mark").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("copies"), F.first("vector").alias("vector")))
    met = _meetings(classes, limit)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            lo, hi = group.column(1)[0].as_py(), group.column(2)[0].as_py()
            side = group.column(3).to_numpy()
            rep, copies = group.column(4).to_numpy(), group.column(5).to_numpy()
            raw = np.frombuffer(b"".join(group.column(6).to_pylist())).reshape(len(rep), -1)
            norm = np.sqrt((raw * raw).sum(axis=1))
            unit = raw / norm[:, None]
            first = np.flatnonzero(side == 0)
            second = None if lo == hi else np.flatnonzero(side == 1)
            count, xs, ys = np.zeros(len(rep), dtype=np.int64), [], []
            for x, y in near_pairs(unit[first], None if second is None else unit[second], limit):
                x, y = first[x], (first if second is None else second)[y]
                for at in range(0, len(x), FRONT // 16):
                    i, j = x[at : at + FRONT // 16], y[at : at + FRONT // 16]
                    keep = np.einsum("ij,ij->i", raw[i], raw[j]) / (norm[i] * norm[j]) >= cosine
                    i, j = i[keep], j[keep]
                    np.add.at(count, i, copies[j])
                    np.add.at(count, j, copies[i])
                    at_x, at_y = _spanning(len(rep), i, j)
                    xs.append(at_x)
                    ys.append(at_y)
            if xs:
                some = np.flatnonzero(count)
                x, y = _spanning(len(rep), np.concatenate(xs), np.concatenate(ys))
                a, b = np.concatenate([rep[some], rep[x]]), np.concatenate([count[some], rep[y]])
                yield pa.record_batch([pa.array(np.repeat([0, 1], [len(some), len(x)]).astype(np.int32)), pa.array(a), pa.array(b)], names=["kind", "a", "b"])

    keys = ["cell_group", "lo", "hi"]
    found = cut(met.select(*keys, "side", "rep", "copies", "vector").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(links, "kind int, a long, b long"))
    counted = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("linked"))
    joined = components(found.where("kind = 1")).select(F.col("id").alias("rep"), "component")
    named = classes.select("cell_group", "mark", "rep", "copies").join(counted, "rep", "left").join(joined, "rep", "left")
    out = base.select("id", "cell_group", "mark").join(named, ["cell_group", "mark"], "left")
    whole = F.coalesce("component", "rep", "id")
    return out.select(F.col("id").alias(id_col), (F.coalesce("linked", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"), whole.alias("component_id"), F.coalesce(whole == F.col("id"), F.lit(True)).alias("kept"))
