"""Near-duplicates by a signature-coordinate inverted join.

Every document has a set of word shingles and a signature of COORDINATES
min-hashes.  A pair whose similarity reaches the threshold agrees in at least
`match_threshold` coordinates, but for a chance below MISS.

1. Documents with equal sets form a class; one of them stands for it.
2. Representatives are posted under the coordinate-value pairs of the first
   POSTED coordinates.  Pairs are put in order of rising frequency, over all
   documents; by the prefix principle two documents that agree in t of them
   share one of their first POSTED - t + 1, so only those are posted: the long
   lists of common passages are skipped, and pairs that occur once, which come
   first, cost nothing.
3. Where the documents of a list meet, their other coordinates are posting lists too.
   Collisions are counted by merging those of a document, the shortest first; the
   SKIPPED longest are skipped, and only for what can still reach the match
   threshold they are looked up.  Pairs at the threshold are kept, as a
   spanning forest.  A list of many rows is cut into blocks that meet two by two.
4. Components of these candidates are groups in which the full sets decide; a
   group keeps a forest of its true links.  In a large group all documents are first
   compared with PIVOTS of them.  What is linked with one pivot, or with pivots that
   links connect, needs no comparison with its like: only with documents not linked
   with them but near enough for the triangle inequality, which Jaccard distances
   obey, to leave a link open, be they linked with other pivots or with none.  So of a
   group of copies each text travels twice, not once for each block of others.
5. Components of the true links give the answer so far.
6. Signatures leave a chance, and texts made for it can defeat fixed hashes, so an
   exact check follows: sets at the threshold share one of their first
   n - ceil(threshold * n) + 1 shingles in any common order.  Those are posted, what is
   common in a sample last.  Posts under which no documents of different components and
   fitting sizes meet are left behind; the others go on with a sketch of their document,
   a bit for each residue of its shingles that says whether an odd number has it.  Two sets
   differ in as many shingles as their sketches in bits, at least, so that documents
   which differ in more than a link allows are told apart where they meet, before there is
   a row of the pair.  The rest is compared on the full sets if the sizes, the places of what they
   share in the order, and how many of the posted ones they share allow the link.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkloom.llm.common import PUNCTUATED, SPACES, U64, ByteRule, buffers, cut, grams, mix, random_words, released, runs, word_hashes
from inkloom.llm.graph import components, in_blocks

COORDINATES = 128
POSTED = 32
MISS = 1e-10
#: Longest lists of a document that a merge passes over.
SKIPPED = 24
#: Rows of a list that one group holds, and shingles of a group of candidates.
LIST_ROWS = 4096
GROUP_ROWS = 2048
GROUP_SHINGLES = 4 << 20
#: Documents about, and share of them, from which the order of shingles is learnt, how many of these have a
#: common one, and most common ones.  Any order gives all links; a bad one makes lists longer.
ORDER_DOCS = 4096
ORDER_SHARE = 1 / 32
COMMON = 3
MOST_COMMON = 1 << 20
#: Posted shingles of a bucket of the exact check, and of one of those that documents of different components meet under.
BUCKET_POSTS = 1 << 20
BUCKET_LIVE = 1 << 18
#: Pairs that it looks at together, and bytes of sketches that it compares at once.
PAIRS = 1 << 20
SKETCH_BYTES = 16 << 20
#: Most bits of the filter that keeps texts which take no part out of a shuffle; more ids make it let more texts through.
FILTER_BITS = 1 << 26
#: Documents of a large group with which all others are compared first.
PIVOTS = 8


@cache
def match_threshold(k: int, percent: int) -> int:
    """Largest t so that fewer than t of k coordinates agree with a chance below MISS at the similarity."""
    p, tail = percent / 100, 0.0
    for t in range(k + 1):
        tail += comb(k, t) * p**t * (1 - p) ** (k - t)
        if tail > MISS:
            return max(t, 1)
    return k


def shingle_sets(column: pa.Array, rule: ByteRule, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    data, offsets = buffers(column)
    for lo, hi in runs(offsets):
        part = data[offsets[lo] : offsets[hi]]
        hashes, _, _, at = word_hashes(part, offsets[lo : hi + 1] - offsets[lo], rule)
        for i in range(hi - lo):
            yield np.unique(grams(hashes[at[i] : at[i + 1]], words))


_MULTIPLY = random_words(1001, COORDINATES) | U64(1)
_ADD = random_words(2002, COORDINATES)


def signature(shingles: np.ndarray) -> np.ndarray:
    """High 32 bits of the least hash in each coordinate."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096, None] * _MULTIPLY
        part += _ADD
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> U64(32)).astype("<u4")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))


def _common(texts: DataFrame, words: int, punctuated: bool) -> np.ndarray:
    """Sorted shingles that several documents of a sample have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = ByteRule(PUNCTUATED if punctuated else SPACES)
        for batch in batches:
            if sets := list(shingle_sets(batch.column(0), rule, words)):
                found, n = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.record_batch([pa.array(found.view(np.int64)), pa.array(n)], names=["shingle", "n"])

    share = min(1.0, max(ORDER_SHARE, ORDER_DOCS / max(texts.count(), 1)))
    sample = texts.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20))).select("text")
    counted = sample.mapInArrow(lambda batches: released(run(batches)), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") >= COMMON).orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).select("shingle").toArrow()
    return np.sort(rows.column(0).to_numpy().view(np.uint64))


def first_shingles(shingles: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a sorted set, common ones last, of which sets at the threshold share one."""
    n = len(shingles)
    most = n - -(-percent * n // 100) + 1
    late = np.zeros(n, dtype=bool)
    if len(common):
        late = common[np.minimum(np.searchsorted(common, shingles), len(common) - 1)] == shingles
    return np.concatenate([shingles[~late][:most], shingles[late]])[:most]


def sketch(shingles: np.ndarray) -> bytes:
    """A bit for each residue of the shingles by a power of two not below their number, set if an odd number has it."""
    bits = max(64, 1 << (len(shingles) - 1).bit_length())
    return np.packbits(np.bincount((shingles & U64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


class Sketches:
    """Sketches of documents, and which pairs of these they leave open."""

    def __init__(self, sketches: list[bytes | None]):
        """None: nothing is known of the document."""
        self.words = np.array([len(s) // 8 if s else 0 for s in sketches])
        self.row = np.zeros(len(sketches), dtype=np.int64)
        self.folded = np.zeros(len(sketches), dtype=np.int64)
        self.of: dict[int, np.ndarray] = {}
        widths = np.unique(self.words[self.words > 0]).tolist()
        for w in widths:  # rows of this width, and then those of twice the width in halves
            own, wide = np.flatnonzero(self.words == w), np.flatnonzero(self.words == 2 * w)
            self.row[own], self.folded[wide] = np.arange(len(own)), len(own) + np.arange(len(wide))
            halves = np.frombuffer(b"".join(sketches[i] for i in wide), dtype=np.uint64).reshape(len(wide), 2, w)
            self.of[w] = np.concatenate([np.frombuffer(b"".join(sketches[i] for i in own), dtype=np.uint64).reshape(len(own), w), halves[:, 0] ^ halves[:, 1]])

    def open(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which pairs may differ in no more than `most` shingles."""
        out = np.ones(len(x), dtype=bool)
        width = np.minimum(self.words[x], self.words[y])
        told = (width > 0) & (np.maximum(self.words[x], self.words[y]) <= 2 * width)
        for w in np.unique(width[told]).tolist():
            all_of_width = np.flatnonzero(told & (width == w))
            row = lambda of, w=w: np.where(self.words[of] == w, self.row[of], self.folded[of])
            step = max(1, SKETCH_BYTES // (8 * w))
            for lo in range(0, len(all_of_width), step):
                at = all_of_width[lo : lo + step]
                apart = np.bitwise_count(self.of[w][row(x[at])] ^ self.of[w][row(y[at])]).sum(axis=1, dtype=np.int64)
                out[at] = apart <= most[at]
        return out


def _signed(texts: DataFrame, words: int, percent: int, punctuated: bool, common: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = ByteRule(PUNCTUATED if punctuated else SPACES)
        for batch in batches:
            size, mark, sig, low, first, odd = [], [], [], [], [], []
            for s in shingle_sets(batch.column(1), rule, words):
                size.append(len(s))
                mark.append(xxhash.xxh3_128_digest(s.tobytes()))
                whole = signature(s) if len(s) else np.zeros(0, dtype="<u4")
                sig.append(whole[:POSTED].tobytes())
                low.append(whole.astype(np.uint8).tobytes())
                first.append(first_shingles(s, common, percent).tobytes() if len(s) else b"")
                odd.append(sketch(s) if len(s) else b"")
            yield pa.record_batch([batch.column(0), pa.array(size, pa.int64()), *(pa.array(c, pa.binary()) for c in (mark, sig, low, first, odd))], names=["id", "n_shingles", "mark", "sig", "low", "first", "sketch"])

    return texts.mapInArrow(lambda batches: released(run(batches)), "id long, n_shingles long, mark binary, sig binary, low binary, first binary, sketch binary")


def _holding(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of texts whose id is among ids, and a few others, found in a narrow pass behind a bitmap of hashes."""
    bits = 1 << 10
    while bits < min(8 * ids.count(), FILTER_BITS):
        bits *= 2
    place = lambda of: F.pmod(F.xxhash64(of), F.lit(bits))
    words = ids.select(place("id").alias("at")).groupBy(F.expr("at div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("mask")).toArrow()
    bitmap = np.zeros(bits // 64, dtype=np.int64)
    bitmap[words.column(0).to_numpy()] = words.column(1).to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            yield batch.select([0, 1]).filter(pa.array((bitmap[at // 64] >> (at % 64) & 1).astype(bool)))

    return texts.where("id is not null").select("id", "text", place("id").alias("at")).mapInArrow(lambda batches: released(run(batches)), "id long, text string")


def _posted(reps: DataFrame) -> DataFrame:
    """(pair, rep) for the posted coordinates of each representative."""
    place = random_words(3003, POSTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<u4").reshape(batch.num_rows, POSTED)
            pairs = (sig.astype(np.uint64) << U64(8) | np.arange(POSTED, dtype=np.uint64)) * (place[0] | U64(1))
            yield pa.record_batch([pa.array(pairs.reshape(-1).view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), POSTED))], names=["pair", "rep"])

    return reps.select("rep", "sig").mapInArrow(lambda batches: released(run(batches)), "pair long, rep long")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Groups of adjacent rows with equal first `keys` columns, of rows that come sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last is not None and last != tuple(c[0] for c in cols)
        edges = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if (i or new[0]) and held:
                yield pa.Table.from_batches(held)
                held = []
            if hi > lo:
                held.append(batch.slice(lo, hi - lo))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def forest(n: int, linked, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges of a spanning forest of 0..n-1; linked(f, others) says which of the others are linked with f.

    Each element is compared with those outside its component alone, so a group
    whose members are all alike takes one pass.  known: elements with equal
    numbers of 0 or more are connected already, and never compared.
    """
    outside, edges = np.arange(n), []
    while len(outside):
        found, outside, front = outside[:1], outside[1:], []
        while True:
            front += found.tolist()
            if known is not None and len(found):
                like = np.isin(known[outside], known[found][known[found] >= 0])
                front += outside[like].tolist()
                outside = outside[~like]
            if not front or not len(outside):
                break
            f = front.pop()
            hit = linked(f, outside)
            found = outside[hit]
            edges += [(int(f), int(v)) for v in found]
            outside = outside[~hit]
    return edges


class Collisions:
    """Posting lists of the coordinates of some documents, and merges of them that count collisions."""

    def __init__(self, sig: np.ndarray, least: int):
        """sig: a byte of each coordinate; least: the match threshold."""
        self.sig, self.least, self.skipped = sig, least, min(SKIPPED, least - 1)
        self.order = np.argsort(sig, axis=0, kind="stable")  # of each coordinate, documents by value
        values = np.take_along_axis(sig, self.order, axis=0)
        ends = np.stack([np.searchsorted(values[:, c], np.arange(257)) for c in range(sig.shape[1])])
        self.lo, self.hi = ends[:, :-1], ends[:, 1:]

    def linked(self, f: int, others: np.ndarray) -> np.ndarray:
        """Which of the others agree with f in the match threshold of coordinates or more."""
        own = self.sig[f]
        at = np.arange(len(own))
        lo, hi = self.lo[at, own], self.hi[at, own]
        by_size = np.argsort(hi - lo, kind="stable")
        merged, skipped = by_size[: len(own) - self.skipped], by_size[len(own) - self.skipped :]
        lists = [self.order[lo[c] : hi[c], c] for c in merged.tolist()]
        count = np.bincount(np.concatenate(lists), minlength=len(self.sig))[others]
        some = np.flatnonzero(count >= self.least - self.skipped)
        count[some] += np.count_nonzero(self.sig[others[some]][:, skipped] == own[skipped], axis=1)
        return count >= self.least


def _candidates(posted: DataFrame, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for group in _groups(batches, 3):
            if group.num_rows < 2:
                continue
            rep = group.column(3).to_pylist()
            sig = np.frombuffer(b"".join(group.column(4).to_pylist()), dtype=np.uint8).reshape(len(rep), COORDINATES)
            if len(rep) == 2:
                pairs = [(0, 1)] if np.count_nonzero(sig[0] == sig[1]) >= least else []
            else:
                pairs = forest(len(rep), Collisions(sig, least).linked)
            for x, y in pairs:
                a.append(rep[x])
                b.append(rep[y])
            if len(a) > 10_000:
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    keys = ["pair", "block_i", "block_j"]
    return posted.select(*keys, "rep", "low").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda batches: released(run(batches)), "a long, b long").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _verified(grouped: DataFrame, words: int, percent: int, least: int, punctuated: bool) -> DataFrame:
    def links(group: pa.Table, rule: ByteRule) -> Iterator[tuple[int, int]]:
        rep = group.column(3).to_pylist()
        known = group.column(5).to_numpy()
        sets = list(shingle_sets(group.column(4), rule, words))
        low = np.stack([signature(s) for s in sets]).astype(np.uint8) if len(sets) > 16 else None
        size = np.array([len(s) for s in sets])

        @cache
        def lists() -> tuple[np.ndarray, np.ndarray]:
            flat = np.concatenate(sets)
            order = np.argsort(flat, kind="stable")
            return flat[order], np.repeat(np.arange(len(sets)), size)[order]

        def shared(f: int) -> np.ndarray:
            """How many shingles each document of the group shares with f."""
            shingle, of = lists()
            lo, hi = np.searchsorted(shingle, sets[f]), np.searchsorted(shingle, sets[f], side="right")
            at = np.arange((hi - lo).sum()) + np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo)
            return np.bincount(of[at], minlength=len(sets))

        def linked(f: int, others: np.ndarray) -> np.ndarray:
            small, large = np.minimum(size[f], size[others]), np.maximum(size[f], size[others])
            hit = 100 * small >= percent * large
            if low is not None and hit.any():
                at = np.flatnonzero(hit)
                hit[at] = np.count_nonzero(low[others[at]] == low[f], axis=1) >= least
            at = np.flatnonzero(hit)
            if len(at) > 16:
                both = shared(f)[others[at]]
            else:
                both = np.array([len(np.intersect1d(sets[f], sets[i], assume_unique=True)) for i in others[at]], dtype=np.int64)
            hit[at] = 100 * both >= percent * (size[f] + size[others[at]] - both)
            return hit

        for x, y in forest(len(rep), linked, known):
            yield rep[x], rep[y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = ByteRule(PUNCTUATED if punctuated else SPACES)
        for group in _groups(batches, 3):
            if group.num_rows > 1 and (pairs := list(links(group, rule))):
                yield pa.record_batch([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

    keys = list(_GROUP)
    return grouped.select(*keys, "id", "text", "known").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda batches: released(run(batches)), "a long, b long")


_GROUP = ("component", "block_i", "block_j")


def _probed(large: DataFrame, words: int, percent: int, punctuated: bool) -> DataFrame:
    """(component, id, pivots, links, far): of documents of large groups, the pivots, which of them they are linked with, and their distances.

    large: component, blocks, id, text.  A task has the pivots and one block of a
    group.  All rows of a group have the same pivots in the same order; links
    are places in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = ByteRule(PUNCTUATED if punctuated else SPACES)
        for group in _groups(batches, 2):
            kind, ids = group.column(2).to_numpy(), group.column(3).to_numpy()
            sets = list(shingle_sets(group.column(4), rule, words))
            pivots = sorted(np.flatnonzero(kind == 0).tolist(), key=lambda p: (ids[p], sets[p].tobytes()))
            links, far, rest = [], [], np.flatnonzero(kind == 1)
            for i in rest.tolist():
                found, apart = [], []
                for k, p in enumerate(pivots):
                    a, b = sets[i], sets[p]
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    whole = len(a) + len(b) - both
                    apart.append(1 - both / whole)
                    if 100 * both >= percent * whole:
                        found.append(k)
                links.append(found)
                far.append(apart)
            component = group.column(0).to_numpy()
            names = ["component", "id", "pivots", "links", "far"]
            own = [ids[pivots].tolist()] * len(rest)
            yield pa.record_batch([pa.array(component[rest]), pa.array(ids[rest]), pa.array(own, pa.list_(pa.int64())), pa.array(links, pa.list_(pa.int32())), pa.array(far, pa.list_(pa.float64()))], names=names)

    first = Window.partitionBy("component").orderBy(F.xxhash64("id"), "id")
    chosen = large.select("component", "blocks", "id", F.row_number().over(first).alias("k")).where(F.col("k") <= PIVOTS).select("component", "id")
    slices = F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)
    heads = large.join(chosen, ["component", "id"], "left_semi").select("component", F.explode(slices).alias("slice"), F.lit(0).alias("kind"), "id", "text")
    rest = large.select("component", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("slice"), F.lit(1).alias("kind"), "id", "text")
    met = heads.unionByName(rest).repartition("component", "slice").sortWithinPartitions("component", "slice", "kind")
    return met.mapInArrow(lambda batches: released(run(batches)), "component long, id long, pivots array<long>, links array<int>, far array<double>")


def _clusters(probed: DataFrame) -> DataFrame:
    """(component, clusters): of each pivot the least one, by its place, with which linked documents connect it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, linked in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                of = list(range(n))
                for links in linked:
                    least = min(of[k] for k in links)
                    joined = {of[k] for k in links}
                    of = [least if c in joined else c for c in of]
                out.append(of)
            yield pa.record_batch([batch.column(0), pa.array(out, pa.list_(pa.int32()))], names=["component", "clusters"])

    linked = probed.groupBy("component").agg(F.max(F.size("pivots")).alias("n"), F.collect_set(F.when(F.size("links") > 0, F.col("links"))).alias("linked"))
    return linked.mapInArrow(run, "component long, clusters array<int>")


def _open_pairs(large: DataFrame, probed: DataFrame, percent: int) -> DataFrame:
    """Large groups in blocks so that all pairs meet whose link the pivots leave open.

    Documents linked with a pivot are connected with all that are linked with it,
    and with those of the pivots that such documents connect: a cluster.  One of a
    cluster and a document outside it, be it of another cluster or of none, can only
    be linked if that is within twice the limit of a pivot of the cluster, and if
    no pivot tells them apart by more than the limit.  Of two clusters the
    documents of the later one are held against the earlier one.  Documents of no
    cluster meet all of their like.
    """
    limit, slack = 1 - percent / 100, 1e-9
    told = large.select("component", "id", "n", "text").join(probed.select("component", "id", "links", "far"), ["component", "id"]).join(_clusters(probed), "component")
    told = told.withColumn("known", F.when(F.size("links") > 0, F.element_at("clusters", F.element_at("links", 1) + 1)).otherwise(-1))
    near = F.expr("array_min(transform(filter(sequence(1, size(far)), k -> element_at(clusters, k) = c), k -> element_at(far, k)))")
    outside = told.withColumn("c", F.explode(F.array_distinct("clusters"))).where("known = -1 or c < known").where(near <= 2 * limit + slack)
    inside = told.where("known >= 0").withColumn("c", F.col("known"))
    need = lambda of: F.greatest(F.ceil(F.count("*") / GROUP_ROWS), F.ceil(F.sum("n") / GROUP_SHINGLES)).cast("int").alias(of)
    at = lambda k: F.try_element_at("far", F.lit(k + 1))
    ranges = [f(at(k)).alias(f"{name}{k}") for k in range(PIVOTS) for name, f in (("lo", F.min), ("hi", F.max))]
    inside = inside.join(outside.groupBy("component", "c").agg(need("outer"), *ranges), ["component", "c"])
    for k in range(PIVOTS):
        inside = inside.where(F.coalesce((at(k) >= F.col(f"lo{k}") - limit - slack) & (at(k) <= F.col(f"hi{k}") + limit + slack), F.lit(True)))
    outside = outside.join(inside.groupBy("component", "c").agg(need("inner"), F.first("outer").alias("outer")), ["component", "c"])
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    inner = inside.join(outside.select("component", "c", "inner").distinct(), ["component", "c"])
    one = inner.withColumn("block_i", mine("inner")).withColumn("j", every("outer"))
    other = outside.withColumn("block_i", every("inner")).withColumn("j", mine("outer"))
    crossed = one.select("component", "block_i", "j", "c", "id", "text", "known").unionByName(other.select("component", "block_i", "j", "c", "id", "text", "known"))
    crossed = crossed.select("component", "block_i", (-1 - (F.col("j") * PIVOTS + F.col("c"))).alias("block_j"), "id", "text", "known")
    alone = told.where("known = -1")
    sizes = alone.groupBy("component").agg(need("blocks"))
    return crossed.unionByName(in_blocks(alone.join(sizes, "component"), "component", F.col("blocks"), "id").select(*_GROUP, "id", "text", "known"))


_POST = np.dtype([("shingle", "<u8"), ("rep", "<i8"), ("whole", "<i8"), ("n", "<u4"), ("place", "<u4")])


def _summed(key: np.ndarray, shared: np.ndarray, may: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """One row a key: the sum of shared, whether any may, the least of least."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[heads], np.add.reduceat(shared[order], heads), np.maximum.reduceat(may[order], heads), np.minimum.reduceat(least[order], heads)


def _places(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key with the places that have it."""
    order = np.argsort(keys, kind="stable")
    heads = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1])) if len(keys) else order
    for at in np.split(order, heads[1:]) if len(keys) else []:
        yield int(keys[at[0]]), at


def _live(posts: np.ndarray, percent: int) -> np.ndarray:
    """The posts under whose shingle documents of different components may meet; between those of a list no step in size is too large."""
    if not len(posts):
        return posts
    order = np.lexsort((posts["n"], posts["shingle"]))
    shingle, n = posts["shingle"][order], posts["n"][order].astype(np.int64)
    heads = np.flatnonzero(np.append(True, (shingle[1:] != shingle[:-1]) | (100 * n[:-1] < percent * n[1:])))
    del shingle, n
    whole = posts["whole"][order]
    mixed = np.minimum.reduceat(whole, heads) != np.maximum.reduceat(whole, heads)
    return posts[order[np.repeat(mixed, np.diff(np.append(heads, len(posts))))]]


def _joined(blobs: pa.ChunkedArray) -> np.ndarray:
    """The posts of some blobs, copied once."""
    return np.concatenate([np.zeros(0, dtype=_POST), *(np.frombuffer(b.as_buffer(), dtype=_POST) for b in blobs if b.is_valid)])


def _pairs_of_posts(posts: np.ndarray, percent: int, sketches: dict[int, bytes | None] | None = None) -> list[np.ndarray]:
    """a, b, shared, may, least of pairs of rep of different components and fitting sizes that share posted shingles.

    shared: how many; may: under one of them the places allow a link if it is the
    first they share; least: how many a link at the threshold has among all those posted.
    sketches: of each rep; pairs that they tell apart are left out.
    """
    posts = posts[np.lexsort((posts["whole"], posts["shingle"]))]
    names, rep = np.unique(posts["rep"], return_inverse=True)
    known = None if sketches is None else Sketches([sketches[r] for r in names.tolist()])
    n, place = (posts[c].astype(np.int64) for c in ("n", "place"))
    left = -(-percent * n // 100) - 1  # shingles that are not posted
    other = posts["shingle"][1:] != posts["shingle"][:-1]
    ends = lambda new: np.repeat(h := np.append(np.flatnonzero(new) + 1, len(posts)), np.diff(np.append(0, h)))
    start = ends(other | (posts["whole"][1:] != posts["whole"][:-1]))  # what an entry meets: those of later components in its list
    many = ends(other) - start
    total = np.cumsum(many)
    out, held, lo = [], 0, 0
    while lo < len(posts) and total[-1]:
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PAIRS, side="right")))
        x = np.repeat(np.arange(lo, hi), many[lo:hi])
        y = np.arange(len(x)) + np.repeat(start[lo:hi] - (total[lo:hi] - many[lo:hi] - (total[lo - 1] if lo else 0)), many[lo:hi])
        lo = hi
        fit = 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
        x, y = x[fit], y[fit]
        need = -(-percent * (n[x] + n[y]) // (100 + percent))
        if known is not None:
            near = known.open(rep[x], rep[y], n[x] + n[y] - 2 * need)
            x, y, need = x[near], y[near], need[near]
        if len(x):
            may = np.minimum(n[x] - place[x], n[y] - place[y]) >= need  # nothing before is shared
            key = np.minimum(rep[x], rep[y]) << 32 | np.maximum(rep[x], rep[y])
            out.append((key, np.ones(len(x), dtype=np.int64), may, need - np.maximum(left[x], left[y])))
            held += len(x)
            if held > PAIRS:
                out, held = [_summed(*(np.concatenate(c) for c in zip(*out, strict=True)))], 0
    if not out:
        return [names[:0], names[:0], *(np.zeros(0, dtype=t) for t in (np.int64, bool, np.int64))]
    key, shared, may, least = _summed(*(np.concatenate(c) for c in zip(*out, strict=True)))
    return [names[key >> 32], names[key & 0xFFFFFFFF], shared, may, least]


def _missed(named: DataFrame, classes: DataFrame, found: DataFrame, texts: DataFrame, words: int, percent: int, punctuated: bool) -> DataFrame:
    """(a, b): the links between documents that are not in one component of those found."""
    wholes = classes.select("mark", "rep").join(found.select(F.col("id").alias("rep"), "component"), "rep", "left").select("mark", F.col("rep").alias("id"), F.coalesce("component", "rep").alias("whole"))
    placed = named.select("mark", "id", F.col("n_shingles").alias("n"), "first").join(wholes, ["mark", "id"]).select(F.col("id").alias("rep"), "whole", "n", "first")
    many = classes.agg(F.sum(F.expr(f"n - ceil({percent} * n / 100) + 1"))).first()[0] or 0
    buckets = -(-int(many) // BUCKET_POSTS) or 1

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rep, whole, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            first = batch.column(3).to_pylist()
            many = np.array([len(f) // 8 for f in first])
            posts = np.empty(many.sum(), dtype=_POST)
            posts["shingle"] = np.frombuffer(b"".join(first), dtype="<u8")
            posts["rep"], posts["whole"], posts["n"] = np.repeat(rep, many), np.repeat(whole, many), np.repeat(n, many)
            posts["place"] = np.arange(len(posts)) - np.repeat(np.cumsum(many) - many, many)
            bucket = (posts["shingle"] % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            posts, ends = posts[order], np.cumsum(np.bincount(bucket, minlength=buckets))
            of = np.flatnonzero(np.diff(np.append(0, ends)))
            yield pa.record_batch([pa.array(of, pa.int64()), pa.array([posts[(ends[b - 1] if b else 0) : ends[b]].tobytes() for b in of], pa.binary())], names=["bucket", "posts"])

    owner = lambda ids: (mix(ids.astype(np.uint64)) % U64(buckets)).astype(np.int64)
    fields = "long, posts binary, reps array<long>, sketches array<binary>"

    def rows(name: str, keys: list[int], posts: list, reps: list, sketches: list) -> pa.RecordBatch:
        return pa.record_batch([pa.array(keys, pa.int64()), pa.array(posts, pa.binary()), pa.array(reps, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.binary()))], names=[name, "posts", "reps", "sketches"])

    def live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 1):
            posts = _live(_joined(group.column(1)), percent)
            own = owner(posts["rep"])
            parts = {k: posts[at].tobytes() for k, at in _places(own)}
            yield rows("own", list(parts), list(parts.values()), [None] * len(parts), [None] * len(parts))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, odd = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            parts = dict(_places(owner(ids)))
            yield rows("own", list(parts), [None] * len(parts), [ids[at] for at in parts.values()], [[odd[i] for i in at] for at in parts.values()])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 1):
            posts = _joined(group.column(1))
            known: dict[int, bytes | None] = {}
            for ids, odd in zip(group.column(2).to_pylist(), group.column(3).to_pylist(), strict=True):
                for k, o in zip(ids or [], odd or [], strict=True):
                    known[k] = o if known.get(k, o) == o else None  # several texts with one id have no sketch
            parts = {k: posts[at] for k, at in _places((posts["shingle"] % U64(again)).astype(np.int64))}
            reps = [np.unique(p["rep"]) for p in parts.values()]
            yield rows("bucket", list(parts), [p.tobytes() for p in parts.values()], reps, [[known[k] for k in r.tolist()] for r in reps])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 1):
            known = {k: o for ids, odd in zip(group.column(2).to_pylist(), group.column(3).to_pylist(), strict=True) for k, o in zip(ids, odd, strict=True)}
            found = _pairs_of_posts(_joined(group.column(1)), percent, known)
            for lo in range(0, len(found[0]), 1 << 16):
                yield pa.record_batch([pa.array(c[lo : lo + (1 << 16)]) for c in found], names=["a", "b", "shared", "may", "least"])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = ByteRule(PUNCTUATED if punctuated else SPACES)
        for batch in batches:
            one, other = (shingle_sets(batch.column(i), rule, words) for i in (2, 3))
            hit = []
            for x, y in zip(one, other, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                hit.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    posted = placed.mapInArrow(lambda batches: released(post(batches)), "bucket long, posts binary").repartition(4 * buckets, "bucket").sortWithinPartitions("bucket")  # so that few tasks hold several buckets
    alive = cut(posted.mapInArrow(lambda batches: released(live(batches)), f"own {fields}"), 3)
    again = -(-(alive.agg(F.sum(F.octet_length("posts"))).first()[0] or 0) // (_POST.itemsize * BUCKET_LIVE)) or 1
    odd = named.select("id", "sketch").mapInArrow(lambda batches: released(told(batches)), f"own {fields}")
    dealt = alive.unionByName(odd).repartition(buckets, "own").sortWithinPartitions("own").mapInArrow(lambda batches: released(split(batches)), f"bucket {fields}")
    met = dealt.repartition(again, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda batches: released(meet(batches)), "a long, b long, shared long, may boolean, least long").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "shared", "may", "least")
    summed = met.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.bool_or("may").alias("may"), F.min("least").alias("least"))
    pairs = cut(summed.where("may and shared >= least").select("a", "b"), 3)
    if pairs.isEmpty():
        return pairs
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    texts = _holding(texts, ends)
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(lambda batches: released(confirm(batches)), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, punctuated: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of each row.

    Words are runs of non-blank bytes with A-Z lower-cased (punctuated: ASCII
    punctuation separates them too); a row's set has its distinct `words`-word
    shingles, the whole sequence if it has fewer words.  Rows are linked where
    100 * intersection >= percent * union of the full sets.  component_id is the
    smallest id reachable, kept says that it is the row's own.

    A null or empty text, or one without words, has no shingles and no links and
    is kept.  A row with a null id takes no part: component_id is null and it is
    kept.  Repeated rows are rows of one class; rows that share an id share its
    component.  Other columns are not read; no rows give no rows.
    """
    texts = _texts(docs, id_col, text_col)
    signed = cut(_signed(texts, words, percent, punctuated, _common(texts, words, punctuated)))
    named = signed.where("n_shingles > 0 and id is not null")
    classes = cut(named.groupBy("mark").agg(F.min("id").alias("rep"), F.first("sig").alias("sig"), F.first("low").alias("low"), F.first("n_shingles").alias("n")))
    t = match_threshold(POSTED, percent)
    least = match_threshold(COORDINATES, percent)
    posted = _posted(classes)
    often = posted.groupBy("pair").count().where("count > 1")
    by_rep = Window.partitionBy("rep")
    prefix = (
        posted.join(often, "pair")
        .withColumn("rank", F.row_number().over(by_rep.orderBy("count", "pair")))
        .withColumn("repeated", F.count("*").over(by_rep))
        .where(F.col("rank") <= F.lit(POSTED - t + 1) - (F.lit(POSTED) - F.col("repeated")))
        .select("rep", "pair", "count")
    )
    lists = in_blocks(prefix.join(classes.select("rep", "low"), "rep"), "pair", F.ceil(F.col("count") / LIST_ROWS), "rep")
    candidates = components(_candidates(lists, least))
    sized = candidates.join(classes.select(F.col("rep").alias("id"), "n"), "id")
    blocks = sized.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / GROUP_ROWS), F.ceil(F.sum("n") / GROUP_SHINGLES)).alias("blocks"))
    members = cut(sized.select("id", "component", "n").join(blocks, "component"))
    held = _holding(texts, members)
    grouped = in_blocks(members.where("blocks = 1").join(held, "id"), "component", F.lit(1), "id").select(*_GROUP, "id", "text", F.lit(-1).alias("known"))
    # rows that share an id connect the classes that they are in
    several = named.groupBy("id").agg(F.min("mark").alias("one"), F.max("mark").alias("other")).where("one <> other").select("id")
    links = named.join(several, "id", "left_semi").join(classes.select("mark", "rep"), "mark").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    if not members.where("blocks > 1").isEmpty():
        large = cut(members.where("blocks > 1").join(held, "id"))
        probed = cut(_probed(large, words, percent, punctuated))
        links = links.unionByName(probed.select(F.col("id").alias("a"), F.explode(F.transform("links", lambda k: F.element_at("pivots", k + 1))).alias("b")))
        grouped = grouped.unionByName(_open_pairs(large, probed, percent))
    true = _verified(grouped, words, percent, least, punctuated)
    found = components(true.unionByName(links))
    missed = cut(_missed(named, classes, found, texts, words, percent, punctuated), 3)
    if not missed.isEmpty():
        found = components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(missed))
    named = signed.select("id", "n_shingles", "mark").join(classes.select("mark", "rep"), "mark", "left").join(found.select(F.col("id").alias("rep"), "component"), "rep", "left")
    whole = F.when(F.col("id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component", "rep", "id"))
    return named.select(F.col("id").alias(id_col), "n_shingles", whole.alias("component_id"), F.coalesce(whole == F.col("id"), F.lit(True)).alias("kept"))
