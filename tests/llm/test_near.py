import random
import re

import duckdb
import numpy as np
import pytest

from inkloom.llm import cover_tree, graph, minhash, queries


def groups(n, linked):
    label = list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return [root(i) for i in range(n)]


def brute_sets(text, words):
    w = re.findall(r"[^ \t\n\x0b\x0c\r]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return set() if not w else {tuple(w)} if len(w) < words else {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}


def brute_near(rows, words, percent):
    named = {}
    for i, t in rows:
        named.setdefault(i, []).append(brute_sets(t, words))
    ids = sorted(i for i in named if i is not None)
    like = lambda x, y: x and y and 100 * len(x & y) >= percent * len(x | y)
    root = groups(len(ids), lambda a, b: any(like(x, y) for x in named[ids[a]] for y in named[ids[b]]))
    first = {i: ids[r] for i, r in zip(ids, root, strict=True)}
    return sorted(str((i, len(brute_sets(t, words)), first.get(i), i is None or first[i] == i)) for i, t in rows)


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
@pytest.mark.parametrize("small", [False, True])
def test_minhash_against_brute_force(spark, odd_docs, monkeypatch, words, percent, small):
    if small:  # lists and groups in blocks
        monkeypatch.setattr(minhash, "LIST_ROWS", 3)
        monkeypatch.setattr(minhash, "GROUP_ROWS", 4)
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    found = sorted(str(tuple(r)) for r in minhash.near_duplicates(odd_docs, words, percent).collect())
    assert found == brute_near(rows, words, percent)


def test_collisions_by_brute_force():
    """Merges that skip the longest lists count what comparing all coordinates counts."""
    rng = np.random.default_rng(4)
    for n, least in ((3, 40), (40, 83), (200, 60), (50, 1)):
        sig = rng.integers(0, 256, (n, minhash.COORDINATES)).astype(np.uint8)
        for i in range(1, n):  # rows that share much with the one before, and coordinates that all share
            keep = rng.random(minhash.COORDINATES) < rng.choice([0.2, 0.5, 0.7, 1.0])
            sig[i, keep] = sig[i - 1, keep]
        sig[:, :30] = 7
        lists = minhash.Collisions(sig, least)
        for f in range(n):
            others = np.flatnonzero(rng.random(n) < 0.7)
            assert (lists.linked(f, others) == (np.count_nonzero(sig[others] == sig[f], axis=1) >= least)).all()


def test_large_groups_of_copies_travel_twice(spark, monkeypatch):
    """A group of near copies and chains around it: the links of brute force, without blocks that meet two by two."""
    monkeypatch.setattr(minhash, "GROUP_ROWS", 20)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        t = list(base)
        for _ in range(rng.choice([0, 1, 1, 2]) if i < 270 else 6):
            t[rng.randrange(120)] = f"x{rng.random()}"
        rows.append((i, " ".join(t)))
    rows += [(400 + i, " ".join([*base[:100], *(f"y{i}z{k}" for k in range(4 * i))])) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = []
    verified = minhash._verified
    monkeypatch.setattr(minhash, "_verified", lambda grouped, *a: held.append(grouped.groupBy("id").count().agg({"count": "avg"}).first()[0]) or verified(grouped, *a))
    found = sorted(str(tuple(r)) for r in minhash.near_duplicates(docs, 3, 85).collect())
    assert found == brute_near(rows, 3, 85)
    assert held[0] < 4  # 312 documents in blocks of 20 would send each to 15 others


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_links_between_documents_of_different_pivots(spark, monkeypatch, words, percent):
    """Sliding windows over long texts: links between what only different pivots are linked with hold the chains together."""
    monkeypatch.setattr(minhash, "GROUP_ROWS", 20)
    rows = [(100 * k + i, " ".join(f"t{k}w{j}" for j in range(step * i, step * i + 100))) for k, step in enumerate((2, 3, 4, 6, 8)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(str(tuple(r)) for r in minhash.near_duplicates(docs, words, percent).collect())
    assert found == brute_near(rows, words, percent)


def text_beside_signatures(rng, base, words, percent):
    """base with words after it whose shingles are the least of as many coordinates as can be found, and still linked."""
    rule = minhash.ByteRule(minhash.SPACES)
    sets = lambda texts: list(minhash.shingle_sets(minhash.pa.array(texts), rule, words))
    own = minhash.signature(sets([" ".join(base)])[0])
    text = list(base)
    for _ in range(100 * (len(base) - words + 1) // percent - (len(base) - words + 1)):
        tried = [f"x{rng.random()}" for _ in range(400)]
        tail = text[-words + 1 :]
        sig = [minhash.signature(s) for s in sets([" ".join([*tail, w]) for w in tried])]
        text.append(tried[int(np.argmax([(s < own).sum() for s in sig]))])
        own = np.minimum(own, sig[int(np.argmax([(s < own).sum() for s in sig]))])
    return " ".join(text)


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_links_that_no_signature_shows(spark, words, percent):
    """Texts made so that the signatures of near ones disagree, and copies that only a shared id connects."""
    rng = random.Random(3)
    rows = []
    for k in range(3):
        base = [f"w{rng.random()}" for _ in range(150)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, text_beside_signatures(rng, base, words, percent))]
    rows += [(50, "a b c d e f"), (60, "a b c d e f"), (60, "g h i j k l"), (70, "g h i j k l"), (70, "m n o p q r"), (65, "m n o p q r")]
    sig = [minhash.signature(next(minhash.shingle_sets(minhash.pa.array([t]), minhash.ByteRule(minhash.SPACES), words))) for _, t in rows[:2]]
    assert (sig[0] == sig[1]).sum() < minhash.match_threshold(minhash.COORDINATES, percent)
    found = sorted(str(tuple(r)) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words, percent).collect())
    want = brute_near(rows, words, percent)
    assert found == want and sum("True" in r for r in want) == 4


def test_exact_check_alone_finds_all_links(spark, odd_docs, monkeypatch):
    """Without any candidates of signatures, over several buckets and an order of its own."""
    monkeypatch.setattr(minhash, "match_threshold", lambda k, percent: k)
    monkeypatch.setattr(minhash, "BUCKET_POSTS", 50)
    monkeypatch.setattr(minhash, "MOST_COMMON", 40)
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    found = sorted(str(tuple(r)) for r in minhash.near_duplicates(odd_docs, 3, 85).collect())
    assert found == brute_near(rows, 3, 85)


def test_posted_pairs_by_brute_force():
    """Every pair at the threshold is among the posted pairs, in any order of shingles."""
    rng = np.random.default_rng(2)
    for percent in (50, 80, 85, 100):
        sets = [np.unique(rng.integers(0, 1 << 60, rng.integers(1, 60), dtype=np.uint64))]
        for _ in range(150):
            s = sets[rng.integers(len(sets))]
            sets.append(np.unique(np.concatenate([s[rng.random(len(s)) > rng.choice([0, 0.05, 0.1, 0.3])], rng.integers(0, 1 << 60, rng.integers(1, 6), dtype=np.uint64)])))
        common = np.unique(rng.choice(np.concatenate(sets), 40))
        first = [minhash.first_shingles(s, common, percent) for s in sets]
        posts = np.array([(x, i, i, len(sets[i]), k) for i, f in enumerate(first) for k, x in enumerate(f.tolist())], dtype=minhash._POST)
        a, b, shared, may, least = minhash._pairs_of_posts(posts, percent)
        found = {frozenset(p) for p in zip(a[may & (shared >= least)].tolist(), b[may & (shared >= least)].tolist(), strict=True)}
        both = lambda i, j: len(np.intersect1d(sets[i], sets[j]))
        near = {frozenset((i, j)) for i in range(len(sets)) for j in range(i) if 100 * both(i, j) >= percent * (len(sets[i]) + len(sets[j]) - both(i, j))}
        assert near <= found and (near or percent == 100)


def test_sketches_leave_every_link_open():
    """Sets differ in no fewer shingles than sketches in bits, at equal and at twice the width; most others are told apart."""
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 5, 60, 64, 65, 70, 300, 520)]
    for _ in range(200):
        s = sets[rng.integers(len(sets))]
        sets.append(np.unique(np.concatenate([s[rng.random(len(s)) > rng.choice([0, 0.05, 0.2, 0.5])], rng.integers(0, 1 << 63, rng.integers(1, 9), dtype=np.uint64)])))
    x, y = (c.reshape(-1) for c in np.indices((len(sets), len(sets))))
    apart = np.array([len(np.setxor1d(sets[i], sets[j])) for i, j in zip(x, y, strict=True)])
    known = minhash.Sketches([minhash.sketch(s) for s in sets])
    assert known.open(x, y, apart).all()
    size = np.array([len(s) for s in sets])
    fit = (np.minimum(size[x], size[y]) > 50) & (np.maximum(size[x], size[y]) <= 1.2 * np.minimum(size[x], size[y])) & (apart > 0.5 * size[x])
    assert fit.sum() > 1000 and known.open(x, y, 0.16 * size[x])[fit].mean() < 0.01
    assert minhash.Sketches([minhash.sketch(sets[3]), None]).open(np.array([0]), np.array([1]), np.array([0])).all()


def test_rows_of_pairs_only_where_sketches_leave_a_link_open():
    """Many texts of one passage that are no links give no rows of pairs, but their links do; posts that none can meet under stay behind."""
    rng = np.random.default_rng(5)
    words = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    passage = words(150)
    sets = [np.unique(np.concatenate([passage, words(60)])) for _ in range(200)]
    sets += [np.unique(np.append(s[3:], words(2))) for s in sets[:5]]
    first = [minhash.first_shingles(s, np.zeros(0, dtype=np.uint64), 85) for s in sets]
    posts = np.array([(x, i, i, len(sets[i]), k) for i, f in enumerate(first) for k, x in enumerate(f.tolist())], dtype=minhash._POST)
    live = minhash._live(posts, 85)
    assert 0 < len(live) < len(posts) and not len(minhash._live(np.unique(posts[posts["rep"] < 1]), 85))
    met = lambda p, *more: {frozenset(q) for q in zip(*(c.tolist() for c in minhash._pairs_of_posts(p, 85, *more)[:2]), strict=True)}
    assert met(live) == met(posts)
    few = met(live, {i: minhash.sketch(s) for i, s in enumerate(sets)})
    assert {frozenset((i, 200 + i)) for i in range(5)} <= few and len(few) < 10 and len(met(posts)) > 10_000


def test_texts_that_take_no_part_are_left_out(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(-500, 1500)] + [(3, "again"), (None, "none")], "id long, text string")
    ids = spark.createDataFrame([(i,) for i in range(-40, 40, 4)] + [(3,)], "id long")
    found = [tuple(r) for r in minhash._holding(docs, ids).collect()]
    assert {(i, f"text {i}") for i in range(-40, 40, 4)} | {(3, "again"), (3, "text 3")} <= set(found) and len(found) < 200
    assert not minhash._holding(docs, ids.limit(0)).collect()
    monkeypatch.setattr(minhash, "FILTER_BITS", 64)
    assert {r["id"] for r in ids.collect()} <= {r["id"] for r in minhash._holding(docs, ids).collect()}


def test_forest_of_known_classes():
    """Classes known to be connected are not compared, and all other links are found."""
    rng = np.random.default_rng(8)
    for n in (1, 2, 30, 60):
        near = rng.random((n, n)) < 1 / n
        near |= near.T
        known = rng.integers(-1, 5, n) if n > 2 else np.full(n, -1)

        def linked(f, others, near=near, known=known):
            assert known[f] < 0 or not (known[others] == known[f]).any()
            return near[f, others]

        joined = groups(n, lambda a, b: near[a, b] or 0 <= known[a] == known[b])
        edges = {frozenset(e) for e in minhash.forest(n, linked, known)}
        assert groups(n, lambda a, b: frozenset((a, b)) in edges or 0 <= known[a] == known[b]) == joined


def test_minhash_without_rows(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0


def test_match_threshold_misses_nothing():
    from math import comb

    for k, percent in ((32, 85), (64, 80)):
        t = minhash.match_threshold(k, percent)
        p = percent / 100
        assert sum(comb(k, j) * p**j * (1 - p) ** (k - j) for j in range(t)) <= minhash.MISS


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(100 + i, 101 + i) for i in range(40)]
    ids = sorted({x for e in edges for x in e if e[0] != e[1]})
    linked = {frozenset(e) for e in edges}
    root = groups(len(ids), lambda a, b: frozenset((ids[a], ids[b])) in linked)
    found = dict(graph.components(spark.createDataFrame([*edges, (None, 1)], "a long, b long")).collect())
    assert found == {i: ids[r] for i, r in zip(ids, root, strict=True)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_vectors(rows, least):
    good = [r for r in rows if r[0] is not None and r[1] is not None and r[2] and all(x is not None and np.isfinite(x) for x in r[2]) and any(r[2])]
    near = lambda a, b: a[1] == b[1] and len(a[2]) == len(b[2]) and np.dot(a[2], b[2]) / np.sqrt(np.dot(a[2], a[2])) / np.sqrt(np.dot(b[2], b[2])) >= least
    root = groups(len(good), lambda a, b: near(good[a], good[b]))
    first = {}
    for r, k in zip(good, root, strict=True):
        first[r[0]] = min(x[0] for x, j in zip(good, root, strict=True) if j == k)
    out = []
    for r in rows:
        n = int(sum(near(r, x) for x in good if x[0] != r[0])) if any(r is x for x in good) else 0
        whole = first.get(r[0], r[0])
        out.append(str((r[0], n, whole, r[0] is None or whole == r[0])))
    return sorted(out)


@pytest.mark.parametrize("cell", [2048, 8])
def test_cover_tree_against_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(cover_tree, "CELL_ROWS", cell)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(150):
        v = centres[rng.integers(6)] + rng.normal(size=8) * rng.choice([0.0, 0.1, 0.25, 0.6])
        rows.append((i, int(rng.integers(0, 3)) if rng.random() < 0.7 else 0, [float(np.float32(x)) for x in v]))
    rows += [(200, 0, None), (201, None, [1.0] * 8), (202, 0, [0.0] * 8), (203, 0, [float("nan")] * 8), (204, 0, [1.0, None]), (205, 0, []), (206, 0, [1.0, 2.0]), (207, 0, [2.0, 4.0]), (None, 0, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, label int, embedding array<float>, rep int, cell int, kind int")
    found = sorted(str(tuple(r)) for r in cover_tree.near_duplicates(df, 0.93).collect())
    assert found == brute_vectors(rows, 0.93)


def clustered(n, dims, clusters, noise, seed=7):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(clusters, dims))[rng.integers(0, clusters, n)] + rng.normal(size=(n, dims)) * noise


def expected(vectors, labels, least):
    """n_links and component of each row, from the full matrix."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (unit @ unit.T >= least) & (labels[:, None] == labels)
    np.fill_diagonal(near, False)
    component = np.arange(len(vectors))
    while True:
        lowest = np.minimum(component, np.where(near, component, len(vectors)).min(axis=1))
        if (lowest == component).all():
            return near.sum(axis=1), component
        component = lowest


@pytest.mark.parametrize(("dims", "clusters", "noise"), [(3, 300, 0.02), (8, 60, 0.15), (32, 2, 1.0)])
def test_cover_tree_of_many_cells(spark, monkeypatch, dims, clusters, noise):
    """Thousands of rows with many links, in cells of several levels, hot cells, and cells that no net can cut."""
    monkeypatch.setattr(cover_tree, "CELL_ROWS", 150)
    monkeypatch.setattr(cover_tree, "PIVOT_SAMPLE", 200)
    monkeypatch.setattr(cover_tree, "ROUTE_ROWS", 400)
    vectors = clustered(3000, dims, clusters, noise)
    labels = np.where(np.arange(3000) % 10 < 8, 0, np.arange(3000) % 3)
    df = spark.createDataFrame([(i, int(g), v.tolist()) for i, (g, v) in enumerate(zip(labels, vectors, strict=True))], "vec_id long, label int, embedding array<double>")
    n, component = expected(vectors, labels, 0.93)
    found = sorted(tuple(r) for r in cover_tree.near_duplicates(df, 0.93).collect())
    assert found == [(i, int(n[i]), int(component[i]), i == component[i]) for i in range(3000)]
    assert dims == 32 or n.sum() > 3000


def test_cover_tree_against_its_sql(spark, tmp_path):
    """The registered query and its SQL on a table with links, null and odd vectors."""
    vectors = clustered(1500, 16, 200, 0.12)
    rows = [(i, i % 4, v.tolist()) for i, v in enumerate(vectors)] + [(2000, 1, None), (2001, None, [1.0] * 16), (2002, 1, [0.0] * 16), (2003, 1, [float("nan")] * 16), (2004, 1, [1.0, None])]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = duck.execute(f"select vec_id, n_links, component_id, kept from ({queries.ORACLES['op8_cover_tree']})").fetchall()
    found = [tuple(r) for r in queries.op8_cover_tree(spark, str(tmp_path)).collect()]
    assert sorted(found) == sorted(want) and sum(r[1] for r in found) > 1000


def test_distances_are_computed_when_visited():
    """Far fewer than all pairs where there are clusters, both to build the trees and to meet."""
    x = clustered(2000, 6, 100, 0.01)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    one, two = cover_tree.CoverTree(x[:1000]), cover_tree.CoverTree(x[1000:])
    built = one.measured + two.measured
    found = {(int(a), int(b)) for p, q in cover_tree.near_pairs(one, two, 0.05) for a, b in zip(p, q, strict=True)}
    d = cover_tree._apart(x[:1000], x[1000:])
    assert {(int(a), int(b)) for a, b in np.argwhere(d <= 0.05)} <= found and len(found) <= (d <= 0.06).sum()
    met = one.measured + two.measured - built
    assert built < 2 * 1000 * 1000 // 10 and met < 1000 * 1000 // 5


def test_cover_tree_without_rows(spark):
    assert cover_tree.near_duplicates(spark.createDataFrame([], "vec_id long, label int, embedding array<float>")).count() == 0


def test_traversal_prunes():
    rng = np.random.default_rng(1)
    x = np.concatenate([c + 0.01 * rng.normal(size=(50, 3)) for c in np.eye(3)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pairs = {(int(a), int(b)) for p, q in cover_tree.near_pairs(x, None, 0.02) for a, b in zip(p, q, strict=True)}
    d = np.sqrt(np.maximum(0, 2 - 2 * x @ x.T))
    assert pairs >= {(a, b) for a in range(150) for b in range(a + 1, 150) if d[a, b] <= 0.02} and len(pairs) < 4000
