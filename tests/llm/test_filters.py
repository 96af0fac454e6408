import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkloom.llm import decontaminate, licences, quality, url_filter


def brute_rule(rules, host, path):
    fits = [(len(h) + len(p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else None


def test_urls_against_brute_force():
    rng = random.Random(1)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net", "com.net"]
    paths = ["", "/", "/en", "/en/", "/en/us", "/english", "/en/us/x.html"]
    for _ in range(300):
        rules = list({(h, p): (rng.choice(["allow", "block"]), h, p) for h, p in ((rng.choice(hosts), rng.choice(paths)) for _ in range(8))}.values())
        trie = url_filter.UrlTrie(rules)
        for host in [*hosts, "y.b.a.com", "acom", "", "com."]:
            for path in paths:
                assert trie.find(host, path) == brute_rule(rules, host, path), (rules, host, path)


def test_url_parts_and_odd_rows(spark):
    urls = ["http://A.Example.com/En/x?y#z", "https://x.net?q=/a", "no scheme", None, "", "://h/p#f?g", "http://www.example.com/en/1", "http://example.com/en/1", "http://a.com"]
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/")]
    df = spark.createDataFrame([(i, u, 1, 2) for i, u in enumerate(urls)] + [(None, urls[0], 1, 2)], "page_id long, url string, host int, rule int")
    found = [tuple(r)[1:] for r in url_filter.judge(df, rules).orderBy(F.col("page_id").asc_nulls_last()).collect()]
    none = ("", "", None, "allow")
    assert found == [("a.example.com", "/En/x", "com/", "allow"), ("x.net", "", None, "allow"), none, none, none, ("h", "/p", None, "allow"), ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("example.com", "/en/1", "example.com/en/", "block"), ("a.com", "", None, "allow"), ("a.example.com", "/En/x", "com/", "allow")]
    assert url_filter.judge(df.limit(0), rules).count() == 0
    twice = [tuple(r) for r in url_filter.judge(df.union(df), rules).collect()]
    assert sorted(map(str, twice)) == sorted(map(str, [tuple(r) for r in url_filter.judge(df, rules).collect()] * 2))


@pytest.mark.parametrize("as_table", [False, True])
def test_rules_beyond_the_broadcast_bound(spark, monkeypatch, as_table):
    """The join gives what the trie gives, and what brute force over all rules gives."""
    rng = random.Random(4)
    hosts = ["com", "a.com", "B.a.com", "net", "x.net", "com.net", ""]
    paths = ["", "/", "/en", "/en/", "/en/us", "/en//", "/english"]
    rules = list({(h.lower(), p): (rng.choice(["allow", "block"]), h, p) for h, p in ((rng.choice(hosts), rng.choice(paths)) for _ in range(25))}.values())
    urls = [f"http://{h}{p}{q}" for h in [*hosts, "y.b.a.com", "com.", ".com", "a..com"] for p in [*paths, "/en/us/x.html", "/en//y"] for q in ("", "?a=/b", "#c")] + [None, "", "x", "http://"]
    df = spark.createDataFrame([(i, u, 0, 0) for i, u in enumerate([*urls, *urls[:5]])] + [(None, urls[3], 0, 0)], "page_id long, url string, host int, verdict int")
    table = spark.createDataFrame(rules, "verdict string, host string, path string") if as_table else rules
    trie = sorted(str(tuple(r)) for r in url_filter.judge(df, table).collect())
    monkeypatch.setattr(url_filter, "MOST_RULE_BYTES", 10)
    joined = sorted(str(tuple(r)) for r in url_filter.judge(df, table).collect())
    assert joined == trie and len(joined) == len(urls) + 6
    assert url_filter.judge(df.limit(0), table).count() == 0


def brute_tiles(item, text, least):
    free_i, free_t, covered = [True] * len(item), [True] * len(text), 0
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(text)):
                k = 0
                while p + k < len(item) and t + k < len(text) and free_i[p + k] and free_t[t + k] and item[p + k] == text[t + k]:
                    k += 1
                best = max(best, (k, -p, -t))
        k, p, t = best[0], -best[1], -best[2]
        if k < least:
            return covered
        for j in range(k):
            free_i[p + j] = free_t[t + j] = False
        covered += k


def test_tiles_against_brute_force():
    rng = random.Random(2)
    for _ in range(250):
        item = [rng.randint(1, rng.choice([3, 30])) for _ in range(rng.randint(0, 25))]
        text = [rng.randint(1, 30) for _ in range(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 4)):
            if item:
                a = rng.randrange(len(item))
                text += item[a : a + rng.randint(1, 12)] + [rng.randint(1, 30)]
        x, y = (np.array(v, dtype=np.uint64) for v in (item, text))
        found = decontaminate.tiles(x, y, 3)
        assert all(item[p : p + k] == text[t : t + k] and k >= 3 for p, t, k in found)
        assert sum(k for _, _, k in found) == brute_tiles(item, text, 3), (item, text)


def test_leaks(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "SEED_BITS", 64)  # a full bitmap lets everything through
    words = [f"w{i}" for i in range(40)]
    item = " ".join(words)
    moved = " ".join([*words[20:], "between", *words[:20]])
    half = " ".join(words[:20])
    docs = spark.createDataFrame([(1, f"before {item} after"), (2, f"x {moved.upper()}!"), (3, half), (4, None), (5, ""), (6, item.replace(" ", ", ")), (None, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item, 0), (8, "too short an item", 0), (9, None, 0), (10, " ".join(f"v{i}" for i in range(30)), 0)], "item_id long, text string, doc_id int")
    found = {(r["doc_id"], r["item_id"], r["n_words"], r["n_covered"]) for r in decontaminate.overlaps(docs, bench).collect()}
    assert found == {(1, 7, 40, 40), (2, 7, 40, 40), (6, 7, 40, 40), (None, 7, 40, 40)}
    assert sorted(r["doc_id"] or 0 for r in decontaminate.decontaminate(docs, bench).collect()) == [0, 3, 4, 5]
    assert decontaminate.overlaps(no_docs, bench).count() == 0 and decontaminate.overlaps(docs, bench.limit(0)).count() == 0
    assert decontaminate.decontaminate(odd_docs, bench).count() == odd_docs.count()


def test_least_seeds_by_brute_force():
    """Tiles of five words and more that cover an item to the limit never have fewer seeds."""

    def fewest(n, least):
        """Least number of seeds of tilings of at least `least` of n words."""
        best = {0: 0}
        for _ in range(n // 5 + 1):
            best |= {c + k: min(best.get(c + k, 99), s + k - 4) for c, s in list(best.items()) for k in range(5, n - c + 1)}
        return min(s for c, s in best.items() if c >= least)

    for n in range(5, 45):
        for coverage in (0.3, 0.5, 0.8, 1.0):
            low = max(5, int(np.ceil(coverage * n - 1e-9)))
            if low <= n:
                assert decontaminate.least_seeds(n, coverage) <= fewest(n, low)


@pytest.mark.parametrize("bits", [64, 1 << 16, 1 << 26])
@pytest.mark.parametrize("coverage", [0.8, 0.4])
def test_overlaps_against_brute_force(spark, monkeypatch, bits, coverage):
    """All pairs, tiled word by word; repeated rows on both sides, and seeds that many documents share."""
    monkeypatch.setattr(decontaminate, "SEED_BITS", bits)
    rng = random.Random(bits)
    common = [f"c{i}" for i in range(12)]
    text = lambda n: [rng.choice(["a", "b", *[f"w{i}" for i in range(40)]]) for _ in range(n)]
    items = [common[:6] + text(rng.randint(0, 20)) for _ in range(12)] + [text(rng.randint(3, 9)) for _ in range(6)]
    items.append(items[0])
    docs = []
    for _ in range(60):
        words = text(rng.randint(0, 10)) + common
        for _ in range(rng.randint(0, 3)):
            own = rng.choice(items)
            at = rng.randrange(len(own))
            words += own[at:] + text(rng.randint(0, 2)) + own[:at]
        docs.append(words)
    docs.append(docs[0])
    want = []
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            n = brute_tiles(item, doc, 5)
            if len(item) >= 5 and n >= coverage * len(item):
                want.append((d, i, len(item), n))
    df = spark.createDataFrame([(i, " ".join(w), 1, 2, 3) for i, w in enumerate(docs)], "doc_id long, text string, item long, row long, seed long")
    bench = spark.createDataFrame([(i, " ".join(w), 1, 2) for i, w in enumerate(items)], "item_id int, text string, item long, often long")
    found = decontaminate.overlaps(df, bench, coverage)
    assert sorted(tuple(r)[:4] for r in found.collect()) == want and found.columns[:2] == ["doc_id", "item_id"]
    assert decontaminate.overlaps(df.union(df), bench.union(bench), coverage).count() == 4 * len(want)


#: Lines that are in no notice or frame of the training, and what they are.
SEEN_IN_FILES = [
    ("Mozilla Public License Version 2.0", "MPL-2.0"),
    ("ISC License", "ISC"),
    ("# Released under the terms of the MIT License", "MIT"),
    ("This module is licensed under the Apache License, Version 2.0 by its authors.", "Apache-2.0"),
    ("The sources are distributed under the GNU General Public License, version 3 or later.", "GPL"),
    ("Our library may be used under the GNU Lesser General Public License, version 2.1.", "LGPL"),
    ("Licensed under the GNU Affero General Public License, version 3 (AGPL).", "AGPL"),
    ("SPDX-License-Identifier: BSD-3-Clause", "BSD"),
    ("// Use of this source code is governed by a BSD-style license", "BSD"),
    ("The photos are licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"),
    ("This text is available under the Creative Commons Attribution-ShareAlike License", "CC-BY-SA"),
    ("Copyright 1999 by the authors. All rights reserved.", "proprietary"),
    ("This work has been released into the public domain by its author.", "public-domain"),
    ("This project is licensed under the European Union Public Licence.", "unknown"),
    ("Licensed under the Foo Bar Public License, version 7.", "unknown"),
    ("Distributed under the terms of the accompanying license.", "unknown"),
]
ORDINARY_LINES = [
    "The model was trained on this data in the second year.", "A licence to fish costs ten pounds.", "He came in with the Apache scouts and a copy of the map.", "MIT researchers published the work in 2003.", "The contract was free of any such terms.", "Mit und ohne Zucker.",
    "You may use the side door.", "The software of the lift failed without warning.", "The public library is open.", "She read all the conditions and agreed.",
]


@pytest.fixture(scope="module")
def scanner():
    return licences.Scanner()


def found_lines(scanner, text):
    data, offsets = licences.buffers(licences.pa.array([text]))
    _, numbers, _, _, names = scanner.lines(data, offsets)
    return dict(zip(numbers.tolist(), names, strict=True))


def test_licence_recall_and_false_alarms(scanner):
    """At least nine tenths of lines the training has not seen, each alone and all in one document; no ordinary line."""
    alone = [found_lines(scanner, line).get(0) == family for line, family in SEEN_IN_FILES]
    assert np.mean(alone) >= 0.9, [x for x, ok in zip(SEEN_IN_FILES, alone, strict=True) if not ok]
    assert not any(found_lines(scanner, line) for line in ORDINARY_LINES)
    mixed = "\n\n".join(f"{plain}\n{line}" for plain, (line, _) in zip(ORDINARY_LINES, SEEN_IN_FILES, strict=False))
    assert set(found_lines(scanner, mixed)) <= {3 * i + 1 for i in range(10)}


def test_a_wrapped_notice_is_found_whole(scanner):
    words = licences.NOTICES["MIT"][1].split()
    lines = [" ".join(words[i : i + 9]) for i in range(0, len(words), 9)]
    text = "\n".join(["First some prose.", "", *lines, "", "The cat sat on the mat.", "And slept."])
    assert found_lines(scanner, text) == {2 + i: "MIT" for i in range(len(lines))}


def test_template_step_by_brute_force():
    """Families are confirmed by the share of word pairs that both have."""
    rng = random.Random(3)
    scan = licences.Scanner.__new__(licences.Scanner)
    scan.rule = licences.ByteRule(licences.PUNCTUATED)
    for _ in range(400):
        a, b = (" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 8))) for _ in range(2))
        pairs = [set(zip(x.split(), x.split()[1:], strict=False)) or {(w,) for w in x.split()} for x in (a, b)]
        both, least = len(pairs[0] & pairs[1]), min(map(len, pairs))
        assert scan._alike(scan._set(a), scan._set(b)) == (least > 0 and both >= 0.6 * least and both >= min(2, len(pairs[1])))


def test_ties_between_families_and_long_lines(scanner):
    p = np.zeros(len(scanner.classes))
    p[[1, 2]] = 0.5  # of equally likely families the first one
    assert scanner._judged(p, True, b"Licensed under the MIT License or the Apache License, Version 2.0")[0] in (scanner.classes[1], "unknown")
    long = "word " * 50_000 + "Released under the MIT License. " + "word " * 50_000
    assert found_lines(scanner, long) == {} and found_lines(scanner, long + "\nReleased under the MIT License.") == {1: "MIT"}


def test_licences(spark, scanner, odd_docs, no_docs):
    lines = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0", "unknown": "Distributed under the terms of the accompanying license.", "none": "The model was trained on this data in the second year."}
    docs = spark.createDataFrame([(i, f"some words first\n{t}\nand last", 0) for i, t in enumerate(lines.values())] + [(90, None, 0), (91, "", 0), (None, lines["MIT"], 0)], "doc_id long, text string, licence int")
    found = {r["doc_id"]: r for r in licences.scan(docs, scanner).collect()}
    assert [found[i]["licence"] for i in range(len(lines))] == list(lines)
    assert found[0]["paragraphs"][0]["paragraph"] == 1 and found[0]["n_paragraphs"] == 3
    assert (found[90]["n_paragraphs"], found[91]["licence"], found[None]["licence"]) == (0, "none", "MIT")
    assert licences.scan(no_docs, scanner).count() == 0
    plain = licences.scan(odd_docs, scanner)
    assert plain.count() == odd_docs.count() and plain.where("licence <> 'none'").count() == 0


def labelled(spark, n=500, seed=6):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = [rng.choice(["the", "cat", "sat", "on", "a", "mat", "and", "slept"]) for _ in range(rng.randint(5, 60))]
        text = " ".join(words).capitalize() + "." if good else rng.choice([" | ".join(words), " ".join(w.upper() + "!!" for w in words), " ".join(words[:1] * 30)])
        rows.append((i, text, rng.choice(["en", "fr", None]), "good" if good and rng.random() < 0.6 else "any", len(text)))
        marks.append((i, int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(marks, "doc_id long, quality int")


def test_quality_on_held_out_labels(spark):
    docs, truth = labelled(spark)
    model = quality.fit(docs, truth.where("doc_id % 2 = 0"))
    found = quality.score(docs.where("doc_id % 2 = 1"), model).join(truth, "doc_id").collect()
    assert np.mean([r["kept"] == bool(r["quality"]) for r in found]) > 0.95
    assert np.mean([r["kept"] for r in found if r["quality"]]) > 0.99
    assert quality.keep_good(docs, model).columns == docs.columns
    kept = {r["doc_id"] for r in quality.keep_good(docs, model).collect()}
    assert kept == {r["doc_id"] for r in quality.score(docs, model).collect() if r["kept"]}


def test_quality_beside_columns_of_its_own_names(spark):
    docs, truth = labelled(spark, 80)
    plain, marks = quality.fit(docs, truth.limit(40)), truth.limit(40)
    other = docs.select("*", *[F.lit(1).alias(c) for c in ("quality", "a", "b", "mark", "kept", "score")])
    model = quality.fit(other, marks.withColumn("text", F.lit("x")))
    assert sorted(map(tuple, quality.score(other, model).collect())) == sorted(map(tuple, quality.score(docs, plain).collect()))


def test_views_teach_each_other_from_all_documents(spark):
    """The surest documents of a round are those of the whole corpus, by brute force over all logits."""
    docs, truth = labelled(spark, 400)
    marks = truth.where("doc_id < 120")
    rule = quality.ByteRule(quality.PUNCTUATED)
    rows = sorted(docs.collect(), key=lambda r: r["doc_id"])
    text = quality.text_features(quality.pa.array([r["text"] for r in rows]), rule)
    meta = quality.meta_features(*([r[c] for r in rows] for c in ("lang", "source", "n_chars")))
    own = dict(marks.collect())
    first = quality.Model([(text[i], meta[i], own[i]) for i in sorted(own)], lambda views, good, bad: [], rounds=1)
    pool, seen = [i for i in range(400) if i not in own], []

    def surest(views, good, bad):
        for view, x in zip(views, (text, meta), strict=True):
            z = np.round(view.logit(x), 9)
            seen.append((sorted((z[i] for i in pool if z[i] > 0), reverse=True)[:good], sorted(z[i] for i in pool if z[i] < 0)[:bad]))
            for picks, m in ((sorted((i for i in pool if z[i] > 0), key=lambda i: -z[i])[:good], 1), (sorted((i for i in pool if z[i] < 0), key=lambda i: z[i])[:bad], 0)):
                chosen.update({i: m for i in picks if i not in chosen})
        return [(text[i], meta[i], m) for i, m in sorted(chosen.items())]

    chosen: dict = {}
    brute = quality.Model([(text[i], meta[i], own[i]) for i in sorted(own)], surest, rounds=1, per_round=20)
    found = quality.fit(docs, marks, rounds=1, per_round=20)
    assert any(len(g) and len(b) for g, b in seen)
    a, b, c = (m.scores(text, meta)[:, 2] for m in (found, brute, first))
    assert np.abs(a - b).max() < 0.05 and np.abs(a - c).max() > 0


def test_quality_of_odd_rows(spark):
    docs, truth = labelled(spark, 60)
    odd = spark.createDataFrame([(900, None, None, None, None, 1), (901, "", "en", "x", 0, 1), (902, "a b", "en", "x", 3, 1), (902, "a b", "en", "x", 3, 1), (None, "a", "en", "x", 1, 1)], "doc_id long, text string, lang string, source string, n_chars long, score int")
    model = quality.fit(docs, truth.unionByName(spark.createDataFrame([(None, 1), (3, None), (5000, 0)], "doc_id long, quality int")))
    assert quality.score(odd, model).count() == 5 and quality.keep_good(odd, model).columns == odd.columns
    for few in (truth.limit(0), truth.where("quality = 1")):  # nothing to learn from: everything stays
        assert quality.score(docs, quality.fit(docs, few)).where("kept").count() == 60
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), truth)).count() == 0
