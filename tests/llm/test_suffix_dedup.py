import hashlib
import random
import zlib

import numpy as np
import pytest

from inkloom.llm import induced_sort, suffix_dedup


def common(a, b):
    k = 0
    while k < min(len(a), len(b), induced_sort.CAP) and a[k] == b[k]:
        k += 1
    return k


@pytest.mark.parametrize(("base", "memory"), [(1 << 22, 1 << 20), (4, 64), (0, 1 << 20)])
def test_order_and_common_prefixes(base, memory):
    """Doubling, recursion on names and a queue that goes to disk give the same, right order."""
    rng = random.Random(base + memory)
    for _ in range(250):
        letters = rng.choice([b"a", b"ab", b"abc", bytes(range(256)), b"\xff\x00a"])
        segments = [bytes(rng.choice(letters) for _ in range(rng.randint(1, rng.choice([3, 12, 40])))) for _ in range(rng.randint(1, 6))]
        segments += segments[:1] * rng.randint(0, 2)
        text, ends = np.frombuffer(b"".join(segments), dtype=np.uint8), np.cumsum([len(s) for s in segments])
        suffix, off = {}, 0
        for s in segments:
            suffix.update({off + i: s[i:] for i in range(len(s))})
            off += len(s)
        order, shared = induced_sort.suffix_array(text, ends, base, memory)
        assert sorted(order.tolist()) == sorted(suffix)
        for x, y, n in zip(order, order[1:], shared[1:], strict=False):
            assert suffix[x] <= suffix[y] and common(suffix[x], suffix[y]) == n


@pytest.mark.parametrize(("symbols", "most"), [(1, 8), (1, 3), (0, 1), (1 << 10, 1 << 16)])
def test_ranges_of_symbols(monkeypatch, symbols, most):
    """The queue by ranges of symbols gives what the queue by symbols does, from runs and periodic texts too."""
    monkeypatch.setattr(induced_sort, "SYMBOLS", symbols)
    monkeypatch.setattr(induced_sort, "RANGE", most)
    rng = random.Random(most)
    texts = [b"x" * 500, b"ab" * 300, b"abc" * 100 + b"ab" * 90, bytes(rng.choice(b"ab") for _ in range(900)), bytes(rng.randrange(256) for _ in range(900))]
    for text in texts:
        order, _ = induced_sort.suffix_array(np.frombuffer(text, dtype=np.uint8), np.array([len(text)]), 0, 64)
        assert [text[i:] for i in order] == sorted(text[i:] for i in range(len(text)))


def test_types_over_steps(monkeypatch):
    rng = random.Random(5)
    for step in (1, 2, 7, 1 << 18):
        monkeypatch.setattr(induced_sort._Text, "STEP", step)
        s = np.array([rng.choice([0, 1, 1, 1, 2]) for _ in range(200)] + [0], dtype=np.uint16)
        want = [True] * 201
        for i in range(199, -1, -1):
            want[i] = True if s[i] == 0 else s[i] < s[i + 1] or (s[i] == s[i + 1] and want[i + 1])
        assert induced_sort._Text(s).small.tolist() == want


def test_queues_go_to_disk_and_names_recur_in_production():
    """A shard of SHARD bytes with the parameters of the query: spilled queues, several recursions, right marks."""
    rng = np.random.default_rng(8)
    words = [bytes(rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8)) for _ in range(3000)]
    passages = [b" ".join(words[i] for i in rng.integers(0, 3000, 30))[:138] for _ in range(4000)]
    picks = rng.integers(0, len(passages), suffix_dedup.SHARD // 138)
    text = np.frombuffer(b"".join(passages[i].ljust(138, b"-") for i in picks), dtype=np.uint8)
    ends = np.arange(138, len(text) + 1, 138)
    induced_sort.COUNTS.clear()
    n = repeats = 0
    for order, common in induced_sort.suffix_blocks(text, ends):
        n += len(order)
        repeats += int((common >= 100).sum())
        assert len(order) < len(text) // 3  # a symbol at a time
    assert n == len(text) and repeats == 39 * (len(picks) - len({passages[i].ljust(138, b"-") for i in picks}))
    assert induced_sort.COUNTS["spills"] > 5 and induced_sort.COUNTS["recursions"] > 1


def test_same_bytes():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 2, 5000).astype(np.uint8)
    data[3000:4000] = data[:1000]
    a, size = rng.integers(0, 900, 300), rng.integers(0, 90, 300)
    b = np.where(rng.random(300) < 0.5, a + 3000, rng.integers(0, 4900, 300))
    want = [bool(n) and data[x : x + n].tobytes() == data[y : y + n].tobytes() for x, y, n in zip(a, b, size, strict=True)]
    assert suffix_dedup._same_bytes(data, a, b, size).tolist() == want and any(want) and not all(want)


def test_equal_hashes_are_no_proof_within_a_task(odd_docs, monkeypatch):
    """With a hash that takes all contexts of an anchor for copies, bytes still decide, and the sort finds the rest."""
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect() if r["doc_id"] is not None and r["doc_id"] < 120]
    joined = suffix_dedup._joined

    def weak(parts, at, sizes, n):
        return joined(parts, at, sizes, n) if isinstance(at, slice) else np.zeros(len(at), dtype=np.uint64)

    run = suffix_dedup._sampled(100, 5)
    monkeypatch.setattr(suffix_dedup, "_joined", weak)
    data = [(i, t) for i, t in rows if t]
    batch = suffix_dedup.pa.record_batch([suffix_dedup.pa.array([i for i, _ in data]), suffix_dedup.pa.array([t for _, t in data])], names=["doc", "text"])
    marked = [x for out in run(iter([batch])) for kind, x in zip(out.column(0).to_pylist(), out.column(2).to_pylist(), strict=True) if kind == suffix_dedup.MARKS]
    texts, found = dict(data), 0
    for blob in marked:
        for d, _, lo, size in zip(*(c.tolist() for c in suffix_dedup._unpack(blob)), strict=True):
            part = texts[d].encode()[lo : lo + size]
            assert any(part in t.encode()[: lo + size - 1 if i == d else None] for i, t in texts.items() if i <= d)
            found += 1
    assert found


def brute(rows, length):
    """Rows in order of id and checksum; equal rows once."""
    key = lambda r: (-(1 << 63) if r[0] is None else r[0], zlib.crc32((r[1] or "").encode()))
    seen, out = set(), {}
    for i, t in sorted({(i, t or "") for i, t in rows}, key=key):
        b = t.encode()
        cover, own = bytearray(len(b)), set()
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            if w in seen or w in own:
                cover[k : k + length] = b"\1" * length
            own.add(w)
        seen |= own
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        spans = sum(1 for k in range(len(b)) if cover[k] and (not k or not cover[k - 1]))
        out[i, t] = (i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return sorted(map(str, (out[i, t or ""] for i, t in rows)))


@pytest.mark.parametrize(("split", "slab", "shard", "base"), [(1 << 16, None, None, None), (1, None, None, None), (1 << 16, 700, 300, 16), (2, 700, 300, 1 << 22)])
def test_against_brute_force(spark, odd_docs, monkeypatch, split, slab, shard, base):
    if slab:
        monkeypatch.setattr(suffix_dedup, "SLAB", slab)
        monkeypatch.setattr(suffix_dedup, "SHARD", shard)
        monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 500)
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    found = sorted(str(tuple(r)) for r in suffix_dedup.removed(odd_docs, 100, split_contexts=split, base=base).collect())
    assert found == brute(rows, 100)


def test_runs_and_overlaps(spark):
    rows = [(1, "x" * 250), (2, "y" * 99 + "x" * 120), (3, "ab" * 130), (4, "é" * 80), (5, "zé" + "é" * 60)]
    found = sorted(str(tuple(r)) for r in suffix_dedup.removed(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert found == brute(rows, 100)


def test_dedup_keeps_columns_and_characters(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([(1, "q" + "é" * 60, 61, "a"), (2, "é" * 60 + "end", 63, None), (3, None, None, "b")], "doc_id long, text string, n_chars long, id string")
    found = {r["doc_id"]: tuple(r) for r in suffix_dedup.dedup(docs, count_col="n_chars").collect()}
    assert found == {1: (1, "q" + "é" * 60, 61, "a"), 2: (2, "end", 3, None), 3: (3, None, None, "b")} or found[1][1].startswith("q") and len(found[1][1]) == found[1][2]
    assert suffix_dedup.dedup(odd_docs).columns == odd_docs.columns and suffix_dedup.dedup(odd_docs).count() == odd_docs.count()
    assert suffix_dedup.removed(no_docs).count() == 0


def test_length_is_checked(odd_docs):
    with pytest.raises(ValueError):
        suffix_dedup.removed(odd_docs, 20)
