import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from inkloom.llm import bpe, sstable, token_counts
from inkloom.llm.common import shared_dir

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")
BITS = ["a", "B", "É", "ß", " ", "  ", "\n", "\t", "'", "s", "'re", "1", "²", "\xa0", "\x85", "\x1c", "Σ", "ΣΑΣ", "İ", "é", "́", "😀", "<|endoftext|>", "<|", "|>", "!", "...", "中", "ﬁ", " ", "Å", "the", "ing"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load(RANKS, PATTERN).ranks, special_tokens={})


def test_ids_are_the_librarys(library):
    rng, own = random.Random(1), bpe.load(RANKS, PATTERN)
    for _ in range(1500):
        text = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 40)))
        ids = own.encode(text)
        assert ids.tolist() == library.encode_ordinary(text) and own.decode(ids) == text.encode()


def test_very_long_pre_tokens(library):
    for text in ("a" * 60_000, "ab" * 20_000, "é" * 15_000, " " * 30_000 + "x"):
        assert bpe.load(RANKS, PATTERN).encode(text).tolist() == library.encode_ordinary(text)


def test_two_cache_generations(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    own = bpe.ByteBPE.from_file(RANKS, PATTERN)
    text = "one two three four five six seven eight nine ten one two ten nine " * 3
    assert own.encode(text).tolist() == library.encode_ordinary(text)


def test_encoding_of_odd_documents(odd_docs, no_docs, library):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    found = sorted(str((r["id"], list(r["ids"]), bytes(r["decoded"]))) for r in bpe.encode_documents(odd_docs, RANKS, PATTERN).collect())
    assert found == sorted(str((i, library.encode_ordinary(t or ""), (t or "").encode())) for i, t in rows)
    assert bpe.digest_documents(no_docs, RANKS, PATTERN).count() == 0


def test_pieces_are_the_librarys(monkeypatch):
    monkeypatch.setattr(sstable, "CACHE_ENTRIES", 50)
    own, lib, rng = sstable.PieceEncoder(WORDS), Tokenizer.from_file(WORDS), random.Random(2)
    assert own.pattern is not None
    for _ in range(40):
        texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(20)] + [None]
        assert [x.tolist() for x in own.encode(texts, 1)] == [[*e.ids, 1] for e in lib.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_other_tokenizers_get_whole_texts():
    own, lib = sstable.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json")), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert own.pattern is None and own.encode(["a  b\nc"], None)[0].tolist() == lib.encode("a  b\nc", add_special_tokens=False).ids


def test_shard_format():
    rng = np.random.default_rng(3)
    keys = sorted(int(k) for k in rng.integers(-(1 << 62), 1 << 62, 700))
    for width in (2, 4):
        writer = sstable.Writer(width)
        values = {k: rng.integers(0, 60_000, rng.integers(0, 60)).astype(np.uint32) for k in keys}
        writer.add(sstable.key_of(None), np.array([9], dtype=np.uint32))
        for k in keys:
            writer.add(sstable.key_of(k), values[k])
        reader = sstable.Reader(writer.finish())
        assert len(reader.index) > 1 and reader.entries == len(keys) + 1 and reader.tokens == 1 + sum(map(len, values.values()))
        found = [(sstable.id_of(k), v.tolist()) for k, v in reader.scan()]
        assert found == [(None, [9]), *[(k, values[k].tolist()) for k in keys]]
        assert all(reader.get(sstable.key_of(k))[0].tolist() == values[k].tolist() for k in keys[::7])
        missing = [k for k in range(1000) if k not in values]
        assert not any(reader.get(sstable.key_of(k)) for k in missing)
        assert sum(reader.may_hold(sstable.key_of(k)) for k in missing) < 50
    with pytest.raises(ValueError, match="order"):
        writer.add(sstable.key_of(-(1 << 63)), np.array([1]))
    with pytest.raises(ValueError, match="magic"):
        sstable.Reader(b"x" * 200)


def test_shards_of_odd_documents(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(sstable, "SHARD_TARGET", 2000)
    folder = shared_dir(spark)
    lib = Tokenizer.from_file(WORDS)
    rows = sorted(((r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, at = [], 0
    for i, t in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        want.append(str((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))))
        at += len(ids)
    found = [str(tuple(r)) for r in sstable.encode_to_shards(odd_docs, WORDS, folder).collect()]
    assert sorted(found) == sorted(want)
    out = sstable.write_shards(odd_docs, WORDS, f"{folder}/looked-up")
    got = {(r["doc_id"], tuple(r["ids"])) for r in sstable.look_up(spark, out, [203, 206, 999]).collect()}
    assert {k for k, _ in got} == {203, 206} and (203, (*lib.encode("one", add_special_tokens=False).ids, 1)) in got
    assert sstable.read_shards(spark, out).count() == len(rows)
    assert sstable.encode_to_shards(no_docs, WORDS, folder).count() == 0


def test_repeated_ids_over_shards(spark, monkeypatch):
    """Equal rows that a shard's end parts have starts of their own; a look-up finds them all and reads ranges only."""
    monkeypatch.setattr(sstable, "SHARD_TARGET", 40)
    monkeypatch.setattr(sstable, "ENCODE_BYTES", 10)
    text = "one two three four five six seven eight nine ten " * 2
    docs = spark.createDataFrame([(i, text, 5, 6) for i in (7, 7, 7, 7, 3, 9)], "doc_id long, text string, partition int, number int")
    n = len(Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids) + 1
    out = sstable.write_shards(docs, WORDS, f"{shared_dir(spark)}/repeated")
    rows = sorted(tuple(r)[:3] for r in sstable.digest_shards(spark, out).collect())
    assert rows == [(i, k * n, n) for k, i in enumerate((3, 7, 7, 7, 7, 9))]
    assert len(sstable._files(spark, out)) >= 4
    read = []
    opened = sstable._opened

    def counted(*args):
        reader = opened(*args)
        own = reader.read
        reader.read = lambda at, k: read.append(k) or own(at, k)
        return reader

    monkeypatch.setattr(sstable, "_opened", counted)
    found = sstable.look_up(spark, out, [7, 8, 9, None]).groupBy("doc_id").count().collect()
    assert sorted(map(tuple, found)) == [(7, 4), (9, 1)]
    assert sstable.look_up(spark, out, []).count() == 0
    assert read and max(read) < 400  # a Bloom filter, a block index or one block


def brute_counts(text, library, rule):
    data = text.encode()
    starts = [0, *[i + 1 for i, b in enumerate(data) if b == 10 and i + 1 < len(data)]] if data else []
    section = lambda at: max(k for k, s in enumerate(starts) if s <= at)
    counts, crossing, at = [0] * len(starts), [0] * len(starts), 0
    for token in library.decode_tokens_bytes(library.encode_ordinary(text)):
        held = [section(i) for i in range(at, at + len(token))]
        own = {"first": held[0], "last": held[-1], "majority": max(sorted(set(held)), key=held.count)}[rule]
        counts[own] += 1
        crossing[own] += len(set(held)) > 1
        at += len(token)
    return list(zip(counts, crossing, strict=True))


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_section_counts(spark, library, rule):
    rng = random.Random(4)
    docs = {i: "".join(rng.choice([*BITS, "\n", "\n\n\n", " \n"]) for _ in range(rng.randint(0, 50))) for i in range(120)} | {200: None, 201: "", 202: "\n"}
    found = {}
    for r in token_counts.count_sections(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), RANKS, PATTERN, rule).collect():
        found.setdefault(r["doc_id"], []).append((r["section"], r["n_tokens"], r["n_crossing"]))
    for i, t in docs.items():
        assert [x[1:] for x in sorted(found.get(i, []))] == brute_counts(t or "", library, rule), i


def test_section_counts_add_up(odd_docs, no_docs, library):
    rows = token_counts.count_sections(odd_docs, RANKS, PATTERN).collect()
    assert sum(r["n_tokens"] for r in rows) == sum(len(library.encode_ordinary(r["text"] or "")) for r in odd_docs.collect())
    assert token_counts.count_sections(no_docs, RANKS, PATTERN).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_sections(no_docs, RANKS, PATTERN, rule="other")
