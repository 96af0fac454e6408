"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a doubly linked list of byte pieces.  Every adjacent pair that
the vocabulary can merge waits in the bucket of its rank; a bucket is a heap of
list positions, so equal ranks merge from the left.  A bitmap over the ranks,
in words, with a bitmap over those words above it, finds the lowest waiting rank
by two find-first-set steps.  Entries that a merge has made stale are
skipped when they surface.  The work for a pre-token of n bytes is
O(n log n), whatever its length.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from inkloom.llm.common import released

#: Pre-tokens of a generation of a worker's cache; a task keeps two, so frequent ones
#: survive, and leaves the KEPT_ENTRIES that it met first to the next.
KEPT_ENTRIES = 150_000
CACHE_ENTRIES = 400_000
#: Longer pre-tokens are encoded each time, so that the cache stays small.
CACHE_CHARS = 64


#: Ranks per word of the lower bitmap; the upper bitmap has a bit for each such word.
SHIFT = 8


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class ByteBPE:
    """Ranks of byte strings, as in a .tiktoken file, with the pattern that splits text first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.size = max(ranks.values(), default=0) + 1
        self.strings: list[bytes] = [b""] * self.size
        for string, rank in ranks.items():
            self.strings[rank] = string
        self.words = [0] * ((self.size >> SHIFT) + 1)
        self.bit = [1 << i for i in range(max(1 << SHIFT, len(self.words)))]
        self.buckets: list[int | list[int] | None] = [None] * self.size
        self.cache = _Cache(self)

    @classmethod
    def from_file(cls, path: str, pattern: str) -> ByteBPE:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}, pattern)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token.

        The queue's words and buckets are the object's own and empty between
        calls.  A bucket with one position is that position, else a heap.
        """
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        end = list(range(1, n + 1))  # end of the piece that starts here
        before = list(range(-1, n - 1))
        waiting: list[int | None] = [None] * n  # rank of the pair that starts here
        get, words, buckets, bit, low_mask = ranks.get, self.words, self.buckets, self.bit, (1 << SHIFT) - 1
        upper = 0
        fresh = [(get(piece[i : i + 2]), i) for i in range(n - 1)]
        while True:
            for rank, i in fresh:
                waiting[i] = rank
                if rank is None:
                    continue
                bucket = buckets[rank]
                if bucket is None:
                    buckets[rank] = i
                    w = rank >> SHIFT
                    word = words[w]
                    if not word:
                        upper |= bit[w]
                    words[w] = word | bit[rank & low_mask]
                elif type(bucket) is int:
                    buckets[rank] = [bucket, i] if bucket < i else [i, bucket]
                else:
                    heappush(bucket, i)
            # the lowest rank: first set bit of the upper bitmap, then of its word; stale positions are skipped
            while upper:
                w = (upper & -upper).bit_length() - 1
                word = words[w]
                low = word & -word
                top = (w << SHIFT) + low.bit_length() - 1
                bucket = buckets[top]
                if type(bucket) is int:
                    i = bucket
                    buckets[top] = None
                    words[w] = word = word ^ low
                    if not word:
                        upper ^= bit[w]
                else:
                    i = heappop(bucket)
                    if len(bucket) == 1:
                        buckets[top] = bucket[0]
                if waiting[i] == top:
                    break
            else:
                break
            j = end[i]
            k = end[i] = end[j]
            waiting[j] = None
            fresh = []
            if k < n:
                before[k] = i
                fresh.append((get(piece[i : end[k]]), i))
            else:
                waiting[i] = None
            if i:
                h = before[i]
                fresh.append((get(piece[h:k]), h))
        out, i = [], 0
        while i < n:
            k = end[i]
            out.append(ranks[piece[i:k]])
            i = k
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids as little-endian unsigned 32-bit integers; no special tokens."""
        return np.frombuffer(b"".join(map(self.cache.__getitem__, self.pattern.findall(text))), dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.strings.__getitem__, ids.tolist()))


class _Cache(dict):
    """Ids of pre-tokens; what the older generation still has is taken over when it is asked for."""

    def __init__(self, bpe: ByteBPE):
        self.bpe = bpe
        self.older: dict[str, bytes] = {}

    def shrink(self) -> None:
        first = dict(islice(self.items(), KEPT_ENTRIES))
        self.clear()
        self.update(first)
        self.older = {}

    def __missing__(self, token: str) -> bytes:
        ids = self.older.get(token)
        if ids is None:
            ids = packed(self.bpe.merge(token.encode("utf-8")))
            if len(token) > CACHE_CHARS:
                return ids
        if len(self) >= CACHE_ENTRIES:
            self.older = dict(self)
            self.clear()
        self[token] = ids
        return ids


_LOADED: dict[tuple[str, str], ByteBPE] = {}


def load(path: str, pattern: str) -> ByteBPE:
    """The vocabulary, once in each Python worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBPE.from_file(path, pattern)
    return _LOADED[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded binary) of each row: one narrow pass, no shuffle.

    A null text counts as empty and gives no ids; repeated rows and null ids
    give a row each; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [bpe.encode(text or "") for text in part.column(1).to_pylist()]
                yield pa.record_batch(
                    [part.column(0), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array([bpe.decode(x) for x in ids], pa.binary())],
                    names=["id", "ids", "decoded"],
                )
        bpe.cache.shrink()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(lambda batches: released(run(batches)), f"id {kind}, ids array<int>, decoded binary")


def digest_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As encode_documents, but with the digests of ids and decoded bytes made in the same pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            count, ids_sha, text_sha = [], [], []
            for value in batch.column(1):
                ids = bpe.encode(value.as_py() or "")
                count.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        bpe.cache.shrink()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col], docs[text_col].cast("string").alias("text")).mapInArrow(lambda batches: released(run(batches)), f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
