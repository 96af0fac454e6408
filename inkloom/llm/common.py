"""Shared pieces: tables, lineage cuts, and vectorised word hashing on Arrow buffers."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
#: Bytes of text that the vectorised passes look at together; bounds their memory.
BLOCK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and workers share; where none is set, a fresh local one if all run in one process, else an error."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if found is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all workers share")
        found = "file://" + tempfile.mkdtemp(prefix="inkloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def cut(df: DataFrame, files_per_core: int | None = None) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives lost workers and ends the lineage.

    files_per_core bounds the number of files, for tables of short rows.
    """
    shared_dir(df.sparkSession)
    if files_per_core is not None:
        df = df.coalesce(files_per_core * df.sparkSession.sparkContext.defaultParallelism)
    return df.checkpoint(eager=True)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, after the last of which freed memory goes back to the system: workers live on and others need it."""
    yield from batches
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser; a bijection."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def random_words(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random odd-or-even 64-bit values from a seed."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15) + U64(seed))


class ByteRule:
    """Which bytes separate words and how bytes are folded before hashing."""

    def __init__(self, delimiters: bytes, lower: bool = True, seed: int = 11):
        self.fold = np.arange(256, dtype=np.uint8)
        if lower:
            self.fold[65:91] += 32
        self.delimiter = np.zeros(256, dtype=bool)
        self.delimiter[list(delimiters)] = True
        self.value = random_words(seed, 256)[self.fold]
        self.value[self.delimiter] = 0
        self.power = np.ones(1, dtype=np.uint64)

    def powers(self, n: int) -> np.ndarray:
        if len(self.power) < n:
            base = U64(0xD6E8FEB86659FD93)
            steps = np.full(max(n, 256), base, dtype=np.uint64)
            steps[0] = 1
            self.power = np.multiply.accumulate(steps)
        return self.power


#: White space of the near-duplicate contract: 0x20 and 0x09-0x0D.
SPACES = b" \t\n\x0b\x0c\r"
#: ASCII other than letters and digits separates words where punctuation should not matter.
PUNCTUATED = bytes(b for b in range(128) if not chr(b).isalnum())


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    if not len(offsets):
        return data[:0], np.zeros(1, dtype=np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes; a longer row stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi


def word_hashes(data: np.ndarray, offsets: np.ndarray, rule: ByteRule) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of each word, and for each row the index of its first word (one more at the end)."""
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), none, none, np.zeros(len(offsets), dtype=np.int64)
    inside = ~rule.delimiter[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts, starts, np.zeros(len(offsets), dtype=np.int64)
    until = np.append(starts[1:], n)
    place = np.arange(n, dtype=np.int64)
    place[: starts[0]] = 0
    place[starts[0] :] -= np.repeat(starts, until - starts)
    values = rule.value[data]
    values *= rule.powers(int((until - starts).max()) + int(starts[0]) + 1)[place]
    hashes = mix(np.add.reduceat(values, starts))
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends_at = offsets[1:][(offsets[1:] > 0)] - 1
    last[ends_at] = inside[ends_at]
    return hashes, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


_GRAM = random_words(77, 64)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k adjacent words of one row; of the whole row if it has fewer words."""
    n = len(hashes)
    if not n:
        return hashes
    if n < k:
        k = n
    out = hashes[: n - k + 1] * _GRAM[0] + U64(k)
    for j in range(1, k):
        out = mix(out) + hashes[j : n - k + 1 + j] * (_GRAM[j % 64] | U64(1))
    return mix(out)
