"""Benchmark decontamination by greedy string tiling.

Words are compared with A-Z lower-cased and ASCII punctuation as a separator.

1. Seeds are the runs of MIN_MATCH words of the items.  A bitmap of SEED_BITS
   bits, a fixed size for a benchmark of any size, holds two bits of each.  A narrow
   pass over the documents keeps only rows with runs of words that the bitmap
   may hold, and of these only the words of such runs.
2. A tile of k words has k - MIN_MATCH + 1 seeds, so an item that is covered to
   the limit shares at least `least_seeds` of its seeds with the document.  By the
   prefix principle it is enough to post each item under its rarest seeds, all
   but least_seeds - 1 of them: what many documents share is passed over.  The
   join of posted seeds with those of the documents gives candidate pairs.
3. Each pair meets in a task.  Running Karp-Rabin looks for the longest common
   runs of words that are not yet part of a tile, marks them, longest first, and
   goes on with shorter ones down to MIN_MATCH.  Coverage is the share of the
   item's words in tiles, wherever they lie, so moved passages count.

Items, seeds and documents stay tables; only the bitmap comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkloom.llm.common import PUNCTUATED, U64, ByteRule, buffers, cut, grams, released, runs, word_hashes

MIN_MATCH = 5
COVERAGE = 0.8
#: Bits of the bitmap of seeds, a power of two: what is broadcast never exceeds an eighth of it in bytes.
SEED_BITS = 1 << 26
_BASE = U64(0x9E3779B97F4A7C15)


class _Rolling:
    """Karp-Rabin hashes of all runs of s words."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.power = np.ones(n + 1, dtype=np.uint64)
        if n:
            self.power[1:] = np.multiply.accumulate(np.full(n, _BASE))
        # sum of word * base^(n - 1 - i): shifting by a power makes runs comparable
        self.prefix = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words * self.power[n - 1 :: -1][:n] if n else words, dtype=np.uint64)])
        self.n = n

    def runs(self, s: int, other_n: int) -> np.ndarray:
        """Hash of the run at each start, on a scale that sequences of up to other_n words share."""
        starts = np.arange(self.n - s + 1)
        raw = self.prefix[s:] - self.prefix[: self.n - s + 1]
        scale = starts if self.n >= other_n else starts + (other_n - self.n)
        return raw * _power(scale)


_POWERS = np.multiply.accumulate(np.concatenate([np.ones(1, dtype=np.uint64), np.full(1023, _BASE)]))


def _power(at: np.ndarray) -> np.ndarray:
    global _POWERS
    if len(at) and at[-1] >= len(_POWERS):
        _POWERS = np.multiply.accumulate(np.concatenate([np.ones(1, dtype=np.uint64), np.full(2 * int(at[-1]), _BASE)]))
    return _POWERS[at]


def tiles(item: np.ndarray, text: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """(start in item, start in text, words) of a greedy tiling; longest first, of equals the earliest in item, then text."""
    if len(item) < least or len(text) < least:
        return []
    free_item, free_text = np.ones(len(item), dtype=bool), np.ones(len(text), dtype=bool)
    roll_item, roll_text = _Rolling(item), _Rolling(text)
    found: list[tuple[int, int, int]] = []
    s = max(least, min(len(item), len(text)) // 2)
    while True:
        matches = _scan(item, text, free_item, free_text, roll_item, roll_text, s)
        longest = max((m[2] for m in matches), default=0)
        if longest > 2 * s:
            s = longest
            continue
        again = False
        for p, t, k in sorted(matches, key=lambda m: (-m[2], m[0], m[1])):
            if free_item[p : p + k].all() and free_text[t : t + k].all():
                free_item[p : p + k] = False
                free_text[t : t + k] = False
                found.append((p, t, k))
            else:
                again = True  # what an earlier tile left of it may still be long enough
        if again:
            continue
        if s == least:
            return found
        s = max(least, s // 2)


def _open(free: np.ndarray, s: int) -> np.ndarray:
    taken = np.concatenate([[0], np.cumsum(~free)])
    return taken[s:] == taken[:-s]


def _scan(item, text, free_item, free_text, roll_item, roll_text, s: int) -> list[tuple[int, int, int]]:
    """Maximal matches of at least s free words."""
    if s > min(len(item), len(text)):
        return []
    p_at, t_at = np.flatnonzero(_open(free_item, s)), np.flatnonzero(_open(free_text, s))
    if not len(p_at) or not len(t_at):
        return []
    p_hash, t_hash = roll_item.runs(s, roll_text.n)[p_at], roll_text.runs(s, roll_item.n)[t_at]
    order = np.argsort(p_hash, kind="stable")
    lo, hi = np.searchsorted(p_hash[order], t_hash, "left"), np.searchsorted(p_hash[order], t_hash, "right")
    out = []
    for i in np.flatnonzero(hi > lo):
        t = int(t_at[i])
        for p in p_at[order[lo[i] : hi[i]]].tolist():
            if p and t and free_item[p - 1] and free_text[t - 1] and item[p - 1] == text[t - 1]:
                continue  # part of the match that begins before it
            most = min(len(item) - p, len(text) - t)
            same = (item[p : p + most] == text[t : t + most]) & free_item[p : p + most] & free_text[t : t + most]
            k = most if same.all() else int(np.argmin(same))
            if k >= s:
                out.append((p, t, k))
    return out


def least_seeds(n_words: int, coverage: float) -> int:
    """Seeds of an item that a document must share where tiles cover the item to the limit.

    c covered words lie in at most c // MIN_MATCH tiles, and a tile of k words has
    k - (MIN_MATCH - 1) seeds, so they have at least c - (MIN_MATCH - 1) * (c // MIN_MATCH).
    """
    covered = max(MIN_MATCH, ceil(coverage * n_words - 1e-9))
    return min((c - (MIN_MATCH - 1) * (c // MIN_MATCH) for c in range(covered, min(covered + MIN_MATCH, n_words + 1))), default=1)


def _bits(seed: Column) -> list[Column]:
    """The two bits of a seed in the bitmap."""
    return [F.shiftrightunsigned(seed, 38) % SEED_BITS, F.pmod(seed, F.lit(SEED_BITS))]


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """The bitmap, put together by Spark; it arrives in as many rows as its size allows at most."""
    bits = seeds.select(F.explode(F.array(*_bits(F.col("seed")))).alias("bit"))
    parts = bits.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros(SEED_BITS // 8 + 8192, dtype=np.uint8)
    for r in parts.toLocalIterator():  # buckets count from 1 and their bits from 1, so bucket b holds the bits from (b - 1) * 32768 + 1
        raw = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
        at = (r["bucket"] - 1) * 4096
        if r["bucket"] > 0:
            out[at : at + len(raw)] = raw
        else:  # bit 0 alone
            out[-1] = 1
    return out


def _may_hold(bitmap: np.ndarray, size: int, seeds: np.ndarray) -> np.ndarray:
    def hit(bit: np.ndarray) -> np.ndarray:
        place = bit - 1
        found = bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1
        return np.where(bit == 0, bitmap[-1] == 1, found)

    return hit((seeds >> U64(38)).astype(np.int64) % size) & hit((seeds & U64(size - 1)).astype(np.int64))


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, n_words, words, seeds): hashes of the words and seeds of each row that has a seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = ByteRule(PUNCTUATED)
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            words, _, _, at = word_hashes(data, offsets, rule)
            own = [words[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            keep = [i for i, w in enumerate(own) if len(w) >= MIN_MATCH]
            yield pa.record_batch(
                [batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64())), pa.array([len(own[i]) for i in keep], pa.int64()), pa.array([own[i].tobytes() for i in keep], pa.binary()), pa.array([grams(own[i], MIN_MATCH).view(np.int64) for i in keep], pa.list_(pa.int64()))],
                names=["item", "item_id", "n_words", "words", "seeds"],
            )

    kind = benchmark.schema[id_col].dataType.simpleString()
    rows = benchmark.select(F.monotonically_increasing_id().alias("item"), benchmark[id_col].alias("item_id"), benchmark[text_col].cast("string").alias("text")).where("item_id is not null and text is not null")
    return rows.mapInArrow(lambda batches: released(run(batches)), f"item long, item_id {kind}, n_words long, words binary, seeds array<long>")


def _reduced(docs: DataFrame, bitmap: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, places, words, seeds): of rows with runs of words that may be seeds, the places and hashes of the words of these runs, and the runs' hashes."""

    size = SEED_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = ByteRule(PUNCTUATED)
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            for lo, hi in runs(offsets):
                part = data[offsets[lo] : offsets[hi]]
                hashes, _, _, at = word_hashes(part, offsets[lo : hi + 1] - offsets[lo], rule)
                if len(hashes) < MIN_MATCH:
                    continue
                keys = grams(hashes, MIN_MATCH)
                hits = np.flatnonzero(_may_hold(bitmap, size, keys))
                row = np.searchsorted(at, hits, "right") - 1
                inside = hits + MIN_MATCH <= at[row + 1]
                hits, row = hits[inside], row[inside]
                if not len(hits):
                    continue
                own, first = np.unique(row, return_index=True)
                places, words, seeds = [], [], []
                for r, some in zip(own.tolist(), np.split(hits, first[1:]), strict=True):
                    kept = np.unique(some[:, None] + np.arange(MIN_MATCH))
                    places.append((kept - at[r]).astype("<i4").tobytes())
                    words.append(hashes[kept].tobytes())
                    seeds.append(np.unique(keys[some]).view(np.int64))
                took = pa.array(lo + own)
                yield pa.record_batch([batch.column(0).take(took), batch.column(1).take(took), pa.array(places, pa.binary()), pa.array(words, pa.binary()), pa.array(seeds, pa.list_(pa.int64()))], names=["row", "doc_id", "places", "words", "seeds"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: released(run(batches)), f"row long, doc_id {kind}, places binary, words binary, seeds array<long>")


def overlaps(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item, n_words, n_covered, coverage) of every pair whose coverage reaches the limit.

    One narrow pass over the texts; what it keeps is cut from the lineage and joined.
    Null or empty texts, null items and items of fewer than MIN_MATCH words match
    nothing; words are cut at ASCII blanks and punctuation, so a text without
    them is one word.  Repeated rows of either side give a row each.  Other columns are
    not read.  An empty table gives no rows.
    """
    if not 0 < coverage <= 1:
        raise ValueError("coverage must lie in (0, 1]")
    items = cut(_items(benchmark, item_col, item_text_col))
    seeds = items.select("item", "n_words", F.explode("seeds").alias("seed"))
    reduced = cut(_reduced(docs, _bitmap(seeds), id_col, text_col))
    found = reduced.select("row", F.explode("seeds").alias("seed"))
    # how often seeds occur decides which are posted; one that no document holds is the rarest
    often = found.groupBy("seed").agg(F.count("*").alias("often"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.coalesce("often", F.lit(0)), "seed"))
    most = F.udf(lambda n: n - MIN_MATCH + 1 - least_seeds(n, coverage) + 1, "long")
    sizes = items.select("n_words").distinct().withColumn("posted", most("n_words"))
    posted = seeds.join(often, "seed", "left").withColumn("rank", rank).join(sizes, "n_words").where("rank <= posted and often is not null").select("seed", "item").distinct()
    pairs = found.join(posted, "seed").select("row", "item").distinct()
    met = pairs.join(reduced.select("row", "doc_id", "places", F.col("words").alias("text")), "row").join(items.select("item", "item_id", "words"), "item")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, size, covered = [], [], []
            for i, (places, text, words) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 4)), strict=True)):
                item = np.frombuffer(words, dtype=np.uint64)
                n = sum(k for _, _, k in tiles(item, _seed_runs(np.frombuffer(places, dtype="<i4"), np.frombuffer(text, dtype=np.uint64), np.unique(grams(item, MIN_MATCH)))))
                if n >= coverage * len(item):
                    keep.append(i)
                    size.append(len(item))
                    covered.append(n)
            took = pa.array(keep, pa.int64())
            share = np.round(np.array(covered, dtype=np.float64) / np.maximum(np.array(size, dtype=np.float64), 1), 6)
            yield pa.record_batch([batch.column(0).take(took), batch.column(3).take(took), pa.array(size, pa.int64()), pa.array(covered, pa.int64()), pa.array(share)], names=["doc", "item", "n_words", "n_covered", "coverage"])

    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    out = met.select("doc_id", "places", "text", "item_id", "words").mapInArrow(lambda batches: released(run(batches)), f"doc {kind}, item {item_kind}, n_words long, n_covered long, coverage double")
    return out.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "n_words", "n_covered", "coverage")


def _seed_runs(places: np.ndarray, words: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Of kept words, those in runs that are seeds, runs that don't touch set apart by a word that occurs nowhere."""
    own = grams(words, MIN_MATCH)
    starts = np.flatnonzero((places[MIN_MATCH - 1 :] - places[: len(own)] == MIN_MATCH - 1) & np.isin(own, seeds))
    if not len(starts):
        return words[:0]
    out = []
    for i, run in enumerate(np.split(starts, np.flatnonzero((np.diff(starts) > MIN_MATCH) | (np.diff(places[starts]) != np.diff(starts))) + 1)):
        out += [words[run[0] : run[-1] + MIN_MATCH], np.array([i + 1], dtype=np.uint64)]
    return np.concatenate(out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, id_col: str = "doc_id", **names) -> DataFrame:
    """The rows of docs, all columns, without those that hold an item of the benchmark; rows with a null id stay."""
    leaks = overlaps(docs, benchmark, coverage, id_col, **names).select(id_col).distinct()
    return docs.join(leaks, id_col, "left_anti").select(docs.columns)
