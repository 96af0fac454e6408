"""Suffix-array dedup: remove every byte in a long string that also starts earlier.

1. Sampling.  Of the GRAM-byte strings in a window of `length` bytes, the one with
   the least hash is the window's anchor; equal windows have equal anchors.  The
   windows of one anchor, a run of adjacent starts, form a block; its context is
   every byte they cover.  Before anything is sorted, copies of a context are put
   together, first among the rows a task has, then over all, so that a common
   passage costs one record a task: the earliest stands for them and the others,
   which repeat as a whole, are removed.  Copies that a task has together are compared
   byte by byte, those of different tasks by 128 bits of hash.
2. Blocks whose anchor occurs in other contexts too may share some windows with
   them.  Their contexts go to shards, sets of anchors; the windows of an anchor
   with more than SPLIT_CONTEXTS contexts are dealt out one by one, by a hash of their
   bytes, so no shard has to hold it.  External induced sorting gives a
   shard's suffixes in order with their common prefixes; runs with common prefixes of
   `length` or more are equal windows, of which all but the earliest are removed.
   So hashes only say where windows meet, the sort says whether they are equal.
3. The removed ranges meet the texts again, and each text is cut.

Between tasks go packed arrays, a few rows for each task and bucket, not a row for each string.
The number of buckets follows the bytes of the corpus, so that what a task holds does not.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkloom.llm.common import U64, buffers, cut, mix, random_words, released
from inkloom.llm.induced_sort import CAP, suffix_blocks

GRAM = 24
#: Bytes of text that a task samples at once, and whose blocks it compares before they go out.
SAMPLE = 1 << 20
SLAB = 6 << 20
#: Bytes of contexts that one suffix sort takes; its queues hold far less and go to disk.
SHARD = 3 << 20
#: Contexts of an anchor that go to one shard.
SPLIT_CONTEXTS = 1 << 16
#: Bytes of the corpus for each bucket, and the bits that tell places in a slab.
BUCKET_BYTES = 16 << 20
PLACE_BITS = 31
#: Stands for a null id; null ids come first.
NULL_ID = -(1 << 63)
_VALUE = random_words(41, 256)
_STEP = random_words(42, 64) | U64(1)
WINDOW = 100


def _prime(n: int) -> int:
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _doubles(data: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of the strings of 4, 8, ... 64 bytes from each position; too short ones at the end are void."""
    out, h, k = {}, _VALUE[data], 1
    while k < 64:
        nxt = np.zeros_like(h)
        nxt[: max(len(h) - k, 0)] = h[: max(len(h) - k, 0)] * _STEP[k] + h[k:]
        h, k = nxt, 2 * k
        if k >= 4:
            out[k] = h
    return out


def _joined(parts: dict[int, np.ndarray], at: np.ndarray | slice, sizes: list[int], n: int) -> np.ndarray:
    """Hash of the string made of adjacent pieces of the given sizes, from each position."""
    total = None
    pos = np.arange(n) if isinstance(at, slice) else at
    for k in sizes:
        piece = parts[k][np.minimum(pos, n - 1)]
        total = piece if total is None else mix(total) * _STEP[k - 1] + piece
        pos = pos + k
    return mix(total)


def _pieces(length: int) -> list[int]:
    out = [64] * (length // 64)
    rest = length % 64
    for k in (32, 16, 8, 4):
        if rest >= k:
            out.append(k)
            rest -= k
    if rest:
        raise ValueError("length must be a multiple of 4 and at least GRAM + 8")
    return out


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of w adjacent values from each position."""
    out, k = x, 1
    while 2 * k <= w:
        out = np.minimum(out[:-k], out[k:])
        k *= 2
    return np.minimum(out[: len(x) - w + 1], out[w - k : w - k + len(x) - w + 1]) if k < w else out


def _pack(*columns: np.ndarray) -> bytes:
    """Arrays of one length; integers are kept as differences, hashes as they are."""
    head = np.array([len(columns[0]), len(columns)], dtype="<i8").tobytes() + "".join(c.dtype.str[1:].ljust(4) for c in columns).encode()
    body = b"".join((c if c.dtype == np.uint64 else np.diff(c, prepend=c.dtype.type(0))).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(head + body)


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=1 << 31)
    n, k = np.frombuffer(raw[:16], dtype="<i8").tolist()
    at, out = 16 + 4 * k, []
    for i in range(k):
        kind = np.dtype("<" + raw[16 + 4 * i : 20 + 4 * i].decode().strip())
        c = np.frombuffer(raw, dtype=kind, count=n, offset=at)
        at += n * kind.itemsize
        out.append(c if kind == np.uint64 else np.cumsum(c, dtype=kind))
    return out


def _merged(blobs: list[bytes]) -> list[np.ndarray]:
    parts = [_unpack(b) for b in blobs]
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def _by_bucket(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
    columns = [c[order] for c in columns]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        if hi > lo:
            yield int(bucket[lo]), _pack(*(c[lo:hi] for c in columns))


#: Rows between tasks: what they are, whither they go, and the arrays.
_ROWS = "kind int, bucket int, payload binary"
BLOCKS, MARKS, WANTED, CONTEXTS, TEXT = 0, 1, 2, 3, 4


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["kind", "bucket", "payload"])


def _mark_rows(doc: np.ndarray, tag: np.ndarray, lo: np.ndarray, size: np.ndarray, buckets: int) -> list[tuple[int, int, bytes]]:
    """Removed ranges, on their way to the texts."""
    if not len(doc):
        return []
    order = np.lexsort((lo, tag, doc))
    doc, tag, lo, size = doc[order], tag[order], lo[order], size[order]
    return [(MARKS, b, x) for b, x in _by_bucket(doc % buckets, [doc, tag, lo.astype(np.int64), size.astype(np.int32)])]


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, bytes and offsets of rows, about SAMPLE bytes at a time."""
    ids, parts, sizes, held = [], [], [], 0

    def slab():
        return np.concatenate(ids), np.concatenate(parts), np.append(0, np.cumsum(np.concatenate(sizes)))

    for batch in batches:
        doc = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        data, offsets = buffers(batch.column(1))
        lo = 0
        while lo < len(doc):
            hi = min(len(doc), max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SAMPLE - held, side="right")) - 1))
            ids.append(doc[lo:hi])
            parts.append(data[offsets[lo] : offsets[hi]])
            sizes.append(np.diff(offsets[lo : hi + 1]))
            held += int(offsets[hi] - offsets[lo])
            lo = hi
            if held >= SAMPLE:
                yield slab()
                ids, parts, sizes, held = [], [], [], 0
    if ids:
        yield slab()


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the strings of these sizes at two places are equal; one of size 0 is not."""
    out = size > 0
    total = np.cumsum(size)
    lo = 0
    while lo < len(size):  # about a million bytes at a time
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + (1 << 20), "right")))
        n = size[lo:hi]
        some = np.flatnonzero(n)
        if len(some):
            ends = np.cumsum(n[some])
            within = np.arange(ends[-1]) - np.repeat(ends - n[some], n[some])
            equal = data[np.repeat(a[lo:hi][some], n[some]) + within] == data[np.repeat(b[lo:hi][some], n[some]) + within]
            out[lo + some] = np.logical_and.reduceat(equal, ends - n[some])
        lo = hi
    return out


def _sampled(length: int, buckets: int):
    """Blocks of all windows, without those that repeat as a whole within a slab, which are marked."""
    pieces, gram_pieces, w = _pieces(length), _pieces(GRAM), length - GRAM + 1

    def blocks(doc: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Anchor's hash, context's hash, id, tag, first window, windows after it and place in the data of each block."""
        n = len(data)
        sizes = np.diff(offsets)
        tags = np.array([zlib.crc32(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], dtype=np.int64)
        parts = _doubles(data)
        gram = _joined(parts, slice(None), gram_pieces, n)
        # the same bits of the hash decide in every slab, so equal windows have equal anchors wherever they are
        best = _window_min((gram >> U64(PLACE_BITS) << U64(PLACE_BITS)) | np.arange(n, dtype=np.uint64), w)
        # starts of windows, document by document
        count = np.maximum(sizes - length + 1, 0)
        total = int(count.sum())
        start = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(offsets[:-1], count)
        anchor = (best[start] & U64((1 << PLACE_BITS) - 1)).astype(np.int64)
        row = np.repeat(np.arange(len(doc)), count)
        head = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]))
        lo, hi, q, row = start[head], start[np.append(head[1:], total) - 1], anchor[head], row[head]
        whole = mix(_joined(parts, lo, pieces, n)) * _STEP[1] + _joined(parts, hi, pieces, n)
        context = mix(mix(whole) + (hi - lo).astype(np.uint64) * _STEP[2] + (q - lo).astype(np.uint64) * _STEP[3])
        return [gram[q], context, doc[row], tags[row], lo - offsets[row], (hi - lo).astype(np.int32), lo]

    def sent(held: list[list[np.ndarray]], texts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        data = np.concatenate(texts)
        begin = np.cumsum([0, *map(len, texts[:-1])])
        core, context, doc, tag, lo, span, at = (np.concatenate(c) for c in zip(*held, strict=True))
        at = at + np.repeat(begin, [len(h[0]) for h in held])
        order = np.lexsort((lo, tag, doc, context, core))
        core, context, doc, tag, lo, span, at = (c[order] for c in (core, context, doc, tag, lo, span, at))
        again = np.append(False, (core[1:] == core[:-1]) & (context[1:] == context[:-1]))
        first = np.maximum.accumulate(np.where(again, 0, np.arange(len(again))))
        copies = np.flatnonzero(again)
        other = copies[~_same_bytes(data, at[copies], at[first[copies]], np.where(span[copies] == span[first[copies]], span[copies] + length, 0))]
        again[other] = False  # equal hashes only: no copy, so the sort decides
        context[other] = mix(context[other] + other.astype(np.uint64) + U64(1))
        out = _mark_rows(doc[again], tag[again], lo[again], span[again] + length, buckets)
        keep = np.flatnonzero(~again)
        keep = keep[np.lexsort((lo[keep], tag[keep], doc[keep]))]
        cols = [c[keep] for c in (core, context, doc, tag, lo, span)]
        out += [(BLOCKS, b, x) for b, x in _by_bucket((cols[0] % U64(buckets)).astype(np.int64), cols)]
        for at in range(0, len(out), 64):
            yield _batch(out[at : at + 64])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts, size = [], [], 0
        for doc, data, offsets in _slabs(batches):
            if (np.diff(offsets) >= length).any():
                held.append(blocks(doc, data, offsets))
                texts.append(data)
            size += len(data)
            if size >= SLAB:
                yield from sent(held, texts)
                held, texts, size = [], [], 0
        yield from sent(held, texts)

    return lambda batches: released(run(batches))


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes]]]:
    """(bucket, kind, payloads) of rows that come sorted by bucket and kind."""
    now, held = None, []
    for batch in batches:
        for kind, bucket, payload in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if now != (bucket, kind) and held:
                yield (*now, held)
                held = []
            now = bucket, kind
            held.append(payload)
    if held:
        yield (*now, held)


def _resolved(length: int, buckets: int, split: int):
    """Of the blocks of a bucket: marks for contexts that an earlier block has, and wanted texts of anchors with several contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, kind, blobs in _gather(batches):
            if kind == MARKS:
                yield _batch([(MARKS, bucket, b) for b in blobs])
                continue
            core, context, doc, tag, lo, span = _merged(blobs)
            order = np.lexsort((lo, tag, doc, context, core))
            core, context, doc, tag, lo, span = (c[order] for c in (core, context, doc, tag, lo, span))
            again = np.append(False, (core[1:] == core[:-1]) & (context[1:] == context[:-1]))
            out = _mark_rows(doc[again], tag[again], lo[again], span[again] + length, buckets)
            core, doc, tag, lo, span = (c[~again] for c in (core, doc, tag, lo, span))
            first = np.flatnonzero(np.append(True, core[1:] != core[:-1]))
            many = np.diff(np.append(first, len(core)))
            contexts = np.repeat(many, many)
            pick = np.flatnonzero(contexts > 1)
            pick = pick[np.lexsort((lo[pick], tag[pick], doc[pick]))]
            if len(pick):
                cols = [core[pick], doc[pick], tag[pick], lo[pick], span[pick], (contexts[pick] > split).astype(np.int32)]
                out += [(WANTED, b, x) for b, x in _by_bucket(cols[1] % buckets, cols)]
            for at in range(0, len(out), 64):
                yield _batch(out[at : at + 64])

    return lambda batches: released(run(batches))


def _cut_contexts(length: int, buckets: int):
    """Wanted contexts out of the texts of a bucket, for the shards; single windows where an anchor is split."""
    pieces = _pieces(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, wanted, held, size = None, None, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            cols = [np.concatenate(c) for c in list(zip(*held, strict=True))[:5]]
            texts = [t for h in held for t in h[5]]
            bucket = (cols[0] % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rows = []
            edges = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part = order[a:b]
                blob = _pack(*(c[part] for c in cols))
                text = zstandard.ZstdCompressor(level=1).compress(b"".join(texts[i] for i in part))
                rows.append((CONTEXTS, int(bucket[order[a]]), len(blob).to_bytes(4, "little") + blob + text))
            held.clear()
            for at in range(0, len(rows), 64):
                yield _batch(rows[at : at + 64])

        for batch in batches:
            for kind, bucket, payload, doc, text in zip(*(batch.column(i) for i in range(5)), strict=True):
                kind, bucket = kind.as_py(), bucket.as_py()
                if kind == WANTED:
                    if now != bucket:
                        now, wanted = bucket, []
                    wanted.append(payload.as_py())
                    continue
                if now != bucket or wanted is None:
                    continue
                if isinstance(wanted, list):
                    core, own, tag, lo, span, split = _merged(wanted)
                    order = np.argsort(own, kind="stable")
                    wanted = core[order], own[order], tag[order], lo[order], span[order], split[order]
                core, own, tag, lo, span, split = wanted
                a, b = np.searchsorted(own, doc.as_py(), "left"), np.searchsorted(own, doc.as_py(), "right")
                if a == b:
                    continue
                raw = text.as_py()
                at = a + np.flatnonzero(tag[a:b] == zlib.crc32(raw))
                whole, single = at[split[at] == 0], at[split[at] == 1]
                if len(whole):
                    held.append((core[whole], own[whole], tag[whole], lo[whole], span[whole], [raw[x : x + s + length] for x, s in zip(lo[whole].tolist(), span[whole].tolist(), strict=True)]))
                    size += int(span[whole].sum()) + length * len(whole)
                for i in single.tolist():
                    part = np.frombuffer(raw, dtype=np.uint8)[lo[i] : lo[i] + span[i] + length]
                    starts = np.arange(span[i] + 1)
                    print_ = _joined(_doubles(part), starts, pieces, len(part))
                    k = len(starts)
                    # the key of a window is its own hash, so equal windows meet
                    held.append((print_, np.full(k, own[i]), np.full(k, tag[i]), lo[i] + starts, np.zeros(k, dtype=np.int32), [raw[x : x + length] for x in (lo[i] + starts).tolist()]))
                    size += length * k
                if size >= SLAB:
                    yield from flush()
                    size = 0
        yield from flush()

    return lambda batches: released(run(batches))


def _sorted(length: int, buckets: int, base: int | None, memory: int | None):
    """Marks for windows that an earlier context of the same shard has."""

    def marks(parts: list[np.ndarray], text: np.ndarray) -> list[tuple[int, int, bytes]]:
        _, doc, tag, lo, span = parts
        ends = np.cumsum(span.astype(np.int64) + length)
        begins = ends - span - length
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for order, common in suffix_blocks(text, ends, base, memory):
            equal = common >= length  # with the suffix before; what is too short for a window never is
            equal[0] = False
            some = np.flatnonzero(equal | np.append(equal[1:], False))
            owner = np.searchsorted(ends, order[some], "right")
            within = order[some] - begins[owner]
            group = np.cumsum(~equal)[some]
            keep = within <= span[owner]  # starts that are windows of the block itself
            owner, group = owner[keep], group[keep]
            start = lo[owner] + within[keep]
            rank = np.lexsort((start, tag[owner], doc[owner], group))
            later = rank[1:][group[rank][1:] == group[rank][:-1]]
            found.append((owner[later], start[later]))
        if not any(len(o) for o, _ in found):
            return []
        owner, start = (np.concatenate(c) for c in zip(*found, strict=True))
        # adjacent windows of a row make one range
        by = np.lexsort((start, tag[owner], doc[owner]))
        owner, start = owner[by], start[by]
        d, t = doc[owner], tag[owner]
        new = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (start[1:] > start[:-1] + 1))) if len(d) else np.zeros(0, dtype=np.int64)
        last = np.append(new[1:], len(d)) - 1 if len(d) else new
        return _mark_rows(d[new], t[new], start[new], start[last] - start[new] + length, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, blobs in _gather(batches):
            cols, texts = [], []
            for blob in blobs:
                n = int.from_bytes(blob[:4], "little")
                cols.append(_unpack(blob[4 : 4 + n]))
                texts.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[4 + n :], max_output_size=1 << 31), dtype=np.uint8))
            parts, text = [np.concatenate(c) for c in zip(*cols, strict=True)], np.concatenate(texts)
            size = parts[4].astype(np.int64) + length
            begin = np.cumsum(size) - size
            order = np.argsort(parts[0], kind="stable")  # an anchor's contexts together
            core, many = np.unique(parts[0][order], return_counts=True)
            single = np.repeat(many == 1, many)
            order = order[~single]
            core = parts[0][order]
            first = np.flatnonzero(np.append(True, core[1:] != core[:-1])) if len(core) else np.zeros(0, dtype=np.int64)
            mass = np.cumsum(size[order])
            lo = 0
            while lo < len(order):  # whole anchors, about SHARD bytes at a time
                done = mass[lo - 1] if lo else 0
                hi = int(np.searchsorted(mass, done + SHARD, "right"))
                at = np.searchsorted(first, hi, "right") - 1
                hi = len(order) if hi >= len(order) else int(first[at]) if first[at] > lo else int(first[at + 1]) if at + 1 < len(first) else len(order)
                pick = order[lo:hi]
                where = np.repeat(begin[pick], size[pick]) + np.arange(size[pick].sum()) - np.repeat(np.cumsum(size[pick]) - size[pick], size[pick])
                rows = marks([c[pick] for c in parts], text[where])
                if rows:
                    yield _batch(rows)
                lo = hi

    return lambda batches: released(run(batches))


def _spans(lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of ranges."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate((lo + size)[order])
    new = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
    return lo[new], hi[np.append(new[1:], len(lo)) - 1]


def _joined_with_texts(rows: DataFrame, docs: DataFrame, buckets: int, by: list, id_col: str, text_col: str, rest: list[str]) -> DataFrame:
    """Packed rows and texts of a bucket in one partition, the packed rows first."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    other = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("struct<_:int>")
    texts = docs.select(F.lit(TEXT).alias("kind"), F.pmod(key, F.lit(buckets)).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("payload"), key.alias("doc"), raw.alias("raw"), other.alias("rest"))
    marks = rows.select("kind", "bucket", "payload", F.lit(None).cast("long").alias("doc"), F.lit(None).cast("binary").alias("raw"), F.lit(None).cast(texts.schema["rest"].dataType).alias("rest"))
    return marks.unionByName(texts).repartition(*by).sortWithinPartitions("bucket", "kind")


def removed(docs: DataFrame, length: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, split_contexts: int = SPLIT_CONTEXTS, base: int | None = None, memory: int | None = None) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of each row; with `carry` also the ranges, what is kept as text, by whole characters, and a struct `rest` of the other columns.

    A byte goes if a string of `length` bytes that covers it also starts earlier: in a
    row with a smaller id, or before it in the same row.  Strings are judged on
    the input and never cross rows.  A null text counts as empty; texts shorter
    than `length` stay whole.  Null ids come first; rows that share an id come in
    order of a checksum of their text, and rows that are equal in both count as
    one.  Columns of other names are not read unless carried.
    """
    if length > CAP or length < GRAM + 8:
        raise ValueError(f"length must lie between {GRAM + 8} and {CAP}")
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    buckets = _prime(max(4 * partitions + 1, size // BUCKET_BYTES))
    # the session's own number of partitions, which may be adapted at run time, as long as it is enough
    by = [F.col("bucket")] if size // BUCKET_BYTES <= 4 * partitions else [buckets // 4, F.col("bucket")]
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))
    texts = docs.select(key.alias("doc"), F.col(text_col).cast("string").alias("text"))
    blocks = texts.mapInArrow(_sampled(length, buckets), _ROWS)
    found = cut(blocks.repartition(*by).sortWithinPartitions("bucket", "kind").mapInArrow(_resolved(length, buckets, split_contexts), _ROWS))
    wanted = _joined_with_texts(found.where(f"kind = {WANTED}"), docs, buckets, by, id_col, text_col, [])
    contexts = wanted.select("kind", "bucket", "payload", "doc", "raw").mapInArrow(_cut_contexts(length, buckets), _ROWS)
    shards = contexts.repartition(*by).sortWithinPartitions("bucket", "kind").mapInArrow(_sorted(length, buckets, base, memory), _ROWS)
    marks = cut(found.where(f"kind = {MARKS}").unionByName(shards))
    rest = [c for c in docs.columns if c not in (id_col, text_col)] if carry else []
    met = _joined_with_texts(marks, docs, buckets, by, id_col, text_col, rest)
    kind = docs.schema[id_col].dataType.simpleString()
    fields = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema = T._parse_datatype_string(fields)
    if carry:
        schema = schema.add("spans", T.ArrayType(T.LongType())).add("kept", T.StringType()).add("rest", met.schema["rest"].dataType)
    out = met.mapInArrow(_finished(carry), schema)
    named = F.when(F.col("doc") == NULL_ID, None).otherwise(F.col("doc")).cast(kind).alias(id_col)
    return out.select(named, *[c for c in out.columns if c != "doc"])


def _without(text: bytes, ranges: list[int]) -> bytes:
    """The text without the ranges, each shrunk to whole characters."""
    kept, at = [], 0
    for x, y in zip(ranges[::2], ranges[1::2], strict=True):
        while x < y and text[x] & 0xC0 == 0x80:
            x += 1
        while y > x and y < len(text) and text[y] & 0xC0 == 0x80:
            y -= 1
        kept.append(text[at:x])
        at = y
    return b"".join([*kept, text[at:]])


def _finished(carry: bool):
    """Texts of a bucket without the marked ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, marks = None, []
        for batch in batches:
            rows: list[tuple] = []
            places = []
            kinds, buckets = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, (kind, bucket) in enumerate(zip(kinds, buckets, strict=True)):
                if kind == MARKS:
                    if now != bucket:
                        now, marks = bucket, []
                    marks.append(batch.column(2)[i].as_py())
                    continue
                if now != bucket:
                    now, marks = bucket, []
                if isinstance(marks, list):
                    doc, tag, lo, size = _merged(marks) if marks else (np.zeros(0, dtype=np.int64),) * 4
                    order = np.argsort(doc, kind="stable")
                    marks = doc[order], tag[order], lo[order], size[order].astype(np.int64)
                doc, tag, lo, size = marks
                own, raw = batch.column(3)[i].as_py(), batch.column(4)[i].as_py()
                a, b = np.searchsorted(doc, own, "left"), np.searchsorted(doc, own, "right")
                spans: list[int] = []
                kept = whole = raw
                if b > a:
                    at = a + np.flatnonzero(tag[a:b] == zlib.crc32(raw))
                    if len(at):
                        first, last = _spans(lo[at], size[at])
                        spans = np.stack([first, last], axis=1).reshape(-1).tolist()
                        edges = [0, *spans, len(raw)]
                        kept = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                        whole = _without(raw, spans) if carry else raw
                rows.append((own, len(raw), len(raw) - len(kept), len(spans) // 2, hashlib.sha256(kept).hexdigest(), spans, whole if carry else None))
                places.append(i)
            if rows:
                cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)] + [pa.array([r[4] for r in rows], pa.string())]
                names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if carry:
                    at = pa.array(places, pa.int32())
                    cols += [pa.array([r[5] for r in rows], pa.list_(pa.int64())), pa.array([r[6].decode("utf-8", "replace") for r in rows], pa.string()), batch.column(5).take(at)]
                    names += ["spans", "kept", "rest"]
                yield pa.record_batch(cols, names=names)

    return lambda batches: released(run(batches))


def dedup(docs: DataFrame, length: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """The rows of docs, all columns, with repeated strings taken out of the text; whole characters only, so a removed range shrinks to them.

    count_col: a column of the number of characters, which is brought up to date.  A null text stays null.
    """
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    null = "_text_is_null"
    while null in docs.columns:
        null += "_"
    marked = docs.withColumn(null, F.col(text_col).isNull())
    found = removed(marked, length, id_col, text_col, carry=True)

    text = F.when(~F.col(f"rest.{null}"), F.col("kept"))
    out = found.select(F.col(id_col), text.alias(text_col), *[F.col(f"rest.`{c}`").alias(c) for c in rest])
    if count_col:
        out = out.withColumn(count_col, F.when(F.col(text_col).isNull(), F.col(count_col)).otherwise(F.length(text_col).cast(docs.schema[count_col].dataType)))
    return out.select(docs.columns)
