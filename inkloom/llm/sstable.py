"""Token ids in sorted-string-table shards.

A shard is one file, written by Spark, so it can lie on any file system that
Spark reaches.  Its layout, integers little-endian:

    data blocks     entries of (varint shared, varint rest, varint value length,
                    rest of the key, value); `shared` counts the bytes that the key
                    has in common with the key before it, 0 at a block's start
    block index     per block: key length u16, last key, offset u64, bytes u32, entries u32
    Bloom filter    bits of all keys
    footer          index offset u64, bytes u32; filter offset u64, bytes u32, hashes u16;
                    entries u64, tokens u64, id width u16; partition u32 and number in it u32,
                    which put the shards of a folder in order; first key length u16, first
                    key and last key length u16, last key; footer bytes u32, magic

Keys are a null mark and the id as 8 big-endian bytes with its sign bit turned,
so byte order is id order and null comes first.  Values are ids of `width`
bytes: 2 where the vocabulary allows, else 4.  The magic ends in a line feed
because Spark's text writer, which takes the bytes of a shard as one line,
ends the file with one.
"""

from __future__ import annotations

import gc
import json
import re
import struct
import uuid
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from inkloom.llm.common import cut

MAGIC = b"INKSST1\n"
BLOCK_TARGET = 16 << 10
BLOOM_BITS_PER_KEY = 10
BLOOM_HASHES = 7
#: Ids of a shard, as bytes; a task goes on to another shard beyond it.
SHARD_TARGET = 64 << 20
#: Matches of a generation of a worker's memory; it keeps two, so frequent ones survive.
CACHE_ENTRIES = 500_000
CACHE_CHARS = 64
#: Bytes of text whose distinct matches are looked up together.
ENCODE_BYTES = 6 << 20


def key_of(doc_id: int | None) -> bytes:
    return b"\0" if doc_id is None else b"\1" + struct.pack(">Q", (doc_id + (1 << 63)) & (1 << 64) - 1)


def id_of(key: bytes) -> int | None:
    return None if key == b"\0" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _halves(key: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(key)
    return h & (1 << 64) - 1, h >> 64 | 1


def _bits(key: bytes, n_bits: int) -> list[int]:
    """Places of a key in the filter; sums wrap at 64 bits."""
    a, b = _halves(key)
    return [((a + i * b) & (1 << 64) - 1) % n_bits for i in range(BLOOM_HASHES)]


_FOOTER = "<QIQIHQQHII"
#: Bytes at a shard's end that are read at once; footers are shorter.
TAIL = 4096


class Writer:
    """Builds one shard from entries in key order; `place` is its partition and its number in it."""

    def __init__(self, width: int, place: tuple[int, int] = (0, 0)):
        self.width, self.place, self.body, self.index, self.keys = width, place, bytearray(), [], []
        self.tokens, self.block, self.block_at, self.block_n, self.previous = 0, 0, 0, 0, b""

    def add(self, key: bytes, ids: np.ndarray) -> None:
        if self.keys and key < self.keys[-1]:
            raise ValueError("entries must come in key order")
        shared = 0
        if self.block_n:
            while shared < min(len(key), len(self.previous)) and key[shared] == self.previous[shared]:
                shared += 1
        value = ids.astype("<u2" if self.width == 2 else "<u4").tobytes()
        self.body += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:]
        self.body += value
        self.tokens += len(ids)
        self.keys.append(key)
        self.previous, self.block_n = key, self.block_n + 1
        if len(self.body) - self.block_at >= BLOCK_TARGET:
            self._end_block()

    def _end_block(self) -> None:
        if self.block_n:
            self.index.append((self.previous, self.block_at, len(self.body) - self.block_at, self.block_n))
        self.block_at, self.block_n = len(self.body), 0

    def finish(self) -> bytes:
        self._end_block()
        index_at = len(self.body)
        for key, at, size, n in self.index:
            self.body += struct.pack("<H", len(key)) + key + struct.pack("<QII", at, size, n)
        bloom_at = len(self.body)
        bits = np.zeros(max(64, BLOOM_BITS_PER_KEY * len(self.keys) + 7 & ~7), dtype=bool)
        if self.keys:
            digests = np.array([_halves(key) for key in dict.fromkeys(self.keys)], dtype=np.uint64)
            for i in range(BLOOM_HASHES):
                bits[(digests[:, 0] + np.uint64(i) * digests[:, 1]) % np.uint64(len(bits))] = True
        self.body += np.packbits(bits, bitorder="little").tobytes()
        first, last = (self.keys[0], self.keys[-1]) if self.keys else (b"", b"")
        footer = struct.pack(_FOOTER, index_at, bloom_at - index_at, bloom_at, len(self.body) - bloom_at, BLOOM_HASHES, len(self.keys), self.tokens, self.width, *self.place)
        footer += struct.pack("<H", len(first)) + first + struct.pack("<H", len(last)) + last
        self.body += footer + struct.pack("<I", len(footer)) + MAGIC
        return bytes(self.body)


class Reader:
    """Look-up and scan; of a file the footer is read first, then only the parts that are asked for."""

    def __init__(self, data: bytes | None = None, read: Callable[[int, int], bytes] | None = None, size: int = 0):
        """data: a whole shard; or read(offset, bytes) and the size of one."""
        if data is not None:
            view, size = memoryview(data), len(data)
            read = lambda at, n: view[at : at + n]
        self.read, self._index, self._bloom = read, None, None
        tail = bytes(read(max(0, size - TAIL), min(size, TAIL)))
        if tail[-len(MAGIC) :] != MAGIC:
            raise ValueError("not a shard: magic is missing")
        end = len(tail) - len(MAGIC) - 4
        at = end - struct.unpack_from("<I", tail, end)[0]
        self.index_at, self.index_size, self.bloom_at, self.bloom_size, _, self.entries, self.tokens, self.width, *place = struct.unpack_from(_FOOTER, tail, at)
        self.place = tuple(place)
        at += struct.calcsize(_FOOTER)
        (n,) = struct.unpack_from("<H", tail, at)
        self.first = tail[at + 2 : at + 2 + n]
        at += 2 + n
        (n,) = struct.unpack_from("<H", tail, at)
        self.last = tail[at + 2 : at + 2 + n]

    @property
    def index(self) -> list[tuple[bytes, int, int, int]]:
        if self._index is None:
            raw, at, self._index = bytes(self.read(self.index_at, self.index_size)), 0, []
            while at < len(raw):
                (n,) = struct.unpack_from("<H", raw, at)
                self._index.append((raw[at + 2 : at + 2 + n], *struct.unpack_from("<QII", raw, at + 2 + n)))
                at += 2 + n + 16
        return self._index

    def block(self, number: int) -> Iterator[tuple[bytes, np.ndarray]]:
        _, start, size, _ = self.index[number]
        data, at, key = self.read(start, size), 0, b""
        while at < size:
            shared, at = _read_varint(data, at)
            rest, at = _read_varint(data, at)
            length, at = _read_varint(data, at)
            key = key[:shared] + bytes(data[at : at + rest])
            at += rest
            yield key, np.frombuffer(data[at : at + length], dtype="<u2" if self.width == 2 else "<u4")
            at += length

    def scan(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for i in range(len(self.index)):
            yield from self.block(i)

    def may_hold(self, key: bytes) -> bool:
        if not self.first <= key <= self.last:
            return False
        if self._bloom is None:
            self._bloom = bytes(self.read(self.bloom_at, self.bloom_size))
        return all(self._bloom[b >> 3] >> (b & 7) & 1 for b in _bits(key, self.bloom_size * 8))

    def get(self, key: bytes) -> list[np.ndarray]:
        """Values of a key, by key range, Bloom filter, binary search in the block index and a scan of its blocks."""
        out: list[np.ndarray] = []
        if not self.entries or not self.may_hold(key):
            return out
        i = bisect_left(self.index, key, key=lambda entry: entry[0])
        while i < len(self.index):
            for k, ids in self.block(i):
                if k == key:
                    out.append(ids)
                elif k > key:
                    return out
            i += 1
        return out


class PieceEncoder:
    """Ids of whole texts by the tokenizers library, asked once for each distinct piece.

    Where the tokenizer's own settings say that it normalises by NFC, single
    blanks and lower case and then keeps only the matches of one pattern, none of
    which holds white space, the ids of a text are those of its blank-free pieces in
    turn, and those of a piece are those of its matches.  Pieces and matches are
    remembered.  A piece is cut into matches here only if it is printable Latin
    (below U+0250), where NFC changes nothing and lower case does not depend on
    neighbours; a text that is all printable Latin is cut into matches at once.
    Other pieces go to the library whole, and so do whole texts where the settings
    are different.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.kind, self.code = ("<u2", "H") if self.width == 2 else ("<u4", "I")
        self.pattern = self._pattern(json.loads(self.tokenizer.to_str()))
        self.plain = re.compile(r"[\n -~\u00a1-\u024f]*")
        self.latin = None if self.pattern is None else re.compile(self._on_latin(self.pattern.pattern))
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}

    @staticmethod
    def _pattern(settings: dict) -> regex.Pattern | None:
        normal = [x.get("type") for x in (settings["normalizer"] or {}).get("normalizers", [])]
        before = (settings["pre_tokenizer"] or {}).get("pretokenizers", [])
        added = all(x["content"].startswith("<|") and not regex.search(r"\s", x["content"]) and not x["lstrip"] and not x["rstrip"] for x in settings["added_tokens"])
        if normal != ["NFC", "Replace", "Lowercase"] or [x.get("type") for x in before] != ["Split", "ByteLevel"] or not added:
            return None
        split, level = before
        if split["behavior"] != "Removed" or not split["invert"] or level["add_prefix_space"] or level["use_regex"]:
            return None
        return regex.compile(split["pattern"]["Regex"])

    @staticmethod
    def _on_latin(pattern: str) -> str:
        """The pattern with its classes spelled out below U+0250, for the faster matcher."""

        def spelled(name: str) -> str:
            return "".join(re.escape(chr(c)) for c in range(0x250) if regex.fullmatch(name, chr(c)))

        for name in (r"\p{L}", r"\p{N}", r"\s"):
            pattern = pattern.replace(name, spelled(name))
        return pattern

    def _is_plain(self, text: str) -> bool:
        return self.plain.fullmatch(text) is not None and "<|" not in text

    def _ask(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text."""
        for at in range(0, len(texts), 1024):
            for found in self.tokenizer.encode_batch_fast(texts[at : at + 1024], add_special_tokens=False):
                yield array(self.code, found.ids).tobytes()

    def _ask_matches(self, matches: list[str]) -> Iterator[bytes]:
        """Ids of each text that is one match of the pattern: many in one line, told apart by the library's word numbers."""
        for at in range(0, len(matches), 256):
            part = matches[at : at + 256]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = array(self.code, found.ids).tobytes()
            edge = (np.searchsorted(np.array(found.word_ids), np.arange(len(part) + 1)) * self.width).tolist()
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                yield ids[lo:hi]

    def _know(self, words: set[str]) -> list[str]:
        """Have the ids of these matches in memory; gives those that are too long to stay."""
        if len(self.words) > CACHE_ENTRIES:
            self.older_words, self.words = self.words, {}
        missing = words.difference(self.words)
        known = {w: self.older_words[w] for w in missing.intersection(self.older_words)}
        self.words.update(known)
        asked = list(missing.difference(known))
        self.words.update(zip(asked, self._ask_matches(asked), strict=True))
        return [w for w in asked if len(w) > CACHE_CHARS]

    def encode(self, texts: list[str | None], end: int | None) -> list[np.ndarray]:
        tail = b"" if end is None else np.array([end], dtype=self.kind).tobytes()
        if self.pattern is None:
            return [np.frombuffer(x + tail, dtype=self.kind) for x in self._ask([t or "" for t in texts])]
        collects = gc.isenabled()
        gc.disable()  # nothing here makes cycles, and the many strings are slow to look through
        try:
            return self._encoded(texts, tail)
        finally:
            if collects:
                gc.enable()

    def _encoded(self, texts: list[str | None], tail: bytes) -> list[np.ndarray]:
        find = self.latin.findall
        parts = [find(t.lower()) if t and self._is_plain(t) else None if t else [] for t in texts]
        mixed = {i: texts[i].replace("\n", " ").split(" ") for i, p in enumerate(parts) if p is None}
        pieces = set().union(*mixed.values())
        cut = {p: find(p.lower()) for p in pieces if self._is_plain(p)}
        other = list(pieces.difference(cut))
        long = self._know(set().union(*(p for p in parts if p is not None), *cut.values()))
        one = self.words.__getitem__
        known = {p: b"".join(map(one, c)) for p, c in cut.items()}
        known.update(zip(other, self._ask(other), strict=True))
        out = [np.frombuffer((b"".join(map(one, p)) if p is not None else b"".join(map(known.__getitem__, mixed[i]))) + tail, dtype=self.kind) for i, p in enumerate(parts)]
        for word in long:
            del self.words[word]
        return out


_LOADED: dict[str, PieceEncoder] = {}


def _load(path: str) -> PieceEncoder:
    if path not in _LOADED:
        _LOADED[path] = PieceEncoder(path)
    return _LOADED[path]


def write_shards(docs: DataFrame, path: str, out: str, end: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode every whole text and write shards to the folder `out`; gives `out` back.

    One range exchange brings the rows into order of id, then text, so shards
    don't overlap and rows that share an id are spread over partitions too; each
    shard says in its footer which partition it is from and its number in it.
    A null text counts as empty and gets only the end id; a null id sorts
    first; rows with the same id are kept, each an entry, in order of text.
    Other columns are not read.  No rows give no shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, partition, number = _load(path), TaskContext.get().partitionId(), 0
        writer, held = Writer(encoder.width, (partition, number)), 0
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                until = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + ENCODE_BYTES, side="right")))
                part, at = batch.slice(at, until - at), until
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist(), end), strict=True):
                    writer.add(key_of(doc_id), ids)
                    held += ids.nbytes
                if held > SHARD_TARGET:
                    full, number = writer.finish(), number + 1
                    yield pa.record_batch([pa.array([full[:-1]], pa.binary())], names=["value"])
                    writer, held = Writer(encoder.width, (partition, number)), 0
        if writer.keys:
            yield pa.record_batch([pa.array([writer.finish()[:-1]], pa.binary())], names=["value"])

    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    # the start of a text is in order with the text, and short enough for the sampled bounds
    ordered = rows.repartitionByRange("id", F.substring("text", 1, 16)).sortWithinPartitions("id", "text")
    shards = ordered.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    shards.write.option("maxRecordsPerFile", 1).option("compression", "none").text(out)
    return out


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(first, doc_id, n_tokens, ids_crc32, ids array<int>): the entries of all shards; `first` is the shard's first key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                reader = Reader(content.as_py())
                rows: list[tuple] = []
                for key, ids in reader.scan():
                    rows.append((reader.first, id_of(key), ids.astype(np.int32)))
                    if len(rows) == 256:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int32()))], names=["first", "doc_id", "ids"]
        )

    return _contents(spark, path).mapInArrow(run, "first binary, doc_id long, ids array<int>")


def _contents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def _files(spark: SparkSession, path: str) -> list[tuple[object, int]]:
    """Paths and sizes of the shards of a folder, in order of partition and number in it, as Spark's writer names them."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = []
    for status in folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder):
        if name := re.match(r"part-(\d+)-.*?(?:-c(\d+))?(?:\.txt)?$", status.getPath().getName()):
            found.append((int(name[1]), int(name[2] or 0), status.getPath(), status.getLen()))
    return [x[2:] for x in sorted(found, key=lambda x: x[:2])]


def _opened(spark: SparkSession, file: object, size: int) -> Reader:
    """A reader that fetches ranges of a file, from whatever file system holds it."""
    jvm = spark.sparkContext._jvm
    source = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def read(at: int, n: int) -> bytes:
        stream = source.open(file)
        try:
            stream.seek(at)
            return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, n))
        finally:
            stream.close()

    return Reader(read=read, size=size)


def look_up(spark: SparkSession, path: str, ids: list[int | None]) -> DataFrame:
    """(doc_id, ids) of the wanted ids, a list on the driver.

    A binary search over the footers of the files, which are in key order, finds
    the shards that may hold a key; of these the Bloom filter, the block index and
    one block are read.  No file is read as a whole.  An id that is not there
    gives no row, one that has several entries a row each.
    """
    files, known = _files(spark, path), {}

    def shard(i: int) -> Reader:
        if i not in known:
            known[i] = _opened(spark, *files[i])
        return known[i]

    rows = []
    for wanted in ids:
        key = key_of(wanted)
        i = bisect_left(range(len(files)), key, key=lambda i: shard(i).last)
        while i < len(files) and shard(i).first <= key:
            rows += [(wanted, x.astype(int).tolist()) for x in shard(i).get(key)]
            i += 1
    return spark.createDataFrame(rows, "doc_id long, ids array<int>")


def digest_shards(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every entry, read back from the files.

    Within a shard `start` is a running sum; the totals of the shards, one row
    each, are summed up within their partition, and those of the partitions
    over all, in the order that the footers give, and joined back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                reader = Reader(content.as_py())
                doc, start, count, crc, at = [], [], [], [], 0
                for key, ids in reader.scan():
                    doc.append(id_of(key))
                    start.append(at)
                    count.append(len(ids))
                    crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    at += len(ids)
                place = [pa.array([x] * len(doc), pa.int64()) for x in reader.place]
                yield pa.record_batch(
                    [*place, pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(count, pa.int64()), pa.array(crc, pa.int64())],
                    names=["partition", "number", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    rows = cut(_contents(spark, path).mapInArrow(run, "partition long, number long, doc_id long, start long, n_tokens long, ids_crc32 long"))
    totals = rows.groupBy("partition", "number").agg(F.sum("n_tokens").alias("total"))
    until = Window.unboundedPreceding, -1
    inside = totals.withColumn("inside", F.sum("total").over(Window.partitionBy("partition").orderBy("number").rowsBetween(*until)))
    whole = totals.groupBy("partition").agg(F.sum("total").alias("whole"))
    outside = whole.select("partition", F.sum("whole").over(Window.orderBy("partition").rowsBetween(*until)).alias("outside"))
    before = inside.join(outside, "partition").select("partition", "number", (F.coalesce("inside", F.lit(0)) + F.coalesce("outside", F.lit(0))).alias("before"))
    return rows.join(before, ["partition", "number"]).select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def encode_to_shards(docs: DataFrame, path: str, folder: str, end: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write a fresh set of shards below `folder` and give their digests."""
    out = f"{folder}/shards-{uuid.uuid4().hex}"
    return digest_shards(docs.sparkSession, write_shards(docs, path, out, end, id_col, text_col))
