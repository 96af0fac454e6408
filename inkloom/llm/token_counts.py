"""Token counts of sections by offset-mapped attribution.

A document is encoded once as a whole.  The bytes of the tokens tile the text,
so running sums of their lengths are the token spans; sections are spans that
tile the text too.  A merge of the two sorted lists (the interval join) puts
each token where the rule says:

first     the section that holds the token's first byte
last      the section that holds its last byte
majority  the section with most of its bytes; of equals the earlier one

Section borders are at characters, so a token whose first byte lies inside a
character counts with that character.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from inkloom.llm.common import buffers, runs

RULES = ("first", "last", "majority")
_LOADED: dict[tuple[str, str], tuple[tiktoken.Encoding, np.ndarray]] = {}


def _load(path: str, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    if (path, pattern) not in _LOADED:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        sizes[list(ranks.values())] = [len(s) for s in ranks]
        _LOADED[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes
    return _LOADED[path, pattern]


def line_sections(data: np.ndarray) -> np.ndarray:
    """Start of each section: a section is a line with its line feed; an empty text has none."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    heads = np.flatnonzero(data == 10) + 1
    return np.append(0, heads[heads < len(data)])


def attribute(sizes: np.ndarray, starts: np.ndarray, rule: str = "first") -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and those of them that reach into another section.

    sizes: bytes of each token; starts: first byte of each section, ascending from 0.
    """
    n = len(starts)
    if not n or not len(sizes):
        return np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    end = np.cumsum(sizes)
    begin = end - sizes
    first = np.searchsorted(starts, begin, side="right") - 1
    last = np.searchsorted(starts, end - 1, side="right") - 1
    crossing = first != last
    owner = first
    if rule == "last":
        owner = last
    elif rule == "majority":
        owner = first.copy()
        for t in np.flatnonzero(crossing):
            borders = np.concatenate([[begin[t]], starts[first[t] + 1 : last[t] + 1], [end[t]]])
            owner[t] = first[t] + int(np.argmax(np.diff(borders)))
    elif rule != "first":
        raise ValueError(f"rule must be one of {RULES}")
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def count_sections(
    docs: DataFrame, path: str, pattern: str, rule: str = "first", sections: Callable[[np.ndarray], np.ndarray] = line_sections, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, section, n_bytes, n_tokens, n_crossing) of every section; one narrow pass, no shuffle.

    A null or empty text has no section and gives no row.  Repeated rows and
    null ids are counted each; other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = _load(path, pattern)
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for lo, hi in runs(offsets):
                rows, sec, n_bytes, n_tokens, n_crossing = [], [], [], [], []
                for i in range(lo, hi):
                    text = data[offsets[i] : offsets[i + 1]]
                    starts = sections(text)
                    if not len(starts):
                        continue
                    ids = np.asarray(encoding.encode_ordinary(text.tobytes().decode("utf-8")), dtype=np.int64)
                    counts, crossing = attribute(sizes[ids], starts, rule)
                    rows.append(np.full(len(starts), i))
                    sec.append(np.arange(len(starts)))
                    n_bytes.append(np.diff(np.append(starts, len(text))))
                    n_tokens.append(counts)
                    n_crossing.append(crossing)
                if rows:
                    cols = [pa.array(np.concatenate(x).astype(np.int64)) for x in (sec, n_bytes, n_tokens, n_crossing)]
                    yield pa.record_batch([batch.column(0).take(pa.array(np.concatenate(rows))), *cols], names=[id_col, "section", "n_bytes", "n_tokens", "n_crossing"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col], docs[text_col].cast("string").alias("text")).mapInArrow(run, f"`{id_col}` {kind}, section long, n_bytes long, n_tokens long, n_crossing long")
