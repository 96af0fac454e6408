"""Chunks of bounded size: sentences and paragraphs packed in order, and recursive splitting."""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.functions.text import MIN_CHARS, WS, token_estimate

# Sizes of chunks in words and characters.
MAX_WORDS, MIN_WORDS = 400, 10
CHUNK_CHARS, OVERLAP_CHARS = 2048, 256
SEPARATORS = ("\n\n", "\n", ". ", " ", "")


def sentences(text: Column) -> Column:
    return F.split(text, rf"(?<=[.!?])[{WS}]+")


_SENTENCE = re.compile(rf"(?<=[.!?])[{WS}]+")


def packed(parts: Iterable[str], most: int) -> list[str]:
    """Adjacent parts joined by blanks while they have at most `most` words; a longer part stays alone.  Words are counted once."""
    groups: list[list[str]] = []
    room = -1
    for part in parts:
        n = len(part.split())
        if groups and n <= room:
            groups[-1].append(part)
            room -= n
        else:
            groups.append([part])
            room = most - n
    return [" ".join(g) for g in groups]


def packed_paragraphs(paragraphs: Iterable[str], most: int, least: int) -> list[str]:
    out: list[str] = []
    run: list[str] = []
    for paragraph in paragraphs:
        if len(paragraph.split()) <= most:
            run.append(paragraph)
            continue
        out += [*packed(run, most), *packed(_SENTENCE.split(paragraph), most)]
        run = []
    return [c for c in [*out, *packed(run, most)] if len(c.split()) >= least]


def pack_sentences(text: Column, most: int = MAX_WORDS) -> Column:
    """Runs of sentences of at most `most` words, none of them blank; a longer sentence stays whole.  What fits depends on all before it, so it is one pass over Arrow batches."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else [c for c in packed(_SENTENCE.split(t), most) if c.strip()])

    return run(text)


def pack_paragraphs(paragraphs: Column, most: int = MAX_WORDS, least: int = MIN_WORDS) -> Column:
    """Runs of paragraphs of at most `most` words; longer ones are packed by sentences; under `least` words go."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else packed_paragraphs([p for p in t if p is not None], most, least))

    return run(paragraphs)


def split_recursively(text: str, size: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Chunks of about `size` characters, cut at the first separator that occurs; whole pieces overlap."""
    at = next((i for i, s in enumerate(separators) if not s or s in text), len(separators) - 1)
    mark, finer = separators[at], separators[at + 1 :]
    if mark:
        first, *rest = text.split(mark)
        pieces = [p for p in [first, *(mark + r for r in rest)] if p]
    else:
        pieces = list(text)
    out: list[str] = []
    small: list[str] = []

    def emit(parts: list[str]) -> None:
        joined = "".join(parts).strip()
        if joined:
            out.append(joined)

    def merge() -> None:
        held: list[str] = []
        total = 0
        for piece in small:
            if total + len(piece) > size and held:
                emit(held)
                while held and (total > overlap or total + len(piece) > size and total > 0):
                    total -= len(held.pop(0))
            held.append(piece)
            total += len(piece)
        if held:
            emit(held)
        small.clear()

    for piece in pieces:
        if len(piece) < size:
            small.append(piece)
            continue
        merge()
        if finer:
            out.extend(split_recursively(piece, size, overlap, finer))
        else:
            out.append(piece)
    merge()
    return out


def recursive_chunks(text: Column, size: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> Column:
    """array<string>; the splitting is sequential and recursive, so it runs in Arrow batches."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [] if not t else split_recursively(t, size, overlap))

    return run(text)


def chunk_rows(sections: DataFrame, paper_key: str = "arxiv_id", size: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, least: int = MIN_CHARS) -> DataFrame:
    """One row for each chunk of sections (paper_key, section_order, title, text, ...) of `least` characters or more.

    Ids number the chunks before short ones go, so they may have gaps.
    """
    long = sections.where(F.length("text") >= least)
    cut = long.select("*", F.posexplode(recursive_chunks(F.col("text"), size, overlap)).alias("_i", "_chunk")).where(F.length("_chunk") >= least)
    chunk = F.col("_chunk")
    out = cut.withColumn("chunk_id", F.concat_ws("_", paper_key, "section_order", "_i")).withColumn("section", F.coalesce("title", F.lit("Body"))).withColumn("token_count", token_estimate(chunk)).withColumn("text", chunk)
    return out.drop("_i", "_chunk", "title")
