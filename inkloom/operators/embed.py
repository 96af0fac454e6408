"""Embeddings through a pluggable model."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import md5
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.functions.text import model_text, one_line


class Embedder(Protocol):
    """A model: its name, the length of its vectors, whether they have unit length, and its batches."""

    name: str
    dim: int
    normalized: bool

    def embed_batch(self, texts: list[str]) -> list[list[float]]: ...


class HashingEmbedder:
    """A deterministic stand-in: signed hashes of all words of a text, unit length; runs anywhere.

    Its name differs from those of its earlier forms, so that their vectors are stale.
    """

    normalized = True

    def __init__(self, dim: int = 64):
        self.name, self.dim = f"hashing-md5-{dim}", dim

    def embed_batch(self, texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), self.dim))
        for row, text in zip(out, texts, strict=True):
            for word, n in Counter(text.lower().split()).items():
                h = int.from_bytes(md5(word.encode(), usedforsecurity=False).digest()[8:], "little")
                row[(h >> 20) % self.dim] += n if h >> 60 & 1 else -n
        return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)).tolist()


class ApiEmbedder:
    """A model behind a service: call(texts) gives a vector for each, and those of another length are an error."""

    normalized = False

    def __init__(self, name: str, dim: int, call: Callable[[list[str]], list[list[float]]], batch: int = 100, per_minute: float | None = None, sleep: Callable[[float], None] = time.sleep):
        self.name, self.dim, self.call, self.batch = name, dim, call, batch
        self.wait, self.sleep, self.called = 60 / per_minute if per_minute else 0.0, sleep, 0

    def embed_batch(self, texts: list[str]) -> list[list[float]]:
        out: list[list[float]] = []
        for at in range(0, len(texts), self.batch):
            if self.called and self.wait:
                self.sleep(self.wait)
            self.called += 1
            part = self.call(texts[at : at + self.batch])
            if any(len(v) != self.dim for v in part):
                raise ValueError(f"{self.name} gave a vector of another length than {self.dim}")
            out += part
        return out


class WindowEmbedder:
    """A token model that runs here: texts are cut to `window` tokens, `batch` of them pass at a time, and the vector of the first token, or the mean, stands for a text.

    tokenize(text) gives ids with the marks that the model wants; forward(list of
    ids) gives for each an array of a row a token.
    """

    def __init__(self, name: str, dim: int, tokenize: Callable[[str], list[int]], forward: Callable[[list[list[int]]], list[np.ndarray]], window: int = 512, batch: int = 16, pooling: str = "first", normalized: bool = True):
        if pooling not in ("first", "mean"):
            raise ValueError(f"unknown pooling {pooling!r}")
        self.name, self.dim, self.normalized = name, dim, normalized
        self.tokenize, self.forward, self.window, self.batch, self.pooling = tokenize, forward, window, batch, pooling

    def token_counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text that the model sees."""
        return [min(len(self.tokenize(t)), self.window) for t in texts]

    def embed_batch(self, texts: list[str]) -> list[list[float]]:
        out: list[list[float]] = []
        for at in range(0, len(texts), self.batch):
            ids = [self.tokenize(t)[: self.window] for t in texts[at : at + self.batch]]
            for rows in self.forward(ids):
                v = np.asarray(rows[0] if self.pooling == "first" else np.mean(rows, axis=0), dtype=np.float64)
                out.append((v / max(np.linalg.norm(v), 1e-12) if self.normalized else v).tolist())
        return out


#: Vector lengths and batch sizes of the models that can be plugged in.
KNOWN_MODELS = {"text-embedding-3-small": (1536, 100), "bge-small-en-v1.5": (384, 64), "specter2": (768, 16)}


def create(provider: str, factories: dict[str, Callable[[], Embedder]] | None = None) -> Embedder:
    """The provider's model, made once in a process; unknown ones are an error."""
    known = {"hashing": HashingEmbedder} | (factories or {})
    if provider not in known:
        raise ValueError(f"unknown embedding provider {provider!r}; known: {sorted(known)}")
    made = _MADE.setdefault(provider, (known[provider], None))
    if made[1] is None or made[0] is not known[provider]:
        made = _MADE[provider] = known[provider], known[provider]()
    return made[1]


_MADE: dict[str, tuple[Callable[[], Embedder], Embedder | None]] = {}


def with_embeddings(chunks: DataFrame, factory: Callable[[], Embedder], text: str = "text", title: str | None = None, batch: int = 64) -> DataFrame:
    """Chunks with embedding, embedding_model, embedding_dim and embedding_normalized.

    The model is made once in each Python worker; a batch whose answer has another
    length is an error, never cut short.  A null text gets no embedding.
    """
    model = factory()

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = factory()
        for texts in parts:
            out: list = [None] * len(texts)
            at = [i for i, t in enumerate(texts) if t is not None]
            for lo in range(0, len(at), batch):
                part = at[lo : lo + batch]
                vectors = own.embed_batch([texts.iloc[i] for i in part])
                if len(vectors) != len(part):
                    raise ValueError(f"{own.name} gave {len(vectors)} vectors for {len(part)} texts")
                for i, v in zip(part, vectors, strict=True):
                    out[i] = v
            yield pd.Series(out)

    source = one_line(F.col(text)) if title is None else model_text(F.col(title), one_line(F.col(text)))
    return chunks.select("*", run(source).alias("embedding"), F.lit(model.name).alias("embedding_model"), F.lit(model.dim).alias("embedding_dim"), F.lit(model.normalized).alias("embedding_normalized"))


def embedded_only(chunks: DataFrame) -> DataFrame:
    return chunks.where(F.size("embedding") > 0)


def stale(chunks: DataFrame, model: str) -> DataFrame:
    """Embedded with another model."""
    return chunks.where(F.col("embedding").isNotNull() & ~F.col("embedding_model").eqNullSafe(model))


def with_token_counts(chunks: DataFrame, factory: Callable[[], WindowEmbedder], text: str = "text") -> DataFrame:
    """Chunks with token_count, the tokens that the model sees of each, null for a null text."""

    @F.pandas_udf("int")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = factory()
        for texts in parts:
            yield pd.Series([None if t is None else own.token_counts([t])[0] for t in texts], dtype="Int32")

    return chunks.withColumn("token_count", run(text))


def truncated(chunks: DataFrame, most: int = 512) -> DataFrame:
    return chunks.withColumn("was_truncated", F.col("token_count") >= most)
