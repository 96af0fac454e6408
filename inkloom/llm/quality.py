"""Quality classifier by co-training.

Two views of a document: its text (hashed words and counts of what characters,
words and lines are like) and its metadata (language, source, length).  Each view has
a logistic regression.  In each round both score every unlabelled document of
the corpus; each labels the PER_ROUND that it is surest of, in proportion to the
classes, and the other learns from them too.  Held-out labels then calibrate
each view by Platt scaling and weigh the two calibrated views in one score, and
all documents are scored.

The regressions are fitted on the driver, from the features of LABELLED labelled
documents at most, those with the smallest hashes of their ids, and of the
2 * PER_ROUND documents that a round adds.  Nothing else comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.llm.common import PUNCTUATED, U64, ByteRule, buffers, cut, released, runs, word_hashes

LABELLED = 5000
ROUNDS = 3
#: Documents that each view labels in a round.
PER_ROUND = 100
CALIBRATION = 0.3
WORD_BINS = 512
TEXT_STATS = 22
LANG_BINS, SOURCE_BINS = 16, 64
META_DIM = LANG_BINS + SOURCE_BINS + 3
#: A document is kept at this probability of good quality or more, or at the lower one
#: that keeps all but this share of the held-out good documents: of 1,000 it rests on five.
ACCEPT = 0.5
LOST_GOOD = 0.005

_CLASS = np.zeros(256, dtype=np.uint8)  # 0 other, 1 lower, 2 upper, 3 digit, 4 blank, 5 sentence mark, 6 symbol, 7 beyond ASCII, 8 bracket or quote
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[9, 10, 11, 12, 13, 32]], _CLASS[128:] = 1, 2, 3, 4, 7
_CLASS[list(b".,;:?")] = 5
_CLASS[list(b"#$%&*+<=>@^_|~/\\!")] = 6
_CLASS[list(b"()[]{}'\"`-")] = 8


def text_features(column: pa.Array, rule: ByteRule) -> np.ndarray:
    """WORD_BINS of hashed word frequencies and TEXT_STATS ratios for each row; an empty text has zeros and a mark."""
    data, offsets = buffers(column)
    out = np.zeros((len(offsets) - 1, WORD_BINS + TEXT_STATS), dtype=np.float32)
    for lo, hi in runs(offsets):
        part, own = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        hashes, starts, ends, at = word_hashes(part, own, rule)
        kinds, bins, lengths = _CLASS[part], (hashes >> U64(55)).astype(np.int64), ends - starts
        for i in range(hi - lo):
            row, n = out[lo + i], int(own[i + 1] - own[i])
            if not n:
                row[WORD_BINS + TEXT_STATS - 1] = 1
                continue
            a, b = at[i], at[i + 1]
            words = b - a
            text = part[own[i] : own[i + 1]]
            stats = np.zeros(TEXT_STATS)
            stats[:9] = np.bincount(kinds[own[i] : own[i + 1]], minlength=9)[:9] / n
            stats[9] = np.log1p(n) / 10
            feeds = np.flatnonzero(text == 10)
            stats[10] = (len(feeds) + 1) / n
            if words:
                counts = np.bincount(bins[a:b], minlength=WORD_BINS)
                row[:WORD_BINS] = np.sqrt(counts / words)
                distinct, repeats = np.unique(hashes[a:b], return_counts=True)
                share = repeats / words
                stats[11:15] = len(distinct) / words, share.max(), (share * share).sum(), np.log(words)
                stats[14] /= 10
                stats[15:18] = lengths[a:b].mean() / 10, lengths[a:b].std() / 10, (hashes[a + 1 : b] == hashes[a : b - 1]).mean() if words > 1 else 0
            marks = np.bincount(text, minlength=128)
            stats[18:21] = marks[ord("|")] / n, marks[ord("!")] / n, marks[[ord(c) for c in "#$%&*"]].sum() / n
            row[WORD_BINS:] = stats
    return out


def meta_features(lang: list, source: list, n_chars: list) -> np.ndarray:
    out = np.zeros((len(lang), META_DIM), dtype=np.float32)
    for i, (a, b, n) in enumerate(zip(lang, source, n_chars, strict=True)):
        out[i, xxhash.xxh3_64_intdigest(str(a)) % LANG_BINS] = 1
        out[i, LANG_BINS + xxhash.xxh3_64_intdigest(str(b)) % SOURCE_BINS] = 1
        size = np.log1p(max(n or 0, 0)) / 10
        out[i, -3:] = size, size * size, n is None
    return out


class Logistic:
    """Ridge logistic regression by Newton steps on standardised features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0):
        x = x.astype(np.float64)
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])
        weight = np.ones(len(y)) if weight is None else weight
        beta, keep = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
        keep[-1] = 1e-6
        for _ in range(12):
            p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
            slope = z.T @ (weight * (y - p)) - keep * beta
            curve = (z * (weight * p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(keep)
            step = np.linalg.solve(curve, slope)
            beta += step
            if np.abs(step).max() < 1e-5:
                break
        self.beta = beta

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.beta[:-1] + self.beta[-1]


class Model:
    """Two calibrated views and their weights; without labels of both classes it scores 1 for everything."""

    def __init__(self, labelled: list[tuple[np.ndarray, np.ndarray, int]], surest: Callable[[list[Logistic], int, int], list[tuple[np.ndarray, np.ndarray, int]]], rounds: int = ROUNDS, per_round: int = PER_ROUND):
        """labelled: features of both views and class; surest(views, good, bad): what each view is surest of, `good` and `bad` documents of its classes."""
        self.views: list[Logistic] = []
        self.accept = 0.0
        y = np.array([r[2] for r in labelled], dtype=np.float64)
        if not len(y) or y.min() == y.max():
            return
        order = np.random.default_rng(5).permutation(len(y))
        held = order[: int(CALIBRATION * len(y))]
        train = np.setdiff1d(order, held)
        if min(len(np.unique(y[held])), len(np.unique(y[train]))) < 2:
            held = train = order
        views = [np.stack([r[k] for r in labelled]) for k in (0, 1)]
        base = np.clip(y[train].mean(), 0.02, 0.98)
        good = max(1, round(per_round * base))
        extra: list[tuple[np.ndarray, np.ndarray, int]] = []
        for step in range(rounds + 1):
            target = np.append(y[train], [float(m) for _, _, m in extra])
            weight = np.append(np.ones(len(train)), np.full(len(extra), 0.5))
            self.views = [Logistic(np.stack([*v[train], *(e[k] for e in extra)]), target, weight) for k, v in enumerate(views)]
            if step < rounds:
                extra += surest(self.views, good, max(1, per_round - good))
        self.platt = [Logistic(v.logit(x[held])[:, None], y[held]) for v, x in zip(self.views, views, strict=True)]
        both = np.stack([p.logit(v.logit(x[held])[:, None]) for p, v, x in zip(self.platt, self.views, views, strict=True)], axis=1)
        self.final = Logistic(both, y[held])
        good = self.final.logit(both[y[held] == 1])
        self.accept = float(min(ACCEPT, 1 / (1 + np.exp(-np.quantile(good, LOST_GOOD)))))

    def scores(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Columns: text view, metadata view, both."""
        if not self.views:
            return np.ones((len(text), 3))
        parts = [p.logit(v.logit(x)[:, None]) for p, v, x in zip(self.platt, self.views, (text, meta), strict=True)]
        logits = np.stack([*parts, self.final.logit(np.stack(parts, axis=1))], axis=1)
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def _view_rows(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"), *more)


def _features(rows: DataFrame, kind: str) -> DataFrame:
    """(doc_id, a, b) with the bytes of the features of both views."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = ByteRule(PUNCTUATED)
        for batch in batches:
            text = text_features(batch.column(1), rule)
            meta = meta_features(*(batch.column(i).to_pylist() for i in (2, 3, 4)))
            yield pa.record_batch([batch.column(0), pa.array([x.tobytes() for x in text], pa.binary()), pa.array([x.tobytes() for x in meta], pa.binary())], names=["doc_id", "a", "b"])

    return rows.mapInArrow(lambda batches: released(run(batches)), f"doc_id {kind}, a binary, b binary")


def _logits(rows: DataFrame, views: list[Logistic], kind: str) -> DataFrame:
    """(doc_id, a, b) with the logits of both views; one narrow pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = ByteRule(PUNCTUATED)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = (text_features(part.column(1), rule), meta_features(*(part.column(i).to_pylist() for i in (2, 3, 4))))
                yield pa.record_batch([part.column(0), *(pa.array(np.round(v.logit(x), 9)) for v, x in zip(views, found, strict=True))], names=["doc_id", "a", "b"])

    return rows.mapInArrow(lambda batches: released(run(batches)), f"doc_id {kind}, a double, b double")


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS, per_round: int = PER_ROUND) -> Model:
    """A model from a bounded number of labelled documents and all unlabelled ones; labels without a document, null labels and null ids are left out.

    Of several labels of an id the least counts, of several rows of an id the
    one with the least features.  Columns of other names are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _view_rows(docs).where("doc_id is not null")
    near = F.xxhash64("doc_id")
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast(kind).alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    chosen = known.join(rows.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(near, "doc_id").limit(labelled)

    def brought(few: DataFrame, mark: str) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """Features of a bounded set of ids, with a mark, in order of the ids."""
        found = _features(rows.join(F.broadcast(few.select("doc_id")), "doc_id", "left_semi"), kind).groupBy("doc_id").agg(F.min(F.struct("a", "b")).alias("f"))
        out = found.join(F.broadcast(few), "doc_id").select("doc_id", "f.a", "f.b", mark).collect()
        return [(np.frombuffer(r["a"], dtype=np.float32), np.frombuffer(r["b"], dtype=np.float32), int(r[mark] > 0)) for r in sorted(out, key=lambda r: r["doc_id"])]

    taken: list = []

    def surest(views: list[Logistic], good: int, bad: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
        scored = _logits(rows, views, kind).join(known, "doc_id", "left_anti")
        scored = cut(scored.groupBy("doc_id").agg(F.min("a").alias("a"), F.min("b").alias("b")))
        marks: dict = {}
        for view in ("a", "b"):  # of a document that both are sure of, the first counts
            best = scored.where(f"{view} > 0").orderBy(F.desc(view), near, "doc_id").limit(good + len(taken)).select("doc_id", F.lit(1).alias("mark")).collect()
            worst = scored.where(f"{view} < 0").orderBy(view, near, "doc_id").limit(bad + len(taken)).select("doc_id", F.lit(0).alias("mark")).collect()
            for some, n in ((best, good), (worst, bad)):
                for r in [r for r in some if r["doc_id"] not in taken][:n]:
                    marks.setdefault(r["doc_id"], r["mark"])
        taken.extend(marks)
        return brought(docs.sparkSession.createDataFrame(list(marks.items()), f"doc_id {kind}, mark int"), "mark") if marks else []

    return Model(brought(cut(chosen), "quality"), surest, rounds, per_round)


def score(docs: DataFrame, model: Model, accept: float | None = None) -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) of each row; one narrow pass, no shuffle.

    Nulls are values of their own: a null text counts as empty, a null language,
    source or length has its own feature.  Repeated rows and null ids get a row each.
    accept: least score to be kept; the model's own if none is given.
    """
    least = model.accept if accept is None else accept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = ByteRule(PUNCTUATED)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = model.scores(text_features(part.column(1), rule), meta_features(*(part.column(i).to_pylist() for i in (2, 3, 4))))
                yield pa.record_batch([part.column(0), *(pa.array(np.round(found[:, k], 6)) for k in range(3)), pa.array(found[:, 2] >= least)], names=["doc_id", "text_score", "meta_score", "score", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _view_rows(docs).mapInArrow(lambda batches: released(run(batches)), f"doc_id {kind}, text_score double, meta_score double, score double, kept boolean")


def keep_good(docs: DataFrame, model: Model, accept: float | None = None) -> DataFrame:
    """The rows of docs, all columns, that the model keeps; one narrow pass."""
    least = model.accept if accept is None else accept
    columns, schema = docs.columns, docs.schema
    need = {"text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = ByteRule(PUNCTUATED)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                text, *rest = (part.column(columns.index(c)) for c in need)
                good = model.scores(text_features(text, rule), meta_features(*(x.to_pylist() for x in rest)))[:, 2] >= least
                yield part.filter(pa.array(good))

    return docs.mapInArrow(lambda batches: released(run(batches)), schema)
