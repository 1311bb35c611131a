"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SUM_SCHEMA, SUM_TASKS, Words, map_batches, mix, pack, pieces, summed, text_bytes, unpack, words
from .learning import PIECE_BYTES, Adam, by_piece, crc_rest, fitted, labelled_sample, softmax, temperature

ROWS = 6000  # labelled documents that are trained on at most
BUCKETS, DIM, NONZERO, CONTEXT = 4096, 48, 4, 2
SHAPES, RELATIONS = 1024, 8
SLICE = 64  # symbols whose sums travel together
HIDDEN = 32
FIT_BYTES = 1 << 18  # text that training holds words of at once
BLOCK = 256  # documents whose symbols are counted at once
THRESHOLD = 0.7


def _index_spots(n: int, seed: int) -> np.ndarray:
    """Sparse random index vectors, as the places of their nonzeros: -1 at the even ones, +1 at the odd ones."""
    return np.random.default_rng(seed).integers(0, DIM, (NONZERO, n))


def _index_vectors(n: int, seed: int) -> np.ndarray:
    out = np.zeros((n, DIM), np.float32)
    for k, spot in enumerate(_index_spots(n, seed)):
        out[np.arange(n), spot] += 1.0 if k % 2 else -1.0
    return out


def _class_table() -> np.ndarray:
    """Classes of bytes: 0 lower, 1 upper, 2 digit, 3 other ASCII, 4 non-ASCII."""
    table = np.full(256, 3, np.uint8)
    table[97:123], table[65:91], table[48:58], table[128:] = 0, 1, 2, 4
    return table


_CLASSES = _class_table()


def _symbols(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: a hash bucket, a bucket of its shape, and how it repeats earlier words of its text."""
    n = len(found.starts)
    bucket = (found.hashes >> np.uint64(64 - 12)).astype(np.int64)
    if not n:
        return bucket, bucket, bucket
    classes = _CLASSES[found.buf]
    runs, upper, digits = (np.concatenate([[0], np.cumsum(classes == c, dtype=np.int32)]) for c in (3, 1, 2))
    length = np.minimum(found.ends - found.starts, 63)
    count = lambda c: np.minimum(c[found.ends] - c[found.starts], 3)
    last = found.buf[found.ends - 1].astype(np.int64)
    tail = np.where(_CLASSES[last] == 3, last, 0)
    code = ((count(runs) * 4 + count(upper)) * 4 + count(digits)) * 8 + np.minimum(length // 4, 7)
    shape = (mix((code * 256 + tail).astype(np.uint64)) >> np.uint64(64 - 10)).astype(np.int64)
    relation = np.zeros(n, np.int64)
    for back in (4, 3, 2, 1):
        if n > back:
            same = (found.hashes[back:] == found.hashes[:-back]) & (found.doc[back:] == found.doc[:-back])
            relation[back:][same] = back
    return bucket, shape, relation


def _pooled(docs: int, doc: np.ndarray, symbol: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean vector of each document's symbols; doc ascends. Documents are counted in blocks, however short they are."""
    width, out = len(vectors), np.empty((docs, vectors.shape[1]), vectors.dtype)
    for s in range(0, docs, BLOCK):
        e = min(docs, s + BLOCK)
        a, b = np.searchsorted(doc, [s, e])
        cell = (doc[a:b].astype(np.int64) - s) * width + symbol[a:b]
        counts = np.bincount(cell, minlength=(e - s) * width).reshape(-1, width).astype(np.float32)
        out[s:e] = counts @ vectors / np.maximum(counts.sum(1, keepdims=True), 1)
    return out


class Sample(NamedTuple):
    """Symbols of some texts in few bytes: text, word, shape and repetition of each word; words per text."""

    doc: np.ndarray
    bucket: np.ndarray
    shape: np.ndarray
    relation: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, found: Words) -> Sample:
        bucket, shape, relation = _symbols(found)
        return cls(found.doc.astype(np.int32), bucket.astype(np.uint16), shape.astype(np.uint16), relation.astype(np.uint8), found.counts)


def _add_contexts(total: np.ndarray, symbol: np.ndarray, doc: np.ndarray, spots: np.ndarray) -> None:
    """Adds to each symbol the index vectors of its neighbours within CONTEXT words: whole numbers, in any order."""
    symbol = symbol.astype(np.int64)
    for back in range(1, min(CONTEXT, len(symbol) - 1) + 1):
        near = doc[back:] == doc[:-back]
        left, right = symbol[:-back][near], symbol[back:][near]
        for own, other in ((left, right), (right, left)):
            for k, spot in enumerate(spots):
                found = np.bincount(own * DIM + spot[other], minlength=total.size)
                total += found if k % 2 else -found


def _count_contexts(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() // SUM_TASKS
        sizes = (BUCKETS, SHAPES)
        spots = [_index_spots(n, seed + k) for k, n in enumerate(sizes)]
        totals = [np.zeros(n * DIM, np.int64) for n in sizes]
        for batch in batches:
            buf, bounds = text_bytes(batch.column(0))
            for i, j in pieces(bounds, FIT_BYTES):
                own = Sample.of(words(buf[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], lower=True))
                _add_contexts(totals[0], own.bucket, own.doc, spots[0])
                _add_contexts(totals[1], own.shape, own.doc, spots[1])
        slices = np.concatenate(totals).reshape(-1, SLICE * DIM)
        some = np.flatnonzero(slices.any(1))
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array([part] * len(some), pa.int32()), pa.array([pack(slices[k].view(np.uint64)) for k in some], pa.binary())], ["slice", "part", "data"])

    return run


def corpus_contexts(docs: DataFrame, text: str = "text", seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the index vectors around every word bucket and every word shape, over all texts: of one size whatever the
    corpus. Tasks send their sums in slices, which are added in two levels."""
    found = map_batches(docs.select(F.col(text).cast("string").alias("text")), _count_contexts(seed), SUM_SCHEMA)
    total = np.zeros(((BUCKETS + SHAPES) // SLICE, SLICE * DIM), np.int64)
    for r in summed(found).toArrow().to_pylist():
        total[r["slice"]] = unpack(r["data"]).view(np.int64)
    total = total.reshape(-1, DIM)
    return total[:BUCKETS], total[BUCKETS:]


class QualityModel:
    """Fitted by fit(); the context vectors and the network are all that it holds."""

    def __init__(self, seed: int = 11):
        self.seed = seed
        self.words = self.shapes = None
        self.relations = np.eye(RELATIONS, dtype=np.float32)
        self.weights: dict[str, np.ndarray] = {}
        self.mean = self.spread = None
        self.temperature, self.prior = 1.0, 1.0

    def _features(self, own: Sample) -> np.ndarray:
        n = len(own.counts)
        word = _pooled(n, own.doc, own.bucket, self.words)
        parts = [word, np.sqrt((word * word).sum(1, keepdims=True)), _pooled(n, own.doc, own.shape, self.shapes), _pooled(n, own.doc, own.relation, self.relations), np.log1p(own.counts)[:, None]]
        return np.concatenate(parts, 1).astype(np.float32)

    def _context(self, total: np.ndarray, seed: int) -> np.ndarray:
        """Context vectors: the corpus's sums at unit length, plus the own index vector."""
        total = total.astype(float)
        norm = np.sqrt((total * total).sum(1, keepdims=True))
        return (total / np.maximum(norm, 1) + _index_vectors(len(total), seed) / np.sqrt(NONZERO)).astype(np.float32)

    def _logits(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.maximum((x - self.mean) / self.spread @ w["w1"] + w["b1"], 0) @ w["w2"] + w["b2"]

    def fit(self, batches: Iterator[pa.RecordBatch], contexts: tuple[np.ndarray, np.ndarray], epochs: int = 60) -> QualityModel:
        """The network learns from batches of id, text, label; no more than their features is held."""
        rng = np.random.default_rng(self.seed)
        self.words, self.shapes = (self._context(total, self.seed + k) for k, total in enumerate(contexts))
        x, gold = [], []
        for batch in batches:
            buf, bounds = text_bytes(batch.column(1))
            x += [self._features(Sample.of(words(buf[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], lower=True))) for i, j in pieces(bounds, FIT_BYTES)]
            gold += batch.column(2).to_pylist()
        gold = np.array(gold, np.int64)
        if len(set(gold.tolist())) < 2:  # nothing to tell apart: every score is the share of label 1
            self.prior, self.words = (float(gold.mean()) if len(gold) else 1.0), None
            return self
        x = np.concatenate(x)
        order = rng.permutation(len(x))
        back, train = order[: len(x) // 5], order[len(x) // 5 :]
        self.mean, self.spread = x[train].mean(0), x[train].std(0) + 1e-3
        self.weights = {
            "w1": rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)).astype(np.float32), "b1": np.zeros(HIDDEN, np.float32),
            "w2": rng.normal(0, np.sqrt(2 / HIDDEN), (HIDDEN, 2)).astype(np.float32), "b2": np.zeros(2, np.float32),
        }
        optimiser, z = Adam(self.weights, 3e-3), (x - self.mean) / self.spread
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(train), max(1, len(train) // 64)):
                hidden = np.maximum(z[part] @ self.weights["w1"] + self.weights["b1"], 0)
                slope = softmax(hidden @ self.weights["w2"] + self.weights["b2"])
                slope[np.arange(len(part)), gold[part]] -= 1
                slope /= len(part)
                below = slope @ self.weights["w2"].T * (hidden > 0)
                optimiser.update({"w1": z[part].T @ below + 1e-4 * self.weights["w1"], "b1": below.sum(0), "w2": hidden.T @ slope + 1e-4 * self.weights["w2"], "b2": slope.sum(0)})
        self.temperature = temperature(self._logits(x[back]), gold[back])
        return self

    def scores(self, buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each text."""
        if self.words is None:
            return np.full(len(bounds) - 1, self.prior)
        # shape needs upper case, identity does not
        return softmax(self._logits(self._features(Sample.of(words(buf, bounds, lower=True)))) / self.temperature)[:, 1].astype(np.float64)


def train_quality(docs: DataFrame, labels: DataFrame, rows: int = ROWS, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> QualityModel:
    """A model whose context vectors come from all texts, and whose network is fitted on at most `rows` labelled documents
    outside the held-out fold (crc32 of doc_id modulo 4 is 2)."""
    learnt = labels.select(F.col(doc_id), F.col(quality).cast("int").alias("label")).where(crc_rest(doc_id, 4) != 2)
    contexts = corpus_contexts(docs, text)
    return fitted(labelled_sample(docs, learnt, rows, doc_id, text), lambda batches: QualityModel().fit(batches, contexts))


def score_quality(docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted.

    Null and empty texts are scored like any other, as texts without words; a null doc_id is not held out; rows that
    repeat get equal scores; an empty table gives no rows; other columns are not read. Whole texts are scored, in batches
    of bounded size. Without labels, or with one kind only, the score is the share of label 1 (1 without any).
    """

    def score(buf: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        p = model.scores(buf, bounds)
        return [pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))]

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = map_batches(rows, by_piece(score, ["doc_id", "score", "predicted"]), "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(crc_rest("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def keep_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose predicted quality is 1."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, bounds = text_bytes(batch.column(at))
            for i, j in pieces(bounds, PIECE_BYTES):
                p = model.scores(buf[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                yield batch.slice(i, j - i).filter(pa.array(p >= THRESHOLD))

    return map_batches(docs, run, docs.schema)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_quality(docs, train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
