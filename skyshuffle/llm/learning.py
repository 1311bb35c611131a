"""Bounded training samples, a small optimiser and scoring of text batches."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, pieces, text_bytes

PIECE_BYTES = 1 << 20


def crc_rest(doc_id: str, by: int):
    """crc32 of doc_id as text, modulo by; null for null."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(by))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, doc_id: str, text: str) -> DataFrame:
    """id, text, label of at most `rows` documents of labels(doc_id, label), those with the smallest hash of doc_id.

    Only ids are ordered; texts are read by a join with that bounded list. Documents without text or with contradicting
    labels are left out; of rows that share a doc_id the smallest text is taken.
    """
    one = labels.where(F.col(doc_id).isNotNull() & F.col("label").isNotNull()).groupBy(doc_id).agg(F.min("label").alias("label"), F.max("label").alias("other"))
    picked = one.where("label = other").select(F.col(doc_id).alias("_id"), "label").orderBy(F.xxhash64("_id"), "_id").limit(rows)
    texts = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    return texts.join(F.broadcast(picked), "_id").groupBy("_id", "label").agg(F.min("_text").alias("_text")).select("_id", "_text", "label")


def fitted(sample: DataFrame, fit: Callable[[Iterator[pa.RecordBatch]], object]):
    """What fit makes of a bounded sample, whose rows come in order of their first column. One task fits; the driver gets
    the fitted object alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.record_batch([pa.array([pickle.dumps(fit(batches))], pa.binary())], ["model"])

    one = sample.repartition(1).sortWithinPartitions(sample.columns[0])
    row = map_batches(one, run, "model binary").first()
    return pickle.loads(row[0]) if row else fit(iter(()))  # an empty sample may have no task


class Adam:
    """Adam on a dict of arrays, in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.step = weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def update(self, gradients: dict[str, np.ndarray]) -> None:
        self.step += 1
        for k, g in gradients.items():
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            mean, square = self.mean[k] / (1 - 0.9**self.step), self.square[k] / (1 - 0.999**self.step)
            self.weights[k] -= (self.rate * mean / (np.sqrt(square) + 1e-8)).astype(self.weights[k].dtype)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(logits: np.ndarray, gold: np.ndarray) -> float:
    """The temperature under which held-back examples are likeliest."""
    if not len(gold):
        return 1.0
    tried = np.geomspace(0.25, 8, 60)
    return float(tried[np.argmin([-np.log(softmax(logits / t)[np.arange(len(gold)), gold] + 1e-12).mean() for t in tried])])


def by_piece(score: Callable[[np.ndarray, np.ndarray], list[pa.Array]], names: list[str]):
    """A mapInArrow function: the first column's values, and what score makes of the second column's text, piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, bounds = text_bytes(batch.column(1))
            for i, j in pieces(bounds, PIECE_BYTES):
                yield pa.record_batch([batch.column(0)[i:j], *score(buf[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])], names)

    return run
