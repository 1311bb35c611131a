"""Language identification with a byte convolutional network."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, pieces, text_bytes
from .learning import PIECE_BYTES, Adam, by_piece, crc_rest, fitted, labelled_sample, softmax

ROWS = 2500  # documents that are trained on at most
LENGTH, EMBED, WIDTHS, FILTERS = 256, 8, (2, 3, 4, 5), 8
WIDEST = max(WIDTHS)
PAD = 256
BATCH = 256  # windows at a time
PER_DOC = 6  # windows, drawn from the whole text, that a training document lends at most


def _fold() -> np.ndarray:
    table = np.arange(256, dtype=np.int64)
    table[65:91] += 32
    return table


_FOLD = _fold()
_LETTER = np.zeros(128, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def byte_windows(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts cut into windows of LENGTH bytes: the windows, padded so that filters fit, their text and their sizes."""
    size = np.diff(bounds)
    per = -(-size // LENGTH)
    doc = np.repeat(np.arange(len(size)), per)
    inner = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    start = bounds[doc] + inner * LENGTH
    length = np.minimum(LENGTH, bounds[doc + 1] - start)
    out = np.full((len(doc), LENGTH + WIDEST - 1), PAD, np.int64)
    at = np.arange(LENGTH)
    for s in range(0, len(doc), 4096):
        inside = at < length[s : s + 4096, None]
        spot = np.minimum(start[s : s + 4096, None] + at, max(0, len(buf) - 1))
        out[s : s + 4096, :LENGTH] = np.where(inside, _FOLD[buf[spot]], PAD)
    return out, doc, length


class ByteNetwork:
    """Embedded bytes, filters of several widths, max pooling over the window, softmax over languages."""

    def __init__(self, seed: int = 5):
        self.seed, self.langs, self.weights = seed, [], {}

    def _mask(self) -> np.ndarray:
        """Narrow filters are wide ones with zeros behind."""
        return np.concatenate([np.repeat((np.arange(WIDEST) < w).astype(np.float32), EMBED)[:, None].repeat(FILTERS, 1) for w in WIDTHS], 1)

    def _columns(self, window: np.ndarray) -> np.ndarray:
        embedded = self.weights["embed"][window]  # [n, LENGTH + WIDEST - 1, EMBED], contiguous
        n, step = len(window), embedded.strides
        view = np.lib.stride_tricks.as_strided(embedded, (n, LENGTH, WIDEST * EMBED), (step[0], step[1], step[2]))
        return view.reshape(n * LENGTH, WIDEST * EMBED)

    def logits(self, window: np.ndarray) -> np.ndarray:
        w, out = self.weights, []
        for s in range(0, len(window), BATCH):
            part = window[s : s + BATCH]
            maps = (self._columns(part) @ w["filter"]).reshape(len(part), LENGTH, -1)
            out.append(np.maximum(maps.max(1) + w["bias"], 0) @ w["out"] + w["out_bias"])
        return np.concatenate(out) if out else np.zeros((0, len(self.langs)), np.float32)

    def fit(self, batches: Iterator[pa.RecordBatch], epochs: int = 8) -> ByteNetwork:
        """Learns from batches of id, text, label; no more than PER_DOC windows of each text are held."""
        rng = np.random.default_rng(self.seed)
        parts, names = [np.zeros((0, LENGTH + WIDEST - 1), np.int16)], []
        for batch in batches:
            buf, bounds = text_bytes(batch.column(1))
            said = batch.column(2).to_pylist()
            for i, j in pieces(bounds, PIECE_BYTES):
                window, doc, _ = byte_windows(buf[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                some = [w for own in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1) for w in rng.permutation(own)[:PER_DOC].tolist()]
                parts.append(window[some].astype(np.int16))
                names += [str(said[i + d]) for d in doc[some].tolist()]
        self.langs = sorted(set(names))
        window, label = np.concatenate(parts), np.array([self.langs.index(y) for y in names], np.int64)
        f = FILTERS * len(WIDTHS)
        mask = self._mask()
        self.weights = {
            "embed": rng.normal(0, 0.5, (257, EMBED)).astype(np.float32), "filter": (rng.normal(0, 0.3, (WIDEST * EMBED, f)) * mask).astype(np.float32),
            "bias": np.zeros(f, np.float32), "out": rng.normal(0, 0.3, (f, len(self.langs))).astype(np.float32), "out_bias": np.zeros(len(self.langs), np.float32),
        }
        self.weights["embed"][PAD] = 0
        if len(self.langs) < 2:
            return self
        w, optimiser = self.weights, Adam(self.weights, 4e-3)
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(window)), max(1, len(window) // 64)):
                n, cells = len(part), window[part].astype(np.int64)
                cut = rng.integers(12, LENGTH + 1, n)  # short texts are seen too
                cells[np.arange(cells.shape[1]) >= np.where(rng.random(n) < 0.3, cut, LENGTH)[:, None]] = PAD
                columns = self._columns(cells)
                maps = (columns @ w["filter"]).reshape(n, LENGTH, f)
                at = maps.argmax(1)
                peak = np.take_along_axis(maps, at[:, None], 1)[:, 0] + w["bias"]
                pooled = np.maximum(peak, 0)
                slope = softmax(pooled @ w["out"] + w["out_bias"])
                slope[np.arange(n), label[part]] -= 1
                slope /= n
                below = slope @ w["out"].T * (peak > 0)
                picked = columns.reshape(n, LENGTH, -1)[np.arange(n)[:, None], at]  # [n, f, WIDEST * EMBED]
                seen = (below[:, :, None] * w["filter"].T[None]).reshape(n, f, WIDEST, EMBED)
                embed = np.zeros_like(w["embed"])
                np.add.at(embed, cells[np.arange(n)[:, None, None], at[:, :, None] + np.arange(WIDEST)], seen)
                embed[PAD] = 0
                optimiser.update({"embed": embed, "filter": np.einsum("nf,nfc->cf", below, picked) * mask, "bias": below.sum(0), "out": pooled.T @ slope, "out_bias": slope.sum(0)})
        return self

    def predict(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and probability of each text: window logits averaged by window size."""
        n = len(bounds) - 1
        total, weight = np.zeros((n, len(self.langs))), np.zeros(n)
        window, doc, length = byte_windows(buf, bounds)
        for s in range(0, len(window), 4096):
            logits = self.logits(window[s : s + 4096])
            np.add.at(total, doc[s : s + 4096], logits * length[s : s + 4096, None])
            np.add.at(weight, doc[s : s + 4096], length[s : s + 4096])
        p = softmax(total / np.maximum(weight, 1)[:, None])
        best = p.argmax(1)
        known = has_letter(buf, bounds)
        return [self.langs[k] if ok else "und" for k, ok in zip(best.tolist(), known.tolist(), strict=True)], np.where(known, p[np.arange(n), best], 0.0)


def has_letter(buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which texts hold a letter of any script."""
    ascii_ = np.concatenate([[0], np.cumsum((buf < 128) & _LETTER[buf & 127])])
    found = ascii_[bounds[1:]] > ascii_[bounds[:-1]]
    for k in np.flatnonzero(~found & (np.diff(bounds) > 0)).tolist():
        found[k] = any(c.isalpha() for c in buf[bounds[k] : bounds[k + 1]].tobytes().decode(errors="replace"))
    return found


def train_language(docs: DataFrame, rows: int = ROWS, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> ByteNetwork:
    """A network fitted on at most `rows` documents outside the held-out fold (crc32 of doc_id modulo 5 is 0), with at
    most PER_DOC windows of each, drawn from the whole text."""
    learnt = docs.select(F.col(doc_id), F.col(lang).alias("label")).where((crc_rest(doc_id, 5) != 0) & F.col("label").isNotNull())
    return fitted(labelled_sample(docs, learnt, rows, doc_id, text), ByteNetwork().fit)


def identify_language(docs: DataFrame, network: ByteNetwork, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score.

    Whole texts are read, in windows of LENGTH bytes. Texts that are null or hold no letter are `und` with score 0, and so
    is every text if nothing was learnt. A null doc_id is not held out; rows that repeat get equal results; an empty
    table gives no rows; other columns are not read.
    """

    def score(buf: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        if not network.langs:
            return [pa.array(["und"] * (len(bounds) - 1)), pa.array(np.zeros(len(bounds) - 1))]
        langs, p = network.predict(buf, bounds)
        return [pa.array(langs, pa.string()), pa.array(p)]

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = map_batches(rows, by_piece(score, ["doc_id", "lang_pred", "score"]), "doc_id long, lang_pred string, score double")
    return found.select("doc_id", F.coalesce(crc_rest("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify_language(docs, train_language(docs))
