"""Texts in stored chunks, and the exchange of fingerprints between them.

Counting how often each of billions of fingerprints occurs by shuffling one row each is dear. Here each chunk of a few
MB of text sends every group its own sorted distinct fingerprints as one packed blob, and gets back one small answer per
blob, in the same order. The chunk table is written once, so that chunks are the same in every pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, pieces, saved, text_bytes

CHUNK_BYTES = 2 << 20
CHUNK_SCHEMA = "chunk long, doc_ids array<long>, bounds binary, blob binary, rest binary"
NO_ID = np.iinfo(np.int64).max  # null doc_ids come after all others


def squeeze(data: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return squeeze(sink.getvalue().to_pybytes())


def rest_of(row: dict) -> pa.RecordBatch:
    """The other columns that a chunk's rows carry along."""
    with pa.ipc.open_stream(expand(row["rest"])) as reader:
        return reader.read_next_batch()


def _chunker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        batch = batch.sort_by([("doc_id", "ascending")])  # null ids last
        buf, bounds = text_bytes(batch.column(1))
        for i, j in pieces(bounds, CHUNK_BYTES):
            part = bounds[i : j + 1] - bounds[i]
            rest = pa.record_batch([c[i:j] for c in batch.columns[2:]], batch.schema.names[2:])
            yield pa.record_batch(
                [pa.array([chunk]), pa.array([batch.column(0)[i:j].to_pylist()], pa.list_(pa.int64())), pa.array([squeeze(part.astype("<i8").tobytes())]), pa.array([squeeze(buf[bounds[i] : bounds[j]].tobytes(), 3)], pa.binary()),
                 pa.array([_ipc(rest) if rest.num_columns else None], pa.binary())],
                ["chunk", "doc_ids", "bounds", "blob", "rest"],
            )
            chunk += 1


def chunk_table(docs: DataFrame, doc_id: str, text: str, carry: bool = False) -> DataFrame:
    """Stored chunks of about CHUNK_BYTES of text, each sorted by doc_id; a longer text is a chunk of its own.

    With carry, chunks also hold whether the text was null and all other columns of docs, under made-up names.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
        *([F.col(text).isNull().alias("was_null"), *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns) if c not in (doc_id, text))] if carry else []),
    )
    return saved(map_batches(rows, _chunker, CHUNK_SCHEMA), "chunks")


def load(row: dict) -> tuple[np.ndarray, list, np.ndarray, np.ndarray]:
    """doc_ids with NO_ID for null, doc_ids as they are, text bytes, text bounds of a chunk."""
    ids = row["doc_ids"]
    known = np.array([NO_ID if x is None else x for x in ids], np.int64)
    return known, ids, np.frombuffer(expand(row["blob"]), np.uint8), np.frombuffer(expand(row["bounds"]), "<i8")


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of batches as dicts, one at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(c)[k].as_py() for c, name in enumerate(batch.schema.names)}


def answered(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """chunks with the answers to each: an array of (group, answer)."""
    per = answers.groupBy("chunk").agg(F.collect_list(F.struct("group", "answer")).alias("answers"))
    return chunks.join(per, "chunk", "left")
