"""What several training-data operators share: shared storage, byte tokenisation and packing."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import functools
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java and DuckDB pattern of a word: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it; on one machine a folder of its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is unset: executors elsewhere need a folder that they share with the driver")
    spark.sparkContext.setCheckpointDir("/tmp/skyshuffle-shared")
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


_SCOPE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("tables", default=None)


@contextlib.contextmanager
def tables() -> Iterator[list[str]]:
    """The paths of the tables that saved() writes in this block and thread; an outer block learns of those that are left."""
    own: list[str] = []
    outer = _SCOPE.get()
    token = _SCOPE.set(own)
    try:
        yield own
    finally:
        _SCOPE.reset(token)
        if outer is not None:
            outer.extend(own)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage is cut and lost executors cost nothing.

    Results are lazy, so the table stays until drop_tables() is told that nothing reads it any more.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    if (own := _SCOPE.get()) is not None:
        own.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def saved_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """One table of all parts, which are written one after the other; there is one at least."""
    path = df = None
    for df in parts:
        if path is None:
            path = f"{shared_dir(df.sparkSession).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
            if (own := _SCOPE.get()) is not None:
                own.append(path)
        df.write.mode("append").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Deletes stored tables whose readers are done, and empties the list."""
    while paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def few(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows."""
    return df.limit(rows + 1).count() <= rows


def ascii_lower(col):
    """Lower-cases A-Z only."""
    return F.translate(col, UPPER, LOWER)


def word_count(col):
    """Number of words in a text column; null has none."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


# --- byte tokenisation -------------------------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []
HASH_BYTES = 1 << 19  # text that is hashed at once: a worker that is used again keeps what it once allocated


def _geometric(ratio: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    k = 1
    while k < n:
        m = min(k, n - k)
        np.multiply(out[:m], np.uint64(pow(ratio, k, 1 << 64)), out=out[k : k + m])
        k += m
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > HASH_BYTES:  # one very long word: nothing so large is kept
        return _geometric(_BASE, n), _geometric(_INVERSE, n)
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _POWERS[:] = [_geometric(_BASE, size), _geometric(_INVERSE, size)]
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every bit of the result depends on every bit of x."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(kind: str) -> np.ndarray:
    """Which bytes belong to words. space: all but ASCII white space. alnum: digits, ASCII letters, all non-ASCII."""
    table = np.ones(256, bool)
    if kind == "space":
        table[[9, 10, 11, 12, 13, 32]] = False
    else:
        table[:128] = False
        table[48:58] = table[65:91] = table[97:123] = True
    return table


def _values(lower: bool) -> np.ndarray:
    values = np.arange(1, 257, dtype=np.uint64)
    if lower:
        values[65:91] = values[97:123]
    return values


SPACE, ALNUM = byte_table("space"), byte_table("alnum")
_CASED, _LOWERED = _values(False), _values(True)


class Words:
    """Words of many texts: byte starts and ends in buf, 64-bit hashes, the text of each, words per text."""

    __slots__ = ("buf", "starts", "ends", "hashes", "doc", "counts", "offsets")

    def __init__(self, buf, starts, ends, hashes, doc, counts):
        self.buf, self.starts, self.ends, self.hashes, self.doc, self.counts = buf, starts, ends, hashes, doc, counts
        self.offsets = np.concatenate([[0], np.cumsum(counts)])


def words(buf: np.ndarray, bounds: np.ndarray, table: np.ndarray = SPACE, lower: bool = False) -> Words:
    """Words of the texts buf[bounds[i]:bounds[i + 1]], by whole-array operations."""
    n = len(buf)
    inside = table[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = bounds[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes, values = np.empty(len(starts), np.uint64), _LOWERED if lower else _CASED
    a = 0
    while a < len(starts):  # a word's hash does not depend on where it stands, so runs of words are hashed one by one
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + HASH_BYTES - 1, "right")))
        low, size = starts[a], int(ends[b - 1] - starts[a])
        up, down = _powers(size + 1)
        total = np.empty(size + 1, np.uint64)
        total[0] = 0
        weighted = values[buf[low : low + size]]
        weighted *= up[:size]
        np.cumsum(weighted, out=total[1:])
        hashes[a:b] = (total[ends[a:b] - low] - total[starts[a:b] - low]) * down[starts[a:b] - low]
        a = b
    hashes += (ends - starts).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)
    counts = np.diff(np.searchsorted(starts, bounds))
    return Words(buf, starts, ends, mix(hashes), np.repeat(np.arange(len(counts)), counts), counts)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of width consecutive hashes."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[j : j + n]
    out += np.uint64(width)
    return mix(out)


# --- Arrow and packing -------------------------------------------------------------------------------------------

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20  # of one Arrow batch, where the cluster does not say otherwise; a longer text is a batch of its own


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run over batches; a worker that is used again keeps nothing of what the task has freed."""

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return wrapped


def lean_group(run: Callable) -> Callable:
    """The same for a function of one large group."""

    @functools.wraps(run)
    def wrapped(group):
        try:
            return run(group)
        finally:
            _give_back()

    return wrapped


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow in batches of bounded size, with lean workers. The session setting stays, as results are lazy."""
    spark = df.sparkSession
    if spark.sparkContext.getConf().get(BATCH_SETTING) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(lean(run), schema)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the bounds of each value; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, bounds - bounds[0]


def pieces(bounds: np.ndarray, size: int):
    """Ranges of texts of about size bytes each; a longer text is a range of its own."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    used = 8
    while used > 1 and not planes[used - 1].any():
        used -= 1
    return zstandard.ZstdCompressor(level=1).compress(bytes([used]) + planes[:used].tobytes())


def unpack(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    used = int(raw[0])
    n = (len(raw) - 1) // used
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :used] = raw[1:].reshape(used, n).T
    return planes.reshape(-1).view("<u8") if n else np.zeros(0, np.uint64)


SUM_SCHEMA, SUM_TASKS = "slice int, part int, data binary", 1024  # tasks whose sums are added at once


def _add_packed(pdf: pd.DataFrame) -> pd.DataFrame:
    total = unpack(pdf["data"].iloc[0]).copy()
    for data in pdf["data"].iloc[1:]:
        total += unpack(data)
    return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "part": pdf["part"].iloc[:1], "data": [pack(total)]})


def summed(found: DataFrame) -> DataFrame:
    """Sums of packed vectors of found(slice, part, data), one row a slice; modulo 2**64. part is the task's number divided
    by SUM_TASKS, so that no group of the two levels of sums is large."""
    for keys in (("slice", "part"), ("slice",)):
        found = found.groupBy(*keys).applyInPandas(lean_group(_add_packed), SUM_SCHEMA)
    return found


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers, by their differences."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)
