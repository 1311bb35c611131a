"""Substring dedup with prefix-partitioned suffix trees.

Every position that starts a full window is a suffix, and every suffix belongs to a group: that of its shortest word
prefix (of DEPTHS words, at last of a whole window) that few enough suffixes share. A prefix that too many share is
extended, level by level, so groups fit in memory at any corpus size; groups are packed into bins. A bin's subtree is cut
at the window's length (a truncated suffix tree) and kept as its sorted leaves, the edge from the group's prefix down to
that depth as a 64-bit fingerprint of the words: equal neighbours are the leaves below one node of window depth. Longer
repeats are followed along suffix links: the window that starts one word later. What consecutive windows share with one
first document is a maximal repeat with it.

Fingerprints are compared within a bin alone: over n suffixes and bins of BIN_SUFFIXES, n * BIN_SUFFIXES / 2**65 unlike
pairs are expected to agree: less than one over 10**13 suffixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import answered, chunk_table, expand, load, rest_of, rows_of, squeeze
from .common import SUM_SCHEMA, SUM_TASKS, Words, lean_group, map_batches, mix, pack, pack_sorted, summed, unpack, unpack_sorted, windows, words

WINDOW = 13
BIN_SUFFIXES = 2_000_000  # suffixes that one task holds
DEPTHS = (2, 4, 8)  # words of a prefix, level by level
MOST_HEADS = 1 << 20  # prefixes of one level that are extended, at most: each is shared by more than a MOST_HEADS-th of all suffixes
SLICE = 1 << 14  # prefixes whose counts travel together


def _share(hashes: np.ndarray, of) -> np.ndarray:
    """Evenly spread numbers below `of`."""
    return (((hashes >> np.uint64(32)) * np.asarray(of, np.uint64)) >> np.uint64(32)).astype(np.int64)


class Prefixes:
    """The prefixes that groups stand for, as a tree of hash buckets: a bucket that more than `limit` suffixes share is
    extended, by buckets of its longer prefixes in proportion to its size."""

    def __init__(self, window: int, expected: int, bin_suffixes: int):
        self.depths = tuple(d for d in DEPTHS if d < window) + (window,)
        self.limit = max(bin_suffixes // 4, expected // MOST_HEADS)
        self.sizes = [1 << (4 * expected // max(1, self.limit)).bit_length()]  # buckets of each level
        self.heads: list[np.ndarray] = []  # of each level but the last: buckets that are extended, ascending
        self.base: list[np.ndarray] = []  # their first bucket of the next level
        self.fan: list[np.ndarray] = []  # and how many of those they have

    def extend(self, heads: np.ndarray, counts: np.ndarray) -> None:
        fan = np.left_shift(1, np.ceil(np.log2(4 * counts / max(1, self.limit))).astype(np.int64))
        self.heads.append(heads)
        self.fan.append(fan)
        self.base.append(np.cumsum(fan) - fan)
        self.sizes.append(int(fan.sum()))

    def place(self, found: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Level and bucket of the suffixes that start at the given words."""
        bucket, level = _share(windows(found.hashes, self.depths[0])[at], self.sizes[0]), np.zeros(len(at), np.int64)
        for k, heads in enumerate(self.heads):
            rows = np.flatnonzero(level == k)
            spot = np.minimum(np.searchsorted(heads, bucket[rows]), len(heads) - 1)
            hit = heads[spot] == bucket[rows]
            rows, spot = rows[hit], spot[hit]
            longer = windows(found.hashes, self.depths[k + 1])[at[rows]]
            bucket[rows] = self.base[k][spot] + _share(longer, self.fan[k][spot])
            level[rows] = k + 1
        return level, bucket


def _starts(found: Words, window: int) -> np.ndarray:
    """Positions that start a window inside one text."""
    n = len(found.hashes) - window + 1
    return np.flatnonzero(found.doc[:n] == found.doc[window - 1 :]) if n > 0 else np.zeros(0, np.int64)


def _counter(window: int, prefixes: Prefixes):
    """How many suffixes each bucket of the last level has, in packed slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = len(prefixes.heads), TaskContext.get().partitionId() // SUM_TASKS
        counts = np.zeros(-(-prefixes.sizes[last] // SLICE) * SLICE, np.int64)
        for row in rows_of(batches):
            _, _, buf, bounds = load(row)
            found = words(buf, bounds)
            level, bucket = prefixes.place(found, _starts(found, window))
            counts += np.bincount(bucket[level == last], minlength=len(counts))
        slices = counts.reshape(-1, SLICE)
        some = np.flatnonzero(slices.any(1))
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array([part] * len(some), pa.int32()), pa.array([pack(slices[k]) for k in some], pa.binary())], ["slice", "part", "data"])

    return run


def _crowded(limit: int):
    """Of each slice: its sum as bucket -1, and the buckets above the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            counts = unpack(row["data"]).astype(np.int64)
            over = np.flatnonzero(counts > limit)
            yield pa.record_batch([pa.array(np.append(over + row["slice"] * SLICE, -1)), pa.array(np.append(counts[over], counts.sum()))], ["bucket", "n"])

    return run


def plan_groups(chunks: DataFrame, window: int) -> tuple[Prefixes, int]:
    """The prefixes of a corpus's groups, and how many bins the groups go to. The driver gets extended prefixes alone."""
    expected = (chunks.agg(F.sum(F.length("blob"))).first()[0] or 0) // 3  # words; a size for the first level
    prefixes, total = Prefixes(window, expected, BIN_SUFFIXES), None
    while True:
        sums = summed(map_batches(chunks, _counter(window, prefixes), SUM_SCHEMA))
        found = map_batches(sums, _crowded(prefixes.limit), "bucket long, n long").toArrow()
        bucket, n = (found.column(c).to_numpy().astype(np.int64) for c in range(2))
        total = int(n[bucket < 0].sum()) if total is None else total
        heads = bucket >= 0
        if not heads.any() or len(prefixes.heads) + 1 == len(prefixes.depths):
            return prefixes, max(1, -(-total // BIN_SUFFIXES))
        order = np.argsort(bucket[heads])
        prefixes.extend(bucket[heads][order], n[heads][order])


def _leaves(found: Words, window: int, prefixes: Prefixes, bins: int):
    """A chunk's suffixes by bin and fingerprint: positions in that order, bins, fingerprints, starts of equal ones."""
    at = _starts(found, window)
    level, bucket = prefixes.place(found, at)
    place = _share(mix((level.astype(np.uint64) << np.uint64(56)) | bucket.astype(np.uint64)), bins)
    full = windows(found.hashes, window)[at]
    order = np.argsort(full, kind="stable")
    order = order[np.argsort(place[order].astype(np.uint16) if bins < 1 << 16 else place[order], kind="stable")]
    place, full = place[order], full[order]
    new = np.ones(len(full), bool)
    new[1:] = (full[1:] != full[:-1]) | (place[1:] != place[:-1])
    return at[order], place, full, np.flatnonzero(new)


def _sender(window: int, prefixes: Prefixes, bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            ids, _, buf, bounds = load(row)
            found = words(buf, bounds)
            at, place, full, first = _leaves(found, window, prefixes, bins)
            owner = ids[found.doc[at[first]]]  # sorted by doc_id within the chunk, so the smallest
            low = ids[:1].astype(np.uint64)
            place, full = place[first], full[first]
            cuts = np.flatnonzero(np.diff(place, prepend=-1))
            out = [(int(place[a]), pack_sorted(full[a:b]), pack(owner[a:b].astype(np.uint64) - low)) for a, b in zip(cuts, np.append(cuts[1:], len(place)), strict=True)]
            yield pa.record_batch(
                [pa.array([r[0] for r in out], pa.int32()), pa.array([row["chunk"]] * len(out), pa.int64()), pa.array([int(ids[0])] * len(out), pa.int64()), pa.array([r[1] for r in out], pa.binary()), pa.array([r[2] for r in out], pa.binary())],
                ["group", "chunk", "low", "leaves", "owners"],
            )

    return run


def _subtree(pdf: pd.DataFrame) -> pd.DataFrame:
    """A bin's subtree: for each chunk's leaf, whether its node at window depth holds a smaller document than the chunk's
    own, and for those the smallest."""
    leaves = [unpack_sorted(x) for x in pdf["leaves"]]
    owners = [unpack(x) + np.array([low]).astype(np.uint64) for x, low in zip(pdf["owners"], pdf["low"], strict=True)]
    sizes = np.array([len(x) for x in leaves])
    leaf, owner = np.concatenate(leaves), np.concatenate(owners)
    del leaves, owners
    owner ^= np.uint64(1 << 63)  # signed order
    order = np.argsort(leaf, kind="stable")
    leaf, sorted_owner = leaf[order], owner[order]
    node = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1]])) if len(leaf) else np.zeros(0, np.int64)
    per = np.diff(np.append(node, len(leaf)))
    least = np.repeat(np.minimum.reduceat(sorted_owner, node) if len(node) else sorted_owner, per)
    flags, first = np.zeros(len(leaf), bool), np.zeros(len(leaf), np.uint64)
    flags[order] = sorted_owner > least
    first[order] = least
    out, end = [], np.cumsum(sizes)
    for k, (chunk, group) in enumerate(zip(pdf["chunk"], pdf["group"], strict=True)):
        own = flags[end[k] - sizes[k] : end[k]]
        if own.any():
            bits = squeeze(np.packbits(own).tobytes())
            held = first[end[k] - sizes[k] : end[k]][own]
            low = held.min()
            out.append((chunk, group, len(bits).to_bytes(4, "little") + bits + int(low).to_bytes(8, "little") + pack(held - low)))
    return pd.DataFrame(out, columns=["chunk", "group", "answer"]).astype({"chunk": "int64", "group": "int32"})


def repeated_windows(found: Words, ids: np.ndarray, window: int, prefixes: Prefixes, bins: int, answers: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """The words of a chunk that start a window which also starts in a document with a smaller id, ascending, and the
    smallest such id of each."""
    at, place, full, first = _leaves(found, window, prefixes, bins)
    sizes = np.diff(np.append(first, len(full)))
    doc = ids[found.doc[at]]
    least = doc[first] if len(first) else doc
    for answer in answers or []:
        a, b = np.searchsorted(place[first], [answer["group"], answer["group"] + 1])
        data = answer["answer"]
        cut = 4 + int.from_bytes(data[:4], "little")
        flags = np.unpackbits(np.frombuffer(expand(data[4:cut]), np.uint8), count=b - a).astype(bool)
        held = unpack(data[cut + 8 :]) + np.uint64(int.from_bytes(data[cut : cut + 8], "little"))
        least[a + np.flatnonzero(flags)] = (held ^ np.uint64(1 << 63)).view(np.int64)
    least = np.repeat(least, sizes)
    hit = np.flatnonzero(doc > least)
    hit = hit[np.argsort(at[hit])]
    return at[hit], least[hit]


def _covered(starts: np.ndarray, n: int, window: int) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + window, -1)
    return np.cumsum(step[:-1]) > 0


def joined_kept(found: Words, kept: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The kept words, each followed by one space, and the bounds of each text in that."""
    length = np.where(kept, found.ends - found.starts, 0)
    inside = np.zeros(len(found.buf) + 1, np.int8)
    s, e = found.starts[kept], found.ends[kept]
    inside[s] += 1
    inside[e] -= 1
    data = found.buf[np.cumsum(inside[:-1]).astype(bool)]
    ends = np.cumsum(length[kept])
    out = np.full(len(data) + len(ends), 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(len(ends)), length[kept])] = data
    per_text = np.concatenate([[0], np.cumsum(length + kept)])[found.offsets]
    return out.tobytes(), per_text


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _reporter(window: int, prefixes: Prefixes, bins: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            ids, as_given, buf, bounds = load(row)
            found = words(buf, bounds)
            kept = ~_covered(repeated_windows(found, ids, window, prefixes, bins, row["answers"])[0], len(found.starts), window)
            data, cut = joined_kept(found, kept)
            removed = found.counts - np.diff(np.concatenate([[0], np.cumsum(kept)])[found.offsets])
            texts = [data[a : max(a, b - 1)] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
            yield pa.record_batch(
                [pa.array(as_given, pa.int64()), pa.array(found.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                 pa.array([t.decode() for t in texts] if keep_text else [None] * len(texts), pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return run


def _rewriter(window: int, prefixes: Prefixes, bins: int):
    """Chunks as rows again, with the texts that lost words replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            ids, as_given, buf, bounds = load(row)
            found, rest = words(buf, bounds), rest_of(row)
            kept = ~_covered(repeated_windows(found, ids, window, prefixes, bins, row["answers"])[0], len(found.starts), window)
            data, cut = joined_kept(found, kept)
            changed = np.diff(np.concatenate([[0], np.cumsum(kept)])[found.offsets]) < found.counts
            raw, was_null = buf.tobytes(), rest.column(0).to_pylist()
            texts = [None if was_null[k] else data[cut[k] : max(cut[k], cut[k + 1] - 1)].decode() if changed[k] else raw[bounds[k] : bounds[k + 1]].decode() for k in range(len(ids))]
            yield pa.record_batch([pa.array(as_given, pa.int64()), pa.array(texts, pa.string()), pa.array(changed), *rest.columns[1:]], ["doc_id", "text", "changed", *rest.schema.names[1:]])

    return run


def _spanner(window: int, prefixes: Prefixes, bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            ids, as_given, buf, bounds = load(row)
            found = words(buf, bounds)
            start, owner = repeated_windows(found, ids, window, prefixes, bins, row["answers"])
            doc = found.doc[start]
            new = np.ones(len(start), bool)
            new[1:] = (np.diff(start) != 1) | (owner[1:] != owner[:-1]) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(start))[: len(first)] - 1
            base = found.offsets[doc[first]]
            yield pa.record_batch([pa.array([as_given[d] for d in doc[first].tolist()], pa.int64()), pa.array(start[first] - base), pa.array(start[last] + window - base), pa.array(owner[first])], ["doc_id", "start", "stop", "first_doc_id"])

    return run


def _grown(chunks: DataFrame, window: int) -> tuple[Prefixes, int, DataFrame]:
    """The groups of a corpus, and its chunks with the answers of all subtrees."""
    prefixes, bins = plan_groups(chunks, window)
    sent = map_batches(chunks, _sender(window, prefixes, bins), "group int, chunk long, low long, leaves binary, owners binary")
    dealt = sent.repartitionById(bins, F.col("group"))  # one bin a task: hashed bins would meet
    return prefixes, bins, answered(chunks, dealt.groupBy("group").applyInPandas(lean_group(_subtree), "chunk long, group int, answer binary"))


def maximal_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, stop, first_doc_id: words start (from 0) to stop, of `window` words at least, all of whose windows
    first stand in first_doc_id, the smallest doc_id that has them; it is smaller than doc_id. Extended by a word to either
    side, a row's windows would not all have that first document.

    Nulls, empty texts, null and repeated ids are treated as in dedup_substrings(); an empty table gives no rows.
    """
    prefixes, bins, chunks = _grown(chunk_table(docs, doc_id, text), window)
    return map_batches(chunks, _spanner(window, prefixes, bins), "doc_id long, start long, stop long, first_doc_id long")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256 and, with keep_text, the kept words.

    Removes every word covered by a window whose word sequence also starts in a document with a smaller doc_id.

    Null and empty texts have no words and keep the empty string; a null doc_id is greater than all others, and rows
    without id do not remove from each other; neither do rows that share a doc_id; an empty table gives no rows; other
    columns are not read. A window that very many documents hold reaches its bin once per chunk.
    """
    prefixes, bins, chunks = _grown(chunk_table(docs, doc_id, text), window)
    out = map_batches(chunks, _reporter(window, prefixes, bins, keep_text), RESULT)
    return out if keep_text else out.drop("kept")


def remove_substrings(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """docs with repeated windows removed as in dedup_substrings, all columns kept, and the name of an added boolean
    column that tells which texts changed. Those become their kept words joined by one space; others stay as they are.

    Null texts stay null; null and repeated ids, ties and empty tables are treated as in dedup_substrings().
    """
    flag = next(name for name in ("changed", *(f"changed{k}" for k in range(len(docs.columns) + 1))) if name not in docs.columns)
    prefixes, bins, chunks = _grown(chunk_table(docs, doc_id, text, carry=True), window)
    kinds = dict(zip(docs.columns, (f.dataType.simpleString() for f in docs.schema.fields), strict=True))
    inner = {c: {doc_id: "doc_id", text: "text"}.get(c, f"c{k}") for k, c in enumerate(docs.columns)}
    schema = ", ".join(["doc_id long", "text string", "changed boolean", *(f"{inner[c]} {kinds[c]}" for c in docs.columns if c not in (doc_id, text))])
    rows = map_batches(chunks, _rewriter(window, prefixes, bins), schema)
    return rows.select(*(F.col(inner[c]).cast(kinds[c]).alias(c) for c in docs.columns), F.col("changed").alias(flag)), flag


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
g AS (SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS t
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13)),
f AS (SELECT t, min(doc_id) AS m FROM g GROUP BY t HAVING count(DISTINCT doc_id) > 1),
r AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM g JOIN f USING (t) WHERE doc_id > m),
l AS (SELECT doc_id, list(p) AS ps FROM r GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(ps, x[2])), lambda x: x[1]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN l USING (doc_id)"""
