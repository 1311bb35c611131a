"""Benchmark decontamination with a distributed positional inverted index.

Training documents are indexed in segments of bounded size, each one row of a stored table: the sorted (term, position)
postings of its documents. Test phrases are answered segment by segment by intersecting offset-adjusted posting lists,
rarest term first. Terms are 64-bit hashes of words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, map_batches, mix, pack_sorted, pieces, saved, saved_parts, text_bytes, unpack, windows, words

WINDOW = 13
SEGMENT_BYTES = 4 << 20
#: Test items are searched for in blocks of about so many bytes of text, which is what driver and tasks hold of them.
BLOCK_BYTES = 4 << 20
PHRASES = 1 << 16  # phrases whose lists are looked up at once
INDEX_SCHEMA = "segment long, doc_ids array<long>, n_words array<int>, terms binary, postings binary"


def _rank(hashes: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the hashes that the sorted vocabulary holds, and their places in it."""
    if not len(vocabulary):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.uint64(0xFFFF)
    seen = np.zeros(1 << 16, bool)
    seen[(vocabulary & low).astype(np.int64)] = True
    at = np.flatnonzero(seen[(hashes & low).astype(np.int64)])
    place = np.minimum(np.searchsorted(vocabulary, hashes[at]), len(vocabulary) - 1)
    hit = vocabulary[place] == hashes[at]
    return at[hit], place[hit]


def _indexer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    segment = TaskContext.get().partitionId() << 32
    for batch in batches:
        ids = batch.column(0)
        buf, bounds = text_bytes(batch.column(1))
        for i, j in pieces(bounds, SEGMENT_BYTES):
            found = words(buf[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], ALNUM, lower=True)
            terms, place = np.unique(found.hashes, return_inverse=True)
            postings = (place.astype(np.uint64) << np.uint64(32)) | np.arange(len(place), dtype=np.uint64)
            postings.sort()
            yield pa.record_batch(
                [pa.array([segment]), pa.array([ids[i:j].to_pylist()], pa.list_(pa.int64())), pa.array([found.counts.astype(np.int32)], pa.list_(pa.int32())),
                 pa.array([pack_sorted(terms)]), pa.array([pack_sorted(postings)])],
                ["segment", "doc_ids", "n_words", "terms", "postings"],
            )
            segment += 1


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index of all words of docs, which serves any test items."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return saved(map_batches(rows, _indexer, INDEX_SCHEMA), "positional-index")


class Phrases:
    """Windows of a block of test items: each distinct window once, with its terms and the items that hold it, in arrays."""

    def __init__(self, names: list[str], buf: np.ndarray, bounds: np.ndarray, window: int):
        found = words(buf, bounds, ALNUM, lower=True)
        per = np.where(found.counts > 0, np.maximum(1, found.counts - window + 1), 0)
        item = np.repeat(np.arange(len(names)), per)
        start = found.offsets[item] + np.arange(len(item)) - np.repeat(np.cumsum(per) - per, per)
        length = np.minimum(window, found.counts)[item]
        one, two = np.zeros(len(item), np.uint64), np.zeros(len(item), np.uint64)
        for n in np.unique(length).tolist():  # two fingerprints tell windows apart
            own = length == n
            one[own], two[own] = windows(found.hashes, n)[start[own]], windows(mix(found.hashes + np.uint64(1)), n)[start[own]]
        order = np.lexsort((item, two, one))
        one, two, item = one[order], two[order], item[order]
        new = np.ones(len(order), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        first = np.flatnonzero(new)
        self.window, self.names = window, names
        self.item, self.bounds = item, np.append(first, len(order))
        self.lengths = length[order][first].astype(np.int64)
        self.vocabulary, place = np.unique(found.hashes, return_inverse=True)
        self.place, self.start = place.astype(np.int32), start[order][first]

    def holders(self, phrase: int) -> set[str]:
        return {self.names[k] for k in self.item[self.bounds[phrase] : self.bounds[phrase + 1]].tolist()}

    def parts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Some phrases at a time: the first one, the places of their terms in the vocabulary, and which of those are real."""
        for s in range(0, len(self.lengths), PHRASES):
            real = np.arange(self.window) < self.lengths[s : s + PHRASES, None]
            at = np.minimum(self.start[s : s + PHRASES, None] + np.arange(self.window), len(self.place) - 1)
            yield s, np.where(real, self.place[at], -1), real


def _lists(phrases: Phrases, terms: np.ndarray, postings: np.ndarray):
    """For some phrases at a time: the first one, the segment's list of every term (-1: none), list bounds, each phrase's
    offsets from rarest to commonest, and the phrases whose terms all have a list."""
    at, place = _rank(phrases.vocabulary, terms)
    local = np.full(len(phrases.vocabulary) + 1, -1, np.int64)
    local[at] = place
    bounds = np.searchsorted(postings, np.arange(len(terms) + 1, dtype=np.uint64) << np.uint64(32))
    sizes = np.append(np.diff(bounds), [np.iinfo(np.int64).max, 0])  # -2: no such offset; -1: no posting
    for first, places, real in phrases.parts():
        lists = np.where(real, local[places], -2)
        yield first, lists, bounds, np.argsort(sizes[lists], axis=1, kind="stable"), np.flatnonzero((lists != -1).all(1))


def find_phrases(phrases: Phrases, terms: np.ndarray, postings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (phrase, start) whose terms follow each other from start, by intersecting from the rarest list on."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for base, lists, bounds, order, alive in _lists(phrases, terms, postings):
        rarest = order[alive, 0]
        first = lists[alive, rarest]
        counts = bounds[first + 1] - bounds[first]
        which = np.repeat(alive, counts)
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        position = (postings[np.repeat(bounds[first], counts) + inner] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        start = position - np.repeat(rarest, counts)
        keep = start >= 0
        which, start = which[keep], start[keep]
        for k in range(1, phrases.window):
            if not len(which):
                break
            offset = order[which, k]
            term = lists[which, offset]
            more = term >= 0  # shorter phrases are through
            wanted = (term.astype(np.uint64) << np.uint64(32)) | (start + offset).astype(np.uint64)
            spot = np.minimum(np.searchsorted(postings, wanted), len(postings) - 1)
            keep = ~more | (postings[spot] == wanted)
            which, start = which[keep], start[keep]
        found.append((which + base, start))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def find_near(phrases: Phrases, terms: np.ndarray, postings: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """All (phrase, position of its rarest term) with every other term at most slop words away, in any order."""
    whole, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    low = np.uint64(0xFFFFFFFF)
    for base, lists, bounds, order, alive in _lists(phrases, terms, postings):
        for row in alive:
            own = lists[row, order[row, : phrases.lengths[base + row]]]
            at = (postings[bounds[own[0]] : bounds[own[0] + 1]] & low).astype(np.int64)
            for term in np.unique(own[1:]):
                other = (postings[bounds[term] : bounds[term + 1]] & low).astype(np.int64)
                k = np.searchsorted(other, at - slop)
                at = at[(k < len(other)) & (other[np.minimum(k, len(other) - 1)] <= at + slop)]
                if not len(at):
                    break
            whole.append(np.full(len(at), base + row))
            places.append(at)
    return np.concatenate(whole), np.concatenate(places)


def _segments(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for k in range(batch.num_rows):
            terms, postings = (np.cumsum(unpack(batch.column(c)[k].as_py()), dtype=np.uint64) for c in (3, 4))
            counts = np.array(batch.column(2)[k].as_py(), np.int64)
            yield batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), counts, terms, postings


HIT_SCHEMA = "segment long, place int, spans array<struct<start:int,stop:int>>, items array<string>"


def _searcher(block: Callable[[], Phrases]):
    """The documents of each segment in which phrases occur: spans of words that are hit, and the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        phrases = block()
        for segment, _, counts, terms, postings in _segments(batches):
            which, start = find_phrases(phrases, terms, postings)
            offsets = np.concatenate([[0], np.cumsum(counts)])
            doc = np.searchsorted(offsets, start, "right") - 1
            stop = start + phrases.lengths[which]
            keep = stop <= offsets[np.minimum(doc + 1, len(counts))]
            which, start, stop, doc = which[keep], start[keep], stop[keep], doc[keep]
            spans, items = {}, {}
            for k in np.lexsort((start, doc)).tolist():
                d = int(doc[k])
                s, e = int(start[k] - offsets[d]), int(stop[k] - offsets[d])
                own = spans.setdefault(d, [])
                if own and s <= own[-1]["stop"]:
                    own[-1]["stop"] = max(e, own[-1]["stop"])
                else:
                    own.append({"start": s, "stop": e})
                items.setdefault(d, set()).update(phrases.holders(int(which[k])))
            yield pa.record_batch(
                [pa.array([segment] * len(spans), pa.int64()), pa.array(list(spans), pa.int32()), pa.array(list(spans.values()), span), pa.array([sorted(items[d]) for d in spans], pa.list_(pa.string()))],
                ["segment", "place", "spans", "items"],
            )

    return run


def _item_blocks(items: DataFrame, window: int, item_id: str, text: str) -> Iterator[Callable[[], Phrases]]:
    """Blocks of test items, one of them at a time in the driver, as what makes their phrases in a task."""
    rows = items.where(F.col(item_id).isNotNull() & F.col(text).isNotNull()).select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("string").alias("t")).distinct()
    rows = saved(rows, "test-items")
    n = -(-(rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // BLOCK_BYTES) or 1
    for b in range(n):
        table = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b).toArrow()
        names = table["i"].to_pylist()
        buf, bounds = text_bytes(table["t"])
        yield lambda names=names, buf=buf, bounds=bounds: Phrases(names, buf, bounds, window)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", share: int = 20) -> DataFrame:
    """One row per row of docs: doc_id, n_words, spans and n_hit, items, n_items, items_sha256, contaminated.

    A word is hit if it lies in an occurrence of a window of an item (`window` consecutive item words; all words of a
    shorter item). A document is contaminated if share * n_hit reaches n_words and something is hit.

    Null and empty texts have no words, hits or items; items without id, text or words are left out; items that repeat
    count once per id; each of several rows of one doc_id keeps its own row; without items nothing is hit; other
    columns of either table are not read. Segments are bounded in bytes, so a very long text is a segment of its own.
    The index is read once for each BLOCK_BYTES of items.
    """
    index = build_index(docs, doc_id, text)
    blocks = _item_blocks(items, window, item_id, item_text)
    hits = saved_parts((map_batches(index.select("segment", "doc_ids", "n_words", "terms", "postings"), _searcher(block), HIT_SCHEMA) for block in blocks), "phrase-hits")
    per = hits.groupBy("segment", "place").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("place", "x")).select("segment", "place", F.col("x.doc_ids").alias("doc_id"), F.col("x.n_words").cast("long").alias("n_words"))
    found = rows.join(per, ["segment", "place"], "left")
    covered = F.expr("size(array_distinct(flatten(transform(spans, s -> sequence(s.start, s.stop - 1)))))")
    found = found.withColumns({
        "n_hit": F.when(F.col("spans").isNull(), F.lit(0)).otherwise(covered).cast("long"),
        "items": F.coalesce("items", F.array().cast("array<string>")), "spans": F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")),
    })
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "spans", "items",
    )


def proximity(docs: DataFrame, items: DataFrame, slop: int, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, position: where all words of a window of the item lie within slop words of its rarest word.

    Order does not matter. Null and empty texts and items are never near; an item that repeats, and ties, give one row a
    place; each of several rows of one doc_id gives its own rows under that id; empty tables give no rows; other columns
    are not read.
    """

    def searcher(block: Callable[[], Phrases]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases = block()
            for _, ids, counts, terms, postings in _segments(batches):
                gaps = np.repeat(np.arange(len(counts)), counts) * (slop + 1)  # no match across documents
                moved = postings.copy()
                moved += gaps[(postings & np.uint64(0xFFFFFFFF)).astype(np.int64)].astype(np.uint64)
                which, at = find_near(phrases, terms, moved, slop)
                base = np.concatenate([[0], np.cumsum(counts)])[:-1] + np.arange(len(counts)) * (slop + 1)
                doc = np.searchsorted(base, at, "right") - 1
                rows = sorted({(ids[d], item, p) for w, d, p in zip(which, doc.tolist(), (at - base[doc]).tolist(), strict=True) for item in phrases.holders(int(w))}, key=str)
                yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.int64()))], ["doc_id", "item_id", "position"])

        return run

    index = build_index(docs, doc_id, text)
    blocks = _item_blocks(items, window, item_id, item_text)
    return saved_parts((map_batches(index, searcher(block), "doc_id long, item_id string, position long") for block in blocks), "near-phrases")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, items).drop("spans", "items")


_SPLIT = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP9_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce({_SPLIT.format("text")}, []) AS w FROM documents),
i AS (SELECT item_id, {_SPLIT.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, n, s, item_id FROM dw JOIN iw USING (n, t)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY 1),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)"""
