"""N-gram Jaccard join with a count-vector R-tree, and the components of its links.

Exact at every size. A pair at the threshold must share one of each side's rarest shingles (how rare is counted over the
whole corpus), which gives blocks of possible partners. Within a block, documents are points of group counts in an R-tree:
the sum of coordinate minima bounds the overlap, for single points and for whole boxes. Surviving pairs are verified on
their full shingle sets. Documents with equal sets are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import answered, chunk_table, expand, load, rows_of, squeeze
from .common import Words, lean, lean_group, map_batches, mix, pack, pack_sorted, saved, unpack, unpack_sorted, windows, words
from .components import components, rejoined

SHINGLE, GROUPS = 5, 256
PART_SHINGLES = 2_000_000
SEEDS, SEED_SHINGLES = 256, 500_000  # documents of a block in which first links are sought, and about how many shingles
SLOT = 512  # documents of one half of a block in the exact search
TILE, TILE_SHINGLES = 256, 250_000  # classes, and about how many shingles, of one half of a component whose links are counted
COLUMNS = 2048  # shingles that are multiplied at once


def needed(a, b):
    """Least intersection of sets of sizes a and b whose Jaccard similarity is 0.8 or more: 180 i >= 80 (a + b)."""
    return (4 * (a + b) + 8) // 9


class ShingleSets:
    """Distinct shingles of many texts: (doc, value) in order of doc and value, and the set sizes."""

    def __init__(self, found: Words, width: int = SHINGLE):
        values, docs = [], []
        full = windows(found.hashes, width)
        if len(full):
            at = np.flatnonzero(found.doc[: len(full)] == found.doc[width - 1 :])
            values.append(full[at])
            docs.append(found.doc[at])
        for n in range(1, width):  # short texts: the whole sequence
            short = np.flatnonzero(found.counts == n)
            if len(short):
                values.append(windows(found.hashes, n)[found.offsets[short]])
                docs.append(short)
        value = np.concatenate(values) if values else np.zeros(0, np.uint64)
        doc = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        order = np.argsort(value)
        doc, value = doc[order], value[order]
        order = np.argsort(doc.astype(np.uint16) if len(found.counts) < 1 << 16 else doc, kind="stable")
        doc, value = doc[order], value[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
        self.doc, self.value = doc[new], value[new]
        self.sizes = np.bincount(self.doc, minlength=len(found.counts)) if len(doc) else np.zeros(len(found.counts), np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])

    def of(self, k: int) -> np.ndarray:
        return self.value[self.offsets[k] : self.offsets[k + 1]]

    def reduce(self, ufunc, values: np.ndarray) -> np.ndarray:
        """ufunc over each set's values; 0 for empty sets."""
        out = np.zeros(len(self.sizes), values.dtype)
        some = np.flatnonzero(self.sizes)
        if len(some):
            out[some] = ufunc.reduceat(values, self.offsets[some])
        return out

    def counts(self) -> np.ndarray:
        """Shingles of each set in each hash group."""
        cell = self.doc * GROUPS + (self.value & np.uint64(GROUPS - 1)).astype(np.int64)
        return np.bincount(cell, minlength=len(self.sizes) * GROUPS).reshape(-1, GROUPS).astype(np.int32)


class CountTree:
    """R-tree of count vectors, bulk-loaded by set size and the two widest coordinates."""

    LEAF = 16

    def __init__(self, points: np.ndarray):
        self.points, self.sizes = points, points.sum(1).astype(np.int64)
        wide = np.argsort(-self.points.std(0), kind="stable")[:2] if len(points) else [0, 0]
        by_size = np.argsort(self.sizes, kind="stable")
        self.order = np.concatenate([s[np.lexsort((self.points[s][:, wide[1]], self.points[s][:, wide[0]]))] for s in np.array_split(by_size, max(1, len(points) // (self.LEAF * self.LEAF)))]) if len(points) else by_size
        self.levels = []  # from leaves up: coordinate maxima and least set size of each box
        top, least = self.points[self.order], self.sizes[self.order]
        while len(top) > self.LEAF:
            starts = np.arange(0, len(top), self.LEAF)
            top, least = np.maximum.reduceat(top, starts, axis=0), np.minimum.reduceat(least, starts)
            self.levels.append((top, least))

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """Points whose overlap bound with this one reaches what the threshold needs."""
        boxes = np.arange(len(self.levels[-1][0]) if self.levels else 0)
        for level in range(len(self.levels) - 1, -1, -1):
            top, least = self.levels[level]
            boxes = boxes[np.minimum(top[boxes], point).sum(1) >= needed(size, least[boxes])]
            below = len(self.levels[level - 1][0]) if level else len(self.order)
            boxes = (boxes[:, None] * self.LEAF + np.arange(self.LEAF)).ravel()
            boxes = boxes[boxes < below]
        at = self.order[boxes] if self.levels else self.order
        return at[np.minimum(self.points[at], point).sum(1) >= needed(size, self.sizes[at])]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two ascending sets."""
    if not len(a) or not len(b):
        return 0
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    return int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())


# --- corpus pass: how rare is each shingle -----------------------------------------------------------------------


def _sender(parts: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            _, _, buf, bounds = load(row)
            short, n = np.unique(ShingleSets(words(buf, bounds, lower=True)).value >> np.uint64(64 - bits), return_counts=True)
            group = _group(short, parts, bits)
            cuts = np.flatnonzero(np.diff(group, prepend=-1))
            out = [(int(group[a]), pack_sorted(short[a:b]), pack(n[a:b])) for a, b in zip(cuts, np.append(cuts[1:], len(group)), strict=True)]
            yield pa.record_batch([pa.array([r[0] for r in out], pa.int32()), pa.array([row["chunk"]] * len(out), pa.int64()), pa.array([r[1] for r in out], pa.binary()), pa.array([r[2] for r in out], pa.binary())], ["group", "chunk", "shingles", "counts"])

    return run


def _group(short: np.ndarray, parts: int, bits: int) -> np.ndarray:
    return (((short >> np.uint64(bits - 32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _rarity(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each chunk's shingles: 0 if no other document has it, else a step of the logarithm of how many do."""
    shingles, counts = [unpack_sorted(x) for x in pdf["shingles"]], [unpack(x) for x in pdf["counts"]]
    sizes = np.array([len(x) for x in shingles])
    value, n = np.concatenate(shingles), np.concatenate(counts)
    order = np.argsort(value, kind="stable")
    value = value[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    total = np.add.reduceat(n[order], first)
    code = np.where(total < 2, 0, np.minimum(255, np.ceil(8 * np.log2(np.maximum(total, 2).astype(float))))).astype(np.uint8)
    codes = np.zeros(len(value), np.uint8)
    codes[order] = np.repeat(code, np.diff(np.append(first, len(value))))
    end = np.cumsum(sizes)
    out = [(chunk, group, squeeze(own.tobytes())) for k, (chunk, group) in enumerate(zip(pdf["chunk"], pdf["group"], strict=True)) if (own := codes[end[k] - sizes[k] : end[k]]).any()]
    return pd.DataFrame(out, columns=["chunk", "group", "answer"]).astype({"chunk": "int64", "group": "int32"})


NODES = "doc_id long, n long, s1 long, s2 long, rare array<long>, seeds array<long>, counts binary, body binary"


def _describer(parts: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            _, ids, buf, bounds = load(row)
            sets = ShingleSets(words(buf, bounds, lower=True))
            short, back = np.unique(sets.value >> np.uint64(64 - bits), return_inverse=True)
            codes, group = np.zeros(len(short), np.uint8), _group(short, parts, bits)
            for answer in row["answers"] or []:
                a, b = np.searchsorted(group, [answer["group"], answer["group"] + 1])
                codes[a:b] = np.frombuffer(expand(answer["answer"]), np.uint8)
            codes = codes[back]
            n = sets.sizes
            lone = sets.reduce(np.add, (codes == 0).astype(np.int64))
            prefix = np.where(n > 0, n - (4 * n + 4) // 5 + 1, 0)
            shared = lone < prefix
            s1, s2 = sets.reduce(np.add, mix(sets.value)), sets.reduce(np.bitwise_xor, mix(sets.value + np.uint64(1)))
            seed1, seed2 = sets.reduce(np.minimum, sets.value), sets.reduce(np.minimum, mix(sets.value + np.uint64(2)))
            rare, seeds, counts, body = ([None] * len(n) for _ in range(4))
            if shared.any():
                vectors = sets.counts()
                mine = np.flatnonzero(shared[sets.doc] & (codes > 0))
                mine = mine[np.lexsort((sets.value[mine], codes[mine], sets.doc[mine]))]
                cut = np.searchsorted(sets.doc[mine], np.arange(len(n) + 1))
                for d in np.flatnonzero(shared).tolist():
                    rare[d] = sets.value[mine[cut[d] : cut[d] + prefix[d] - lone[d]]].view(np.int64)
                    seeds[d] = np.array([seed1[d], seed2[d]]).view(np.int64)
                    counts[d] = squeeze(vectors[d].tobytes())
                    body[d] = squeeze(buf[bounds[d] : bounds[d + 1]].tobytes(), 3)
            longs = pa.list_(pa.int64())
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.array(rare, longs), pa.array(seeds, longs), pa.array(counts, pa.binary()), pa.array(body, pa.binary())],
                ["doc_id", "n", "s1", "s2", "rare", "seeds", "counts", "body"],
            )

    return run


# --- links -------------------------------------------------------------------------------------------------------


def _sets(bodies) -> ShingleSets:
    texts = [expand(b) for b in bodies]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return ShingleSets(words(np.frombuffer(b"".join(texts), np.uint8), bounds, lower=True))


def _first_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """What verified links join in a small block, as stars: each document with the first of those that it is joined with.

    Pairs that are joined already are not verified.
    """
    sets = _sets(pdf["body"])
    points = sets.counts()
    tree, root = CountTree(points), list(range(len(pdf)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k in range(len(pdf)):
        near = tree.search(points[k], int(sets.sizes[k]))
        for other in np.sort(near[near < k]).tolist():
            if find(other) != find(k) and overlap(sets.of(k), sets.of(other)) >= needed(int(sets.sizes[k]), int(sets.sizes[other])):
                root[max(find(k), find(other))] = min(find(k), find(other))
    node, first = pdf["node"].to_numpy(), np.array([find(k) for k in range(len(pdf))], np.int64)
    moved = np.flatnonzero(first != np.arange(len(pdf)))
    return pd.DataFrame({"a": node[moved], "b": node[first[moved]]}, dtype="int64")


def _possible_pairs(probe: bool):
    """Pairs of different components that a block's R-tree lets through. Rows come sorted by block.

    As a probe, it gives of all pairs of two components the one with the largest overlap bound; joining components that
    way first leaves the exact search little to find.
    """

    def pairs(block: pd.DataFrame):
        points = np.frombuffer(b"".join(expand(c) for c in block["counts"]), np.int32).reshape(-1, GROUPS)
        node, label, slot = (block[c].to_numpy() for c in ("node", "label", "slot"))
        size, halves = points.sum(1), len(set(slot.tolist())) > 1
        tree, best = CountTree(points), {}
        for k in range(len(block)):
            near = tree.search(points[k], int(size[k]))
            near = near[(node[near] < node[k]) & (label[near] != label[k])]
            if halves:  # pairs within one half are another task's
                near = near[slot[near] != slot[k]]
            if not len(near):
                continue
            if not probe:
                yield np.full(len(near), node[k]), node[near], np.full(len(near), label[k]), label[near]
                continue
            share = np.minimum(points[near], points[k]).sum(1) / (size[near] + size[k])
            for other in near[np.argsort(-share, kind="stable")].tolist():
                both = (min(label[k], label[other]), max(label[k], label[other]))
                found = float(np.minimum(points[other], points[k]).sum() / (size[other] + size[k]))
                if found > best.get(both, (0.0,))[0]:
                    best[both] = (found, node[k], node[other], label[k], label[other])
        if best:
            yield tuple(np.array([x[c] for x in best.values()]) for c in (1, 2, 3, 4))

    def frame_of(found: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({name: np.concatenate([p[c] for p in found]) for c, name in enumerate(("a", "b", "x", "y"))}).drop_duplicates()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            key = frame[["shingle", "left", "right"]].to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1]) if len(frame) else np.zeros(1, np.int64)
            found = [p for a, b in zip(cuts[:-1], cuts[1:], strict=True) for p in pairs(frame.iloc[a:b])]
            rest = frame.iloc[cuts[-1] :].reset_index(drop=True)
            if found:
                yield frame_of(found)
        found = list(pairs(rest)) if rest is not None and len(rest) else []
        if found:
            yield frame_of(found)

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in range(0, batch.num_rows, 256):
            part = batch.slice(s, 256)
            a, b = _sets(part.column(2).to_pylist()), _sets(part.column(3).to_pylist())
            keep = [overlap(a.of(k), b.of(k)) >= needed(int(a.sizes[k]), int(b.sizes[k])) for k in range(part.num_rows)]
            yield pa.record_batch([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _tasks(df: DataFrame) -> int:
    """As many tasks as shuffles have: rows that are few bytes but much work are not put together."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _links(possible: DataFrame, joined: DataFrame, probe: bool) -> DataFrame:
    """The components (a, b) that verified links join and joined(node, component) does not: by all links, or as a probe by some."""
    labels = possible.select("node").join(joined, "node", "left").select("node", F.coalesce("component", "node").alias("label"))
    entries = possible.select("node", F.explode("rare").alias("shingle")).join(labels, "node")
    mixed = entries.groupBy("shingle").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("m")).where("x <> y")
    slots = F.ceil(F.col("m") / SLOT).cast("int")
    entries = entries.join(mixed.select("shingle", slots.alias("slots")), "shingle").withColumn("slot", F.pmod(F.xxhash64("node"), F.col("slots")).cast("int"))
    halves = F.explode(F.transform(F.sequence(F.lit(0), F.col("slots") - 1), lambda o: F.struct(F.least(o, "slot").alias("left"), F.greatest(o, "slot").alias("right"))))
    blocks = entries.withColumn("h", halves).select("shingle", "node", "label", "slot", "h.left", "h.right").join(possible.select("node", "counts"), "node")
    blocks = blocks.repartition(_tasks(blocks), "shingle", "left", "right").sortWithinPartitions("shingle", "left", "right")
    pairs = saved(blocks.mapInPandas(lean(_possible_pairs(probe)), "a long, b long, x long, y long").distinct(), "possible-pairs")
    body = possible.select("node", "body")
    wanted = pairs.join(body.toDF("a", "body_a"), "a").join(body.toDF("b", "body_b"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"), "body_a", "body_b")
    return map_batches(wanted, _verify, "a long, b long")


def overlaps(sets: ShingleSets) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets.

    Shingles of many sets are columns of a product of matrices; those of few give their pairs one by one.
    """
    m = len(sets.sizes)
    order = np.argsort(sets.value, kind="stable")
    value, doc = sets.value[order], sets.doc[order].astype(np.int64)
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    column = np.cumsum(new) - 1
    held = np.bincount(column)[column] if len(value) else column
    few, out = max(1, m // 32), np.zeros((m, m))
    rare = np.flatnonzero((held > 1) & (held <= few))
    for step in range(1, few):
        a, b = rare[:-step], rare[step:]
        both = column[a] == column[b]
        if not both.any():
            break
        out += np.bincount(doc[a[both]] * m + doc[b[both]], minlength=m * m).reshape(m, m)
    out += out.T
    often = np.flatnonzero(held > few)
    at = np.cumsum(np.diff(column[often], prepend=-1) > 0) - 1
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        a, b = np.searchsorted(at, [start, start + COLUMNS])
        part = np.zeros((m, COLUMNS), np.float32)
        part[doc[often[a:b]], at[a:b] - start] = 1
        out += part @ part.T
    np.fill_diagonal(out, sets.sizes)
    return out.astype(np.int64)


def _tiles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of each (component, left, right), which come in order."""
    rest = []
    for frame in frames:
        key = frame[["component", "left", "right"]].to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, [len(frame)]]) if len(frame) else []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if rest and (rest[0][["component", "left", "right"]].iloc[0].to_numpy() != key[a]).any():
                yield pd.concat(rest, ignore_index=True)
                rest = []
            rest.append(frame.iloc[a:b])
    if rest:
        yield pd.concat(rest, ignore_index=True)


def _count_links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each class of a tile, how many rows its linked classes there have."""
    for tile in _tiles(frames):
        sets, slot = _sets(tile["body"]), tile["slot"].to_numpy()
        linked = overlaps(sets) >= needed(sets.sizes[:, None], sets.sizes)
        np.fill_diagonal(linked, False)
        if tile["left"].iloc[0] != tile["right"].iloc[0]:  # pairs within one half are another tile's
            linked &= slot[:, None] != slot
        yield tile[["s1", "s2", "n"]].assign(n_links=linked @ tile["rows"].to_numpy())


def _links_of_classes(possible: DataFrame, joined: DataFrame) -> DataFrame:
    """s1, s2, n, n_links: rows of all other classes that link with the class.

    A link lies within one component, so each component's pairs are all verified, in tiles of two halves; what leaves a
    tile is one row a class, never a row a pair.
    """
    entries = possible.join(joined, "node", "left").select("s1", "s2", "n", "rows", "body", "node", F.coalesce("component", "node").alias("component"))
    weight = entries.groupBy("component").agg(F.count("*").alias("m"), F.sum("n").alias("s")).where("m > 1")
    slots = F.greatest(F.ceil(F.col("m") / TILE), F.least("m", F.ceil(F.col("s") / TILE_SHINGLES))).cast("int")
    slots = saved(weight.select("component", slots.alias("slots")), "slots-of-components")  # stored, so that AQE can split the join
    entries = entries.join(slots, "component").withColumn("slot", F.pmod(F.xxhash64("s1"), F.col("slots")).cast("int"))
    halves = F.explode(F.transform(F.sequence(F.lit(0), F.col("slots") - 1), lambda o: F.struct(F.least(o, "slot").alias("left"), F.greatest(o, "slot").alias("right"))))
    tiles = entries.withColumn("h", halves).select("component", "h.left", "h.right", "slot", "s1", "s2", "n", "rows", "body")
    tiles = tiles.repartition(_tasks(tiles), "component", "left", "right").sortWithinPartitions("component", "left", "right")
    return tiles.mapInPandas(lean(_count_links), "s1 long, s2 long, n long, n_links long").groupBy("s1", "s2", "n").agg(F.sum("n_links").alias("n_links"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", links: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, and n_links if links are to be counted.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a document's set holds its distinct 5-word
    shingles, or the whole sequence of fewer words. Documents link at a Jaccard similarity of 0.8 or more; component_id
    is the smallest doc_id that links reach.

    n_links is the number of other rows with a doc_id whose sets are at 0.8 or more: every pair of different sets of a
    component is verified, and rows of equal sets count each. Rows without shingles or doc_id have 0.

    Null and empty texts have no shingles and are components of their own; rows without doc_id get a null component and
    link with nothing; rows that share a doc_id are one document with all their links; an empty table gives no rows;
    other columns are not read. Components are found from blocks of any size: large ones in halves of SLOT documents, pair
    by pair of halves, and only between components that are not yet joined.
    """
    chunks = chunk_table(docs, doc_id, text)
    expected = max(1, (chunks.agg(F.sum(F.length("blob"))).first()[0] or 0) // 3)  # words
    parts, bits = int(-(-expected // PART_SHINGLES)), min(60, max(36, expected.bit_length() + 13))
    sent = map_batches(chunks, _sender(parts, bits), "group int, chunk long, shingles binary, counts binary")
    dealt = sent.repartitionById(parts, F.col("group"))  # one group a task: hashed groups would meet
    rarity = dealt.groupBy("group").applyInPandas(lean_group(_rarity), "chunk long, group int, answer binary")
    nodes = saved(map_batches(answered(chunks, rarity), _describer(parts, bits), NODES), "shingle-nodes")

    known = nodes.where("doc_id is not null and n > 0")
    classes = saved(known.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("node"), F.count("*").alias("rows")), "shingle-classes")
    possible = saved(
        known.where("rare is not null").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("node"), F.count("*").alias("rows"), F.min_by(F.struct("rare", "seeds", "counts", "body"), "doc_id").alias("x")).select("s1", "s2", "node", "n", "rows", "x.*"),
        "shingle-possible",
    )

    seeds = possible.select("node", "n", F.explode("seeds").alias("seed"))
    crowd = seeds.groupBy("seed").agg(F.count("*").alias("m"), F.sum("n").alias("s")).where("m > 1")
    parts = F.greatest(F.ceil(F.col("m") / SEEDS), F.least("m", F.ceil(F.col("s") / SEED_SHINGLES)))
    seeds = seeds.join(crowd, "seed").withColumn("salt", F.pmod(F.xxhash64("node", "seed"), parts))
    first = seeds.join(possible.select("node", "body"), "node").select("node", "seed", "salt", "body").groupBy("seed", "salt").applyInPandas(_first_links, "a long, b long")
    joined = components(first)
    joined = rejoined(joined, components(_links(possible, joined, probe=True)))
    joining = _links(possible, joined, probe=False)
    doubled = saved(known.groupBy("doc_id").agg(F.min("s1").alias("x"), F.max("s1").alias("y")).where("x <> y").select("doc_id"), "ids-of-several-sets")
    if doubled.take(1):  # each such row with the first of its id
        label = classes.join(joined, "node", "left").select("s1", "s2", "n", F.coalesce("component", "node").alias("label"))
        same_id = known.select("doc_id", "s1", "s2", "n").join(doubled, "doc_id", "left_semi").join(label, ["s1", "s2", "n"])
        least = same_id.groupBy("doc_id").agg(F.min("label").alias("b"))
        joining = joining.unionByName(same_id.join(least, "doc_id").select(F.col("label").alias("a"), "b"))
    final = rejoined(joined, components(joining))

    # a class may hold a third of all rows: its component is found for the class, and AQE can split the one join with rows,
    # as a stored table stands on the other side of it
    labelled, counted = classes.join(final, "node", "left"), []
    if links:
        labelled = labelled.join(_links_of_classes(possible, final), ["s1", "s2", "n"], "left")
        counted = [(F.col("rows") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links")]
    labelled = saved(labelled.select("s1", "s2", "n", F.coalesce("component", "node").alias("component"), *counted), "shingle-components")
    rows = nodes.select("doc_id", "n", "s1", "s2").join(labelled, ["s1", "s2", "n"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    if links:
        counted = [F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links")]
    return rows.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), *counted)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), links=True)
