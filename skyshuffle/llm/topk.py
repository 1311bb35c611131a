"""Exact top-k search by inner product with multi-resolution segment statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_batches, saved, saved_parts

LEVELS = (1, 2, 4, 8, 16)  # segments per vector, coarse to fine
#: Queries are sent to the tasks in blocks of about so many; each block reads the candidates once.
QUERY_BLOCK = 16384
QUERIES, ROWS = 512, 1024  # queries and candidate rows that are compared at once
SEEDS = 1024  # candidates whose scores are the first thresholds
EXACT, EXACT_SINGLE = 2.0**52, 2.0**23
DENSE = 16  # survivors of the bounds are multiplied all at once when they are more than one in so many pairs


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Segment means and deviations, scaled so that a product of two rows bounds the vectors' inner product from above.

    In a segment of n components, q.x = n mq mx + (q - mq).(x - mx) <= n (mq mx + sq sx). With |q|^2 and |x|^2 that is
    a lower bound of the distance |q - x|^2 = |q|^2 + |x|^2 - 2 q.x.
    """
    parts = []
    for part in np.array_split(x, min(segments, max(1, x.shape[1])), axis=1):
        root = np.sqrt(part.shape[1])
        parts += [part.mean(1) * root, part.std(1) * root] if part.shape[1] else []
    return np.stack(parts, 1) if parts else np.zeros((len(x), 1))


def _integers(column) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Rows that take part, by number of components: their places and floor(256 * x)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    by: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null components become nan
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for n in np.unique(sizes[valid]):
        at = np.flatnonzero(valid & (sizes == n))
        x = values[offsets[at][:, None] + np.arange(n)]
        fine = np.isfinite(x).all(1)
        by[int(n)] = at[fine], np.floor(256.0 * x[fine])
    return by


class _Rows:
    """Some candidates of one width, with what each block of queries asks of them."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.norm = np.sqrt((x * x).sum(1))
        self.stats = [segment_statistics(x, s) for s in LEVELS]

    def bounds(self, level: int, at: np.ndarray, slack: bool, kind: type) -> np.ndarray:
        """The statistics of some rows; two columns more, slack for one of two factors, add to a product what rounding may take from it."""
        rounding = 1e-5 if kind is np.float32 else 1e-9
        extra = (rounding * self.norm[at], np.full(len(at), 1e-6)) if slack else (self.norm[at], np.ones(len(at)))
        return np.column_stack([self.stats[level][at], *extra]).astype(kind)


class _Best(_Rows):
    """The k best candidates so far of each query of one width. seeds: some candidates, with their ids; the k-th best score
    among them is a threshold that no result falls below."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, seeds: tuple[np.ndarray, np.ndarray]):
        super().__init__(ids, x)
        self.k = k
        self.rows: list[list[tuple]] = [[] for _ in ids]  # (-score, vec_id), ascending
        self.least = np.full(len(ids), -np.inf)
        own, y = seeds
        if len(own) >= k > 0 and x.size and np.abs(x).max() * np.abs(y).max() * x.shape[1] < EXACT:
            scores = np.where(ids[:, None] == own, -np.inf, x @ y.T)
            self.least = np.partition(scores, len(own) - k, axis=1)[:, len(own) - k]

    def add(self, some: _Rows) -> None:
        ids, x = some.ids, some.x
        live, rows = np.arange(len(self.ids)), np.arange(len(x))
        # No partial sum passes the product of the norms: below 2^23, single precision holds all integers that occur.
        kind = np.float32 if self.norm.max(initial=1) * some.norm.max(initial=1) < EXACT_SINGLE else np.float64
        mask, own = np.ones((len(live), len(rows)), bool), np.isin(self.ids, ids)
        mask[own] = self.ids[own, None] != ids
        for level in range(len(LEVELS)):
            bound = self.bounds(level, live, True, kind) @ some.bounds(level, rows, False, kind).T
            mask &= ~(bound < self.least[live].astype(kind)[:, None])
            q, r = mask.any(1), mask.any(0)
            if not q.any():
                return
            if 4 * np.count_nonzero(q) * np.count_nonzero(r) < 3 * mask.size:  # else a smaller table saves less than its copy takes
                live, rows, mask = live[q], rows[r], mask[q][:, r]
        whole = not self.x.size or np.abs(self.x).max() * np.abs(x).max() * x.shape[1] < EXACT
        if whole and np.count_nonzero(mask) * DENSE > mask.size:  # one product of matrices takes less than a product for each pair
            scores = self.x[live].astype(kind) @ x[rows].astype(kind).T
            mask &= scores >= self.least[live].astype(kind)[:, None]
            at = np.flatnonzero(mask)
            qi, xi = np.divmod(at, len(rows))
            scores, qi, xi = scores.ravel()[at].astype(np.float64), live[qi], rows[xi]
        else:
            qi, xi = np.nonzero(mask)
            qi, xi = live[qi], rows[xi]
            if whole:
                scores = np.concatenate([np.einsum("ij,ij->i", self.x[qi[s : s + 65536]], x[xi[s : s + 65536]]) for s in range(0, len(qi), 65536)])
            else:
                exact = lambda v: [int(c) for c in v]
                scores = np.array([sum(a * b for a, b in zip(exact(self.x[i]), exact(x[j]), strict=True)) for i, j in zip(qi, xi, strict=True)], object)
            fine = scores >= self.least[qi]
            qi, xi, scores = qi[fine], xi[fine], scores[fine]
        if not len(qi):  # bounds let pairs pass of which none is good enough
            return
        order = np.lexsort((ids[xi], -scores.astype(float), qi)) if scores.dtype != object else np.array(sorted(range(len(qi)), key=lambda j: (qi[j], -scores[j], ids[xi[j]])), np.int64)
        starts = np.flatnonzero(np.diff(qi[order], prepend=-1))
        for a, b in zip(starts, np.append(starts[1:], len(order)), strict=True):
            i = int(qi[order[a]])
            top = order[a : min(b, a + self.k)]
            self.rows[i] = sorted([*self.rows[i], *((-int(s), int(v)) for s, v in zip(scores[top], ids[xi[top]], strict=True))])[: self.k]
            if len(self.rows[i]) == self.k:
                self.least[i] = float(-self.rows[i][-1][0]) if abs(self.rows[i][-1][0]) < EXACT else np.nextafter(float(-self.rows[i][-1][0]), -np.inf)


def _searcher(ids: np.ndarray, vectors: pa.Array, k: int, seed_ids: np.ndarray, seeds: pa.Array):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, best = _integers(seeds), {}
        for n, (at, x) in _integers(vectors).items():
            spot, y = first.get(n, (np.zeros(0, np.int64), np.zeros((0, n))))
            best[n] = [_Best(ids[at[s : s + QUERIES]], x[s : s + QUERIES], k, (seed_ids[spot], y)) for s in range(0, len(at), QUERIES)]
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for n, (at, x) in _integers(batch.column(1)).items():
                for s in range(0, len(at) if n in best else 0, ROWS):
                    some = _Rows(own[at[s : s + ROWS]].astype(np.int64), x[s : s + ROWS])
                    for block in best[n]:
                        block.add(some)
        rows = [(int(q), v, max(-(2**63), min(2**63 - 1, -s))) for some in best.values() for b in some for q, found in zip(b.ids, b.rows, strict=True) for s, v in found]
        yield pa.record_batch([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], ["query_id", "vec_id", "score"])

    return run


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products of floor(256 * x) over all vectors.

    Ties go to the smaller vec_id. Rows with the query's own vec_id are its own and do not count; other rows that repeat
    each count. Vectors that are null or hold null or non-finite components, and rows without id, take no part; vectors
    are compared with those of as many components. Of several valid query rows of one id, the smallest vector (component by
    component) is the query. A query without candidates, and empty tables, give no rows. Scores beyond 64 bits saturate.

    Queries are stored and sent in blocks; a block's results are stored before the next one starts. Each task keeps the k best of a block of queries and drops a candidate as soon as its bound from segment means and
    deviations (1, 2, ... 16 segments) falls below the k-th best score; survivors get the exact product.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    pick = lambda df: df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & F.forall("embedding", finite))
    asked, rows = saved(pick(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "search-queries"), pick(vectors)
    n = -(-asked.count() // QUERY_BLOCK) or 1
    some = rows.limit(SEEDS).toArrow()
    seeds = some["vec_id"].to_numpy(), some["embedding"].combine_chunks()

    def block(b: int) -> DataFrame:
        table = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == b).toArrow()
        return map_batches(rows, _searcher(table["vec_id"].to_numpy(), table["embedding"].combine_chunks(), k, *seeds), "query_id long, vec_id long, score long")

    found = saved_parts(map(block, range(n)), "search-results")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors.where("vec_id % 50 = 0"), vectors)


OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""
