"""Exact top-k inner products, score at a time over impact-ordered postings.

Vectors are integers.  Rows stay where they are scanned: each task takes them in blocks, rows of large norm
first, and keeps for every block sparse postings ``(component, impact level) -> rows, values``.
The levels are magnitudes cut at quantiles of the block, so one huge value doesn't empty the others.  All
queries read the segments of the highest level first and add them to their accumulators.

What a row's unread components can still add to a score is bounded by their norm times the query's (Cauchy and
Schwarz).  Rows whose bound is under the k-th best exact score that the task knows can't be members.  A
query stops reading as soon as an exact look at its possible members costs less than
the unread postings, and these members are scored from the whole vectors.  A block whose largest components can't
reach a query's k-th score is skipped without reading.

Queries are broadcast in blocks of at most about ``QUERIES_IN_BLOCK``; every block of queries is one scan of the
rows, without a shuffle of them.  Each task returns its exact top k of each query, and a window keeps the k
best of all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylater.llm import documents
from paylater.llm.tables import written

LEVELS = 12                  # impact levels of a block
ROWS_IN_BLOCK = 2048
BLOCKS_HELD = 32             # blocks of rows that a task orders by norm at once
QUERIES_AT_ONCE = 64         # accumulators: this many for each row of a block, 1 MB
QUERIES_IN_BLOCK = 16_384    # queries of one broadcast: 8 MB at 64 components
ROUNDING = 1e-9              # far over the error of float sums, relative to the product of norms
LEAST, MOST = -(1 << 63), (1 << 63) - 1
SCORES = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = 1024, id_col: str = "vec_id",
              vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v``: ``floor(scale * x)`` of each component.

    Vectors without an id, null, or with null or non-finite components take no
    part; of rows with one id the smallest vector counts.  Components beyond 64 bits become the nearest long.
    """
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad)
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def _matrix(lists: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(float) ** 2).sum(axis=1))


def exact_scores(vectors: np.ndarray, query: np.ndarray, bound: float) -> np.ndarray:
    """Inner products as longs, of sizes under ``bound``; those beyond 64 bits become the nearest long."""
    if bound < 2.0 ** 62:
        return vectors @ query
    whole = [sum(a * b for a, b in zip(v, query.tolist())) for v in vectors.tolist()]
    return np.array([min(max(s, LEAST), MOST) for s in whole], np.int64)


class Best:
    """The ``k`` best rows that each query has met, ties to the smaller id."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.ids = [np.zeros(0, np.int64)] * n_queries
        self.scores = [np.zeros(0, np.int64)] * n_queries
        self.least = np.full(n_queries, -np.inf)       # k-th score, once there are k

    def add(self, query: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(self.ids[query]) == self.k:
            rise = scores >= self.scores[query][-1]
            ids, scores = ids[rise], scores[rise]
        if not len(ids):
            return
        ids, scores = np.concatenate([self.ids[query], ids]), np.concatenate([self.scores[query], scores])
        order = np.lexsort((ids, ~scores))[:self.k]    # ~s falls as s rises, without overflow
        self.ids[query], self.scores[query] = ids[order], scores[order]
        if len(order) == self.k:
            self.least[query] = float(self.scores[query][-1])


class ImpactIndex:
    """Posting segments of a block of vectors, by falling impact level; ``read`` counts postings read by queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, levels: int = LEVELS):
        self.ids, self.vectors, self.norm = ids, vectors, _norms(vectors)
        self.row_of = {i: row for row, i in enumerate(ids.tolist())}
        self.high, self.low = vectors.max(axis=0).astype(float), vectors.min(axis=0).astype(float)
        size = np.abs(vectors.astype(float))
        values = size[size > 0]
        cuts = np.unique(np.quantile(values, np.arange(1, levels) / levels)) if len(values) else np.zeros(0)
        level = np.searchsorted(cuts, size, side="right")
        self.segments, left = [], size
        self.postings = self.unread = len(values)
        for one in range(len(cuts), -1, -1):
            here = (level == one) & (size > 0)
            left = np.where(here, 0, left)
            lists = [(j, rows, vectors[rows, j].astype(float)[:, None])
                     for j in range(vectors.shape[1]) if len(rows := np.flatnonzero(here[:, j]))]
            self.segments.append((lists, int(here.sum()), np.sqrt((left ** 2).sum(axis=1))))
        self.read = 0

    def reachable(self, queries: np.ndarray, norm: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Queries whose k-th score some row of the block may reach, by the block's largest components and norm."""
        bound = np.minimum(np.maximum(queries, 0) @ self.high + np.minimum(queries, 0) @ self.low,
                           norm * self.norm.max())
        return np.maximum(bound + ROUNDING * (1 + norm * self.norm.max()), float(LEAST)) >= least

    def search(self, queries: np.ndarray, query_ids: np.ndarray, which: np.ndarray, best: Best) -> None:
        """Adds the block's members to ``best`` for the queries ``which``."""
        norm = _norms(queries[which])
        q = queries[which].astype(float)
        keep = self.reachable(q, norm, best.least[which])
        which, q, norm = which[keep], q[keep], norm[keep]
        score = np.zeros((len(self.ids), len(which)))
        for column, query in enumerate(which):
            if (row := self.row_of.get(int(query_ids[query]))) is not None:
                score[row, column] = -np.inf
        unread = self.postings
        for lists, count, left in self.segments:
            if not len(which):
                return
            for component, rows, values in lists:
                score[rows] += values * q[:, component]
            unread -= count
            self.read += count * len(which)
            least = best.least[which]
            for column in np.flatnonzero(np.isneginf(least)):
                least[column] = self._seed(score[:, column], queries[which[column]], norm[column], best.k)
            slack = left[:, None] * norm + ROUNDING * (1 + self.norm[:, None] * norm)
            possible = (np.maximum(score + slack, float(LEAST)) >= least) & ~np.isneginf(score)
            done = possible.sum(axis=0) * self.vectors.shape[1] <= unread
            if not unread:
                done[:] = True
            for column in np.flatnonzero(done):
                rows = np.flatnonzero(possible[:, column])
                best.add(which[column], self.ids[rows], self._exact(rows, queries[which[column]], norm[column]))
            if done.any():
                which, q, norm, score = which[~done], q[~done], norm[~done], score[:, ~done]

    def _exact(self, rows: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
        return exact_scores(self.vectors[rows], query, self.norm.max() * norm)

    def _seed(self, score: np.ndarray, query: np.ndarray, norm: float, k: int) -> float:
        """The k-th best has at least the least exact score of any ``k`` rows: of those ahead so far."""
        if np.isfinite(score).sum() < k:
            return -np.inf
        ahead = np.argpartition(-score, k - 1)[:k]
        return float(self._exact(ahead, query, norm).min())


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[ImpactIndex]:
    """Blocks of a task's rows; of every ``BLOCKS_HELD`` blocks those of large norm come first."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def ordered() -> Iterator[ImpactIndex]:
        most = max(v.shape[1] for _, v in held)
        ids = np.concatenate([i for i, _ in held])
        vectors = np.concatenate([np.pad(v, ((0, 0), (0, most - v.shape[1]))) for _, v in held])
        order = np.lexsort((ids, -_norms(vectors)))
        for at in range(0, len(order), ROWS_IN_BLOCK):
            part = order[at:at + ROWS_IN_BLOCK]
            yield ImpactIndex(ids[part], vectors[part])

    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("v").to_pylist()
        held.append((batch.column("vec_id").to_numpy(), _matrix(lists, max(width, *map(len, lists)))))
        if sum(len(i) for i, _ in held) >= ROWS_IN_BLOCK * BLOCKS_HELD:
            yield from ordered()
            held = []
    if held:
        yield from ordered()


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shared.value
        best = Best(len(queries), k)
        for index in _blocks(batches, queries.shape[1]):
            wide = np.pad(queries, ((0, 0), (0, index.vectors.shape[1] - queries.shape[1])))
            for at in range(0, len(queries), QUERIES_AT_ONCE):
                index.search(wide, query_ids, np.arange(at, min(at + QUERIES_AT_ONCE, len(queries))), best)
        for at in range(0, len(queries), QUERIES_AT_ONCE):
            some = range(at, min(at + QUERIES_AT_ONCE, len(queries)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(query_ids[at:some.stop], [len(best.ids[i]) for i in some]), pa.int64()),
                 pa.array(np.concatenate([best.ids[i] for i in some]), pa.int64()),
                 pa.array(np.concatenate([best.scores[i] for i in some]), pa.int64())],
                ["query_id", "vec_id", "score"])
    return run


def top_k(queries: DataFrame, rows: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest inner products (all, if fewer),
    ties to the smaller id, without the row of its own id.  Shorter vectors count as padded with zeros;
    scores beyond 64 bits become the nearest long and tie there.  Both tables, ``vec_id, v``, are
    read more than once: give written ones.  One block of queries at a time passes through the driver.
    """
    spark = rows.sparkSession
    n_blocks = queries.count() // QUERIES_IN_BLOCK + 1
    found = []
    for number in range(n_blocks):
        block = (queries.select("vec_id", "v")
                 .where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == number).toArrow())
        lists = block.column("v").to_pylist()
        shared = spark.sparkContext.broadcast(
            (block.column("vec_id").to_numpy(), _matrix(lists, max(map(len, lists), default=0))))
        found.append(rows.select("vec_id", "v").mapInArrow(_search(shared, k), SCORES))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op2_topk_search(spark, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector with all others."""
    rows = written(quantised(documents.read(spark, sf_dir, "embeddings")), "vectors")
    return top_k(rows.where("vec_id % 100 = 0"), rows)
