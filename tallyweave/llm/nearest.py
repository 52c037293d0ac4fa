"""Approximate nearest neighbours by inner product from a hash-prefix forest.

Rows are dealt into blocks of about BLOCK_ROWS. Each block has a forest: TREES sorted arrays of BITS-long hash strings,
a bit being the side of a random hyperplane. One more coordinate makes all rows equally long, so that the largest inner
product is the smallest angle. A query descends in each tree to its longest matching prefix, then all trees ascend
together, a bit at a time, until the different rows that share a prefix are SHARE of the block; the last bit is climbed
tree by tree. Those rows are compared exactly; the best of all blocks are the answer.

Every row is indexed and every query meets every block. Rows and queries meet in groups of one block and at most about
QUERY_ROWS queries, so a task's memory is bounded whatever the table's size.

Rows take no part whose vector or id is null, or whose vector is zero or holds null or non-finite values. Vectors are
compared with those of the same length only. A query never finds its own row; other rows that repeat its id are
candidates like all others, and the least vector of an id that repeats is its query. Equal vectors have equal scores; ties
go to the smaller id. Empty tables give empty results. Only the two columns named are read: others cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


TREES, BITS, SEED = 24, 48, 7
BLOCK_ROWS, QUERY_ROWS = 8192, 4096
#: Different rows to look at, as a part of the block. This is what data without close neighbours need for nine tenths
#: of the true ones; data with close ones do with far less.
SHARE = 0.7


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & whole & F.exists(vector, lambda x: x != 0), F.lit(False))


class Forest:
    """Sorted hash strings of a block's rows."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.mean = rows.mean(axis=0)
        squares = (rows**2).sum(axis=1)
        more = np.sqrt(np.maximum(squares.max() - squares, 0.0))
        self.planes = rng.standard_normal((rows.shape[1] + 1, trees * bits))
        self.lift = np.append(self.mean, more.mean())
        self.trees, self.bits = trees, bits
        self.steps = np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64)
        codes = self._codes(np.hstack((rows, more[:, None])))
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=0)

    def _codes(self, lifted: np.ndarray) -> np.ndarray:
        side = ((lifted - self.lift) @ self.planes > 0).reshape(len(lifted), self.trees, self.bits)
        return (side * self.steps).sum(axis=2, dtype=np.uint64)

    def candidates(self, queries: np.ndarray, wanted: float) -> Iterator[np.ndarray]:
        """For each query the rows below the deepest level at which the trees together have enough."""
        # a query as long as the longest row, without the added coordinate
        length = np.sqrt((queries**2).sum(axis=1, keepdims=True))
        scale = np.sqrt((self.lift[:-1] ** 2).sum() + 1e-12)
        norm = math.sqrt(max((self.lift**2).sum(), 1e-12))
        lifted = np.hstack((queries / np.maximum(length, 1e-300) * max(1.0, norm, scale), np.zeros((len(queries), 1))))
        codes = self._codes(lifted)
        low = np.zeros((self.bits + 1, self.trees, len(queries)), dtype=np.int64)
        high = np.empty_like(low)
        for depth in range(self.bits + 1):
            rest = np.uint64((1 << (self.bits - depth)) - 1)
            for t in range(self.trees):
                low[depth, t] = np.searchsorted(self.sorted[:, t], codes[:, t] & ~rest, "left")
                high[depth, t] = np.searchsorted(self.sorted[:, t], codes[:, t] | rest, "right")
        enough = (high - low).sum(axis=1) >= wanted
        depth = self.bits - np.argmax(enough[::-1], axis=0)
        for q in range(len(queries)):
            seen = np.zeros(len(self.order), dtype=bool)
            # the last level is climbed tree by tree, until there are enough different rows
            deeper = min(depth[q] + 1, self.bits)
            total = 0
            for t in range(self.trees):
                seen[self.order[low[deeper, t, q] : high[deeper, t, q], t]] = True
            for d in (depth[q], max(depth[q] - 1, 0), 0):
                for t in range(self.trees):
                    if total < wanted:
                        seen[self.order[low[d, t, q] : high[d, t, q], t]] = True
                        total = np.count_nonzero(seen)
            yield np.flatnonzero(seen)


def best_of_block(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, share: float = SHARE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, ids, scores) of the best k candidates of one block for each query."""
    forest = Forest(rows)
    for q, found in enumerate(forest.candidates(queries, max(share * len(rows), 4 * k))):
        own = np.flatnonzero(ids[found] == query_ids[q])
        if len(own):
            # the query's own row is no candidate; another row that repeats its id is one
            same = own[(rows[found[own]] == queries[q]).all(axis=1)]
            found = np.delete(found, same[:1])
        rough = rows[found] @ queries[q]
        if len(found) > k:
            least = np.partition(rough, len(rough) - k)[len(rough) - k]
            found = found[rough >= least - 1e-9 * (1 + abs(least))]
        # the same order of additions for every row, so that equal vectors have equal scores
        score = (rows[found] * queries[q]).sum(axis=1)
        order = np.lexsort((ids[found], -score))[:k]
        yield q, ids[found][order], score[order]


def search(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest found for each row that `is_query` holds for."""
    rows = vectors.where(usable(F.col(vector)) & F.col(key).isNotNull())
    rows = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")).withColumn("dim", F.size("v"))
    n, asking = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    blocks, parts = max(1, math.ceil(n / BLOCK_ROWS)), max(1, math.ceil(asking / QUERY_ROWS))
    held = rows.select("dim", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "id", "v")
    asked = rows.where("asks").groupBy("dim", "id").agg(F.min("v").alias("v"))
    asked = asked.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int").alias("part"), "id", "v")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            ids, query_ids = left.column("id").to_numpy(), right.column("id").to_numpy()
            values = lambda t: t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            order = np.argsort(ids, kind="stable")
            for q, found, score in best_of_block(ids[order], values(left)[order], query_ids, values(right), k, share):
                out[0].append(np.full(len(found), query_ids[q]))
                out[1].append(found)
                out[2].append(score)
        if not out[0]:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return pa.table({"query_id": np.concatenate(out[0]), "vec_id": np.concatenate(out[1]), "score": np.concatenate(out[2])})

    by = ("dim", "block", "part")
    found = held.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # at most k rows for each query and block
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
