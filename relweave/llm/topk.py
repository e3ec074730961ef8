"""Exact top-k search by inner product: one KD-tree per shard, searched best box first.

A shard's vectors are split at medians into leaves with tight bounding boxes. For a query,
the largest product that a box allows bounds all vectors in it, so boxes are visited
from the highest bound down and the search stops at the query's k-th score. Each query is
first searched in the shard it lives in; the score it finds there goes with it to the others.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint
from .common import streamed

SHARD = 4096
BLOCK = 2048
LEAF = 64
NOTHING = -(1 << 62)


class Tree:
    """A KD-tree over whole-number vectors, kept as flat lists of nodes."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.points, self.ids = points, ids
        self.low, self.high, self.first_id, self.children, self.rows = [], [], [], [], []
        self._grow(np.arange(len(ids)), leaf)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        part = self.points[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        node = len(self.rows)
        self.low.append(low)
        self.high.append(high)
        self.first_id.append(int(self.ids[rows].min()))
        self.children.append(None)
        self.rows.append(None)
        wide = int(np.argmax(high - low)) if part.shape[1] else 0
        if len(rows) <= leaf or not part.shape[1] or high[wide] == low[wide]:
            self.rows[node] = rows
            return node
        half = len(rows) // 2
        order = np.argpartition(part[:, wide], half)
        self.children[node] = (self._grow(rows[order[:half]], leaf), self._grow(rows[order[half:]], leaf))
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest product of each query with any point of each node's box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, own: int, bound: np.ndarray, k: int, least: int) -> list[tuple[int, int]]:
        """Up to k (score, -id) of scores not below `least`, best first; `own` is left out."""
        best: list[tuple[int, int]] = []
        heap = [(-int(bound[0]), self.first_id[0], 0)]
        while heap:
            top, first_id, node = heapq.heappop(heap)
            if -top < least or len(best) == k and (-top, -first_id) <= best[0]:
                if -top < least or -top < best[0][0]:
                    break
                continue
            if self.children[node] is not None:
                for child in self.children[node]:
                    heapq.heappush(heap, (-int(bound[child]), self.first_id[child], child))
                continue
            rows = self.rows[node]
            scores = self.points[rows] @ query
            floor = max(least, best[0][0]) if len(best) == k else least
            for i in np.flatnonzero(scores >= floor).tolist():
                entry = (int(scores[i]), -int(self.ids[rows[i]]))
                if entry[1] == -own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return sorted(best, reverse=True)


def exact_type(points: np.ndarray) -> np.ndarray:
    """Doubles where every product is exact in them (they multiply faster), else whole numbers."""
    most = float(np.abs(points.astype(np.float64)).max(initial=0))
    return points.astype(np.float64) if most * most * max(1, points.shape[1]) < 2**53 else points


def search_table(table: pa.Table, k: int) -> pa.Table:
    """Queries and vectors of one shard: kind 0 rows are vectors, kind 1 rows queries with a least score."""
    kind = table.column("kind").to_numpy()
    ids = table.column("id").to_numpy()
    least = table.column("least").to_numpy()
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = exact_type(flat.reshape(len(ids), -1) if len(flat) else np.zeros((len(ids), 0), np.int64))
    own, asked = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    out: list[tuple[int, int, int]] = []
    if len(own) and len(asked):
        tree = Tree(vectors[own], ids[own])
        for first in range(0, len(asked), 256):
            some = asked[first : first + 256]
            bounds = tree.bounds(vectors[some])
            for i, bound in zip(some.tolist(), bounds, strict=True):
                out += [(int(ids[i]), -found, score) for score, found in tree.search(vectors[i], int(ids[i]), bound, k, int(least[i]))]
    columns = list(zip(*out, strict=True)) or [(), (), ()]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})


def whole_numbers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(id, vector): each component as floor(scale * x), x as double.

    Rows with a null id, a null or empty vector, or a null or non-finite component are
    left out; repeats of a row count once.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), x.alias("x")).where(F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0))
    rows = rows.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    return rows.select("id", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("vector")).distinct()


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other vectors of each row whose id is divisible by `every`.

    Scores are inner products of the whole-number vectors, ties go to the smaller id;
    fewer candidates give fewer rows. Only vectors of the same length are compared, and
    a row is never its own candidate, nor is another row of the same id. Vectors are dealt
    to shards of about `shard` rows by their id's hash, queries of a shard go in blocks, so
    neither side of a task grows with the table.
    """
    rows = checkpoint(whole_numbers(vectors).withColumn("dims", F.size("vector")))
    n = rows.count()
    asked = rows.where(F.col("id") % every == 0)
    shards, blocks = max(1, -(-n // shard)), max(1, -(-asked.count() // block))
    home = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    lot = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")
    schema = "query_id long, vec_id long, score long"
    work = lambda table: search_table(table, k)

    spread = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    own = rows.select(home.alias("shard"), "dims", spread.alias("lot"), F.lit(0).alias("kind"), "id", F.lit(NOTHING).alias("least"), "vector")
    first = asked.select(home.alias("shard"), "dims", lot.alias("lot"), F.lit(1).alias("kind"), "id", F.lit(NOTHING).alias("least"), "vector")
    near = checkpoint(streamed(own).unionByName(first).groupBy("shard", "dims", "lot").applyInArrow(work, schema))
    reached = near.groupBy("query_id").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("found"))
    bound = reached.select(F.col("query_id").alias("id"), F.when(F.col("found") >= k, F.col("kth")).otherwise(F.lit(NOTHING)).alias("least"))
    others = asked.join(bound, "id", "left").select(
        F.explode(F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != home)).alias("shard"), "dims", lot.alias("lot"), F.lit(1).alias("kind"), "id",
        F.coalesce("least", F.lit(NOTHING)).alias("least"), "vector",
    )
    far = streamed(own).unionByName(others).groupBy("shard", "dims", "lot").applyInArrow(work, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.unionByName(far).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
