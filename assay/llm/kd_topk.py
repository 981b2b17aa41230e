"""Exact top-k inner-product search with a KD-tree per shard.

Vectors are hashed to shards of bounded size; each shard's task builds a
KD-tree (median splits on the widest side, a tight bounding box per node) and
answers its queries best-first: the node whose box allows the highest inner
product is opened next, and the search ends when no box can reach the k-th
best score so far.  A query first searches one shard; the k-th score found
there is propagated as the bound with which it enters all other shards.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.common import materialize

FOUND_SCHEMA = "query_key long, query_id long, id long, score long"
LONG_MAX = 2**63 - 1


class KDTree:
    """Rows ``x`` (integers as float64) with ids; nodes are kept in arrays."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: int):
        order = np.argsort(ids, kind="stable")
        self.x, self.ids = x[order], ids[order]
        self.span, self.kids, boxes_lo, boxes_hi, first = [], [], [], [], []
        perm, todo = np.arange(len(ids)), [(0, len(ids), None, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            me = len(self.span)
            if parent is not None:
                self.kids[parent][side] = me
            rows = perm[a:b]
            part = self.x[rows]
            lo, hi = part.min(axis=0), part.max(axis=0)
            boxes_lo.append(lo), boxes_hi.append(hi), first.append(int(self.ids[rows].min()))
            self.span.append((a, b))
            self.kids.append([-1, -1])
            widest = int(np.argmax(hi - lo)) if len(lo) else 0
            if b - a > leaf and len(lo) and hi[widest] > lo[widest]:
                middle = (b - a) // 2
                perm[a:b] = rows[np.argsort(part[:, widest], kind="stable")]
                todo += [(a + middle, b, me, 1), (a, a + middle, me, 0)]
        self.lo, self.hi, self.first = np.array(boxes_lo), np.array(boxes_hi), first
        self.x, self.ids = self.x[perm], self.ids[perm]
        self.largest = float(np.abs(self.x).max(initial=0))

    def search(self, queries: np.ndarray, own: np.ndarray, floors: list, k: int) -> list[list[tuple[int, int]]]:
        """Per query the up to ``k`` best (score, id), ids equal to ``own`` left out; only results
        better than the query's floor (score, id), if it has one, are needed."""
        exact = self.largest * float(np.abs(queries).max(initial=0)) * max(1, queries.shape[1]) < 2**53
        bounds = np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T
        if not exact:  # the scores are then computed with Python integers; the bounds get room for rounding
            bounds += np.abs(bounds) * 1e-9 + (np.abs(queries) @ np.maximum(np.abs(self.hi), np.abs(self.lo)).T) * 1e-9
        out = []
        for q, me, bound, floor in zip(queries, own, bounds, floors):
            out.append(self._best_first(q, int(me), bound.tolist(), floor, k, exact))
        return out

    def _best_first(self, q, me, bound, floor, k, exact):
        best: list[tuple[int, int]] = []  # a heap of (score, -id): its root is the k-th best
        worst = None if floor is None else (floor[0], -floor[1])
        heap = [(-bound[0], self.first[0], 0)]
        while heap:
            negative, first, node = heapq.heappop(heap)
            if worst is not None and (-negative, -first) < worst:
                if -negative < worst[0]:
                    break
                continue
            left, right = self.kids[node]
            if left >= 0:
                for child in (left, right):
                    if worst is None or (bound[child], -self.first[child]) >= worst:
                        heapq.heappush(heap, (-bound[child], self.first[child], child))
                continue
            a, b = self.span[node]
            ids = self.ids[a:b]
            if exact:
                scores = self.x[a:b] @ q
                near = np.flatnonzero(scores >= worst[0]) if worst is not None else range(b - a)
                found = [(int(scores[i]), -int(ids[i])) for i in near]
            else:
                whole = [int(v) for v in q]
                found = [(max(-LONG_MAX - 1, min(LONG_MAX, sum(int(v) * w for v, w in zip(row, whole)))), -int(i))
                         for row, i in zip(self.x[a:b], ids)]
            for item in found:
                if -item[1] == me or worst is not None and item < worst:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                else:
                    heapq.heappushpop(best, item)
                if len(best) == k and (worst is None or best[0] > worst):
                    worst = best[0]
        return [(score, -i) for score, i in best]


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), dim)


def _searcher(k: int, leaf: int):
    """Per (dimension, shard) run of sorted rows: candidates first, then queries in batches."""
    def run(batches):
        held, tree, at = [], None, None
        for batch in batches:
            dims, shards = batch.column("dim").to_numpy(), batch.column("shard").to_numpy()
            kinds = batch.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(dims) != 0) | (np.diff(shards) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(dims)]):
                part = batch.slice(int(a), int(b - a))
                key, dim = (int(dims[a]), int(shards[a])), int(dims[a])
                if key != at:
                    held, tree, at = [], None, key
                x = _vectors(part.column("vec"), dim)
                ids = part.column("id").to_numpy()
                if kinds[a] == 0:
                    held.append((x, ids))
                    continue
                if tree is None:
                    if not held:
                        continue
                    tree, held = KDTree(np.concatenate([h[0] for h in held]),
                                        np.concatenate([h[1] for h in held]), leaf), []
                floors = [None if s is None else (s, i) for s, i in zip(part.column("floor_score").to_pylist(),
                                                                        part.column("floor_id").to_pylist())]
                rows = [(qk, qid, i, s) for qk, qid, found in
                        zip(part.column("query_key").to_pylist(), ids.tolist(), tree.search(x, ids, floors, k))
                        for s, i in found]
                columns = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 ["query_key", "query_id", "id", "score"])
    return run


def scaled_vectors(table: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """``id, vec``: each component x becomes floor(scale * x), x as double.  Rows whose id or vector is
    null, or whose vector holds a null or non-finite component, are left out."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return (table.where(F.col(id_col).isNotNull() & v.isNotNull() & ~bad)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("vec")))


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = 4096, leaf: int = 128) -> DataFrame:
    """The ``k`` highest integer inner products per query: ``query_id, rank, id, score``.

    Both inputs have ``id`` (long) and ``vec`` (doubles holding integers).  Candidates with the query's
    own id are left out; ties go to the smaller id; a query with fewer candidates gets them all.

    Edge cases: vectors of another length than the query's are no candidates for it; candidate rows that
    repeat an id and vector count once each; query rows that repeat one count once in all; empty tables give no rows; an
    empty vector scores 0 against every other empty vector; a score beyond a long's range is the nearest long.
    """
    candidates = materialize(candidates.select("id", "vec"), "vectors")
    queries = queries.select("id", "vec").distinct()
    shards = int(candidates.count() // shard_rows) + 1
    none = F.lit(None).cast("long")
    key = F.xxhash64("id", "vec")
    base = candidates.select(F.lit(0).alias("kind"), F.pmod(F.xxhash64(F.lit("shard"), "id"), F.lit(shards)).alias("shard"), "id", "vec",
                             none.alias("query_key"), none.alias("floor_score"), none.alias("floor_id"))
    home = F.pmod(F.xxhash64("id"), F.lit(shards))

    def search(asked: DataFrame) -> DataFrame:
        rows = base.unionByName(asked).withColumn("dim", F.size("vec"))
        return (rows.repartitionById(shards, F.col("shard").cast("int"))
                .sortWithinPartitions("dim", "shard", "kind", "id").mapInArrow(_searcher(k, leaf), FOUND_SCHEMA))

    first = materialize(search(queries.select(F.lit(1).alias("kind"), home.alias("shard"), "id", "vec", key.alias("query_key"),
                                              none.alias("floor_score"), none.alias("floor_id"))), "home-shard")
    worst = (first.groupBy(F.col("query_key").alias("_key"), F.col("query_id").alias("_id"))
             .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("score", (-F.col("id")).alias("minus"))).alias("w"))
             .where(F.col("n") >= k))
    asked = (queries.withColumn("query_key", key).join(worst, (F.col("query_key") == F.col("_key")) & (F.col("id") == F.col("_id")), "left")
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where(F.col("shard") != home)
             .select(F.lit(1).alias("kind"), F.col("shard").cast("long").alias("shard"), "id", "vec", "query_key",
                     F.col("w.score").alias("floor_score"), (-F.col("w.minus")).alias("floor_id")))
    found = first.unionByName(search(asked)) if shards > 1 else first
    best = Window.partitionBy("query_key", "query_id").orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))


def top_k_sql(k: int = 5, every: int = 50) -> str:
    """The same rows in DuckDB SQL, by brute force."""
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.vec, c.vec) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec) WHERE q.vec_id % {every} = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}"""
