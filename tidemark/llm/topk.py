"""Exact top-k search by inner product of integer vectors.

Queries come in blocks of bounded size that are sent to every executor; each task
multiplies a block with its shard of candidates tile by tile, keeps the best of each
query, and the tasks' lists are merged in a tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

K = 10
SCALE = 1024
BLOCK_QUERIES = 8192        # rows of a broadcast block; with 1,024 components 64 MB
TILE_QUERIES = 256
TILE_CANDIDATES = 8192
FAN = 64


def integer_vector(embedding: Column | str, scale: int = SCALE) -> Column:
    """Each component as ``floor(scale * x)``; null if any is null, NaN or infinite."""
    c = F.col(embedding) if isinstance(embedding, str) else embedding
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(c.isNotNull() & F.coalesce(finite, F.lit(False)),
                  F.transform(c, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(vectors: pa.ListArray, dim: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _norm(m: np.ndarray) -> float:
    return float(np.sqrt((m.astype(np.float64) ** 2).sum(axis=1)).max()) if m.size else 0.0


class _Best:
    """The best ``k`` of each query so far, ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k, self.floor = k, np.full(queries, -np.inf)
        self.q = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.vec = np.empty(0, np.int64)

    def add(self, q: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        q, score, vec = (np.concatenate(p) for p in ((self.q, q), (self.score, score), (self.vec, vec)))
        order = np.lexsort((vec, -score, q))
        q, score, vec = q[order], score[order], vec[order]
        starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if q.size else np.empty(0, np.int64)
        place = np.arange(q.size) - np.repeat(starts, np.diff(np.r_[starts, q.size]))
        keep = place < self.k
        self.q, self.score, self.vec = q[keep], score[keep], vec[keep]
        full = place[keep] == self.k - 1
        self.floor[self.q[full]] = self.score[full]


def _tile_hits(scores: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that may enter the lists: at least the list's last score and the tile's k-th."""
    if scores.shape[1] > k and np.isneginf(floor).any():
        floor = np.maximum(floor, np.partition(scores, -k, axis=1)[:, -k])
    return np.nonzero(scores >= floor[:, None])


def _search(shared, dim: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids, packed, kind = shared.value
        exact = np.frombuffer(packed, kind).reshape(-1, dim)
        q_norm, best = _norm(exact), _Best(len(rows), k)
        by_id = np.argsort(ids, kind="stable")
        part = 0
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_CANDIDATES):
                piece = batch.slice(at, TILE_CANDIDATES)
                part = int(piece.column(2)[0].as_py())
                vec = piece.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                shard = _matrix(piece.column(1), dim)
                # any partial sum of a product is at most the product of the norms, so
                # floating point is exact below these bounds
                bound = q_norm * _norm(shard)
                work = np.float32 if bound < 2 ** 24 else np.float64 if bound < 2 ** 53 else np.int64
                left, right = exact.astype(work), np.ascontiguousarray(shard.T.astype(work))
                for lo in range(0, len(rows), TILE_QUERIES):
                    tile = slice(lo, lo + TILE_QUERIES)
                    scores = left[tile] @ right
                    if work is np.int64:
                        own = ids[tile][:, None] == vec[None, :]
                        q, c = np.nonzero(~own)
                    else:
                        _hide_own(scores, ids, by_id, vec, lo)
                        q, c = _tile_hits(scores, best.floor[tile], k)
                        finite = np.isfinite(scores[q, c])
                        q, c = q[finite], c[finite]
                    if q.size:
                        best.add(q + lo, scores[q, c].astype(np.int64), vec[c])
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[best.q]), pa.array(ids[best.q]), pa.array(best.vec), pa.array(best.score),
             pa.array(np.full(best.q.size, part, np.int32))],
            names=["query", "query_id", "vec_id", "score", "part"])

    return run


def _hide_own(scores: np.ndarray, ids: np.ndarray, by_id: np.ndarray, vec: np.ndarray, lo: int) -> None:
    """A query's own id is no candidate."""
    sorted_ids = ids[by_id]
    first, after = np.searchsorted(sorted_ids, vec, "left"), np.searchsorted(sorted_ids, vec, "right")
    for c in np.flatnonzero(after > first):
        q = by_id[first[c]:after[c]] - lo
        scores[q[(q >= 0) & (q < len(scores))], c] = -np.inf


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K,
          block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` best candidates.

    Both sides are ``vec_id, vector`` with integer vectors. Rows with a null id or vector take
    no part; vectors meet those of their own length only. A candidate with the query's id is
    skipped. Repeated query rows are answered each, repeated candidates stand as often as
    they occur. Products have to fit in 64 bits.
    """
    spark = queries.sparkSession
    usable = F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
    asked = materialise(
        queries.where(usable).select(F.monotonically_increasing_id().alias("query"),
                                     F.col("vec_id").cast("long"), "vector",
                                     F.size("vector").alias("dim")), "topk-queries")
    offered = materialise(
        candidates.where(usable).select(F.col("vec_id").cast("long"), "vector",
                                        F.size("vector").alias("dim")), "topk-candidates")
    lists: DataFrame | None = None
    schema = "query long, query_id long, vec_id long, score long, part int"
    for dim, count in asked.where("dim > 0").groupBy("dim").count().orderBy("dim").collect():
        blocks = -(-count // block_queries)
        for block in range(blocks):
            # about block_queries rows, whatever the number of queries
            mine = asked.where((F.col("dim") == dim)
                               & (F.pmod(F.xxhash64("query"), F.lit(blocks)) == block)).toArrow()
            if not mine.num_rows:
                continue
            vectors = _matrix(mine["vector"].combine_chunks(), dim)
            kind = "<i4" if np.abs(vectors).max(initial=0) < 2 ** 31 else "<i8"
            shared = spark.sparkContext.broadcast(
                (mine["query"].to_numpy(), mine["vec_id"].to_numpy(), vectors.astype(kind).tobytes(), kind))
            found = (offered.where(F.col("dim") == dim)
                     .select("vec_id", "vector", F.spark_partition_id().alias("part"))
                     .mapInArrow(_search(shared, dim, k), schema))
            lists = found if lists is None else lists.unionByName(found)
    if lists is None:
        lists = spark.createDataFrame([], schema)
    return _merged(lists, k)


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The tasks' lists by ``FAN`` parts, then those into one."""
    best = (F.col("score").desc(), F.col("vec_id"))
    some = F.row_number().over(Window.partitionBy("query", F.col("part") % FAN).orderBy(*best))
    last = F.row_number().over(Window.partitionBy("query").orderBy(*best))
    return (lists.withColumn("place", some).where(F.col("place") <= k)
            .withColumn("rank", last).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
