"""Exact top-k inner-product search with the threshold algorithm.

Vectors are packed into blocks of bounded size; every block of candidates meets
every block of queries.  For a candidate block one list per dimension is sorted by
that component.  A query walks the lists of its non-zero dimensions from the
favourable end, in rounds of growing depth and for a whole query block at once;
vectors met are scored in full.  The next components of all lists bound what an
unseen vector can score, and a query stops when that bound is below the k-th
score found so far, also over earlier blocks of the same task.  The last round
reaches the lists' end, so results are exact.

Components are scaled to integers first, so scores are exact integers.

Defined results: vectors that are null, or hold a null or non-finite component,
and rows without an id take no part; rows that repeat a ``vec_id`` are candidates of
their own, one result row each, and as queries share one list of ``k``; a query's own
id is no candidate; only vectors of equal length are compared; ties go to the smaller
id; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, written

BLOCK = "part int, k int, dim int, ids binary, vectors binary"
FOUND = "query_id long, vec_id long, score long"


def integer_vectors(embeddings: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v): valid vectors with components floor(scale * x)."""
    x = F.col("embedding")
    sound = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return (embeddings.where(F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(sound, F.lit(False)))
            .select("vec_id", F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v")))


def _blocks(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            nonlocal k
            ids, vectors = zip(*held.pop(dim))
            k += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([k], pa.int32()), pa.array([dim], pa.int32()),
                 pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                 pa.array([np.array(vectors, np.int64).tobytes()], pa.binary())],
                ["part", "k", "dim", "ids", "vectors"])

        for b in batches:
            column = b.column(1)
            for i, vec in zip(b.column(0).to_pylist(), column):
                v = vec.values.to_numpy(zero_copy_only=False)
                mine = held.setdefault(len(v), [])
                mine.append((i, v))
                if len(mine) >= rows:
                    yield out(len(v))
        for dim in list(held):
            yield out(dim)
    return run


class SortedLists:
    """A candidate block with its per-dimension sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.n = ids, len(ids)
        self.v = vectors
        self.asc = np.argsort(vectors, axis=0, kind="stable")
        self.peak = int(np.abs(vectors).max(initial=0))

    def met(self, depth: int, top: bool) -> np.ndarray:
        """dimension x row: 1 where the row is among the first ``depth`` of the list."""
        rows = self.asc[self.n - depth:] if top else self.asc[:depth]
        m = np.zeros((self.v.shape[1], self.n), np.float32)
        m[np.arange(self.v.shape[1]), rows] = 1
        return m

    def next_value(self, depth: int, top: bool) -> np.ndarray:
        row = self.asc[self.n - 1 - depth] if top else self.asc[depth]
        return self.v[row, np.arange(self.v.shape[1])]


def search_block(block: SortedLists, query_ids, queries, k: int, best: tuple[np.ndarray, np.ndarray]):
    """Improve ``best`` (scores and ids per query, best first, unused: lowest
    value and -1) by the block's vectors."""
    score, ident = best
    low = np.iinfo(np.int64).min
    exact = block.peak * int(np.abs(queries).max(initial=0)) * max(1, queries.shape[1]) < 1 << 53
    cast = (lambda x: x.astype(np.float64)) if exact else (lambda x: x)
    gain, loss = np.maximum(queries, 0), np.minimum(queries, 0)
    rises, falls = (queries > 0).astype(np.float32), (queries < 0).astype(np.float32)
    seen = np.zeros((len(queries), block.n), bool)
    active = np.arange(len(queries))
    for depth in sorted({0, min(block.n, 1 + block.n // 256), min(block.n, 1 + block.n // 32), block.n}):
        if depth == block.n:
            now = ~seen[active]                  # the lists' end: whatever is left
        elif depth:
            now = rises[active] @ block.met(depth, True) + falls[active] @ block.met(depth, False) > 0
            now &= ~seen[active]
        if depth:
            seen[active] |= now
            cols = np.flatnonzero(now.any(axis=0))
            got = (cast(queries[active]) @ cast(block.v[cols]).T).astype(np.int64)
            fresh = now[:, cols] & (block.ids[cols][None, :] != query_ids[active][:, None])
            got = np.where(fresh, got, low)
            least = score[active, -1]
            if len(cols) > k:
                least = np.maximum(least, np.partition(got, len(cols) - k, axis=1)[:, len(cols) - k])
            q, c = np.nonzero(fresh & (got >= least[:, None]))
            old_q = np.repeat(np.arange(len(active)), k)
            all_q = np.concatenate([old_q, q])
            all_s = np.concatenate([score[active].ravel(), got[q, c]])
            all_i = np.concatenate([ident[active].ravel(), block.ids[cols][c]])
            unused = np.concatenate([ident[active].ravel() == -1, np.zeros(len(q), bool)])
            order = np.lexsort((all_i, -all_s.astype(np.float64) if exact else ~all_s, unused, all_q))
            first = np.searchsorted(all_q[order], np.arange(len(active)))
            pick = order[first[:, None] + np.arange(k)]
            score[active], ident[active] = all_s[pick], all_i[pick]
        if depth < block.n:
            bound = gain[active] @ block.next_value(depth, True) + loss[active] @ block.next_value(depth, False)
            active = active[(bound >= score[active, -1]) | (ident[active, -1] == -1)]
            if not len(active):
                return


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, block_key, block = None, None, None
        held: dict[tuple, tuple] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for ids, _, (score, ident) in held.values():
                used = ident != -1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, used.sum(axis=1))), pa.array(ident[used]), pa.array(score[used])],
                    ["query_id", "vec_id", "score"])

        for b in batches:
            for r in b.to_pylist():
                if (r["lane"], r["strip"]) != group:
                    yield from out()
                    group, held = (r["lane"], r["strip"]), {}
                if (r["part"], r["k"]) != block_key:
                    block_key = (r["part"], r["k"])
                    block = SortedLists(np.frombuffer(r["ids"], np.int64),
                                        np.frombuffer(r["vectors"], np.int64).reshape(-1, r["dim"]))
                q = (r["q_part"], r["q_k"])
                if q not in held:
                    ids = np.frombuffer(r["q_ids"], np.int64)
                    best = np.full((len(ids), k), np.iinfo(np.int64).min), np.full((len(ids), k), -1, np.int64)
                    held[q] = ids, np.frombuffer(r["q_vectors"], np.int64).reshape(-1, r["dim"]), best
                search_block(block, held[q][0], held[q][1], k, held[q][2])
        yield from out()
    return run


def top_k(embeddings: DataFrame, is_query, k: int = 20, scale: int = 64, block_rows: int = 8192,
          query_rows: int = 512) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best candidates.

    A grid of lanes (by query block) and strips (by candidate block) joins the
    blocks: candidate blocks are copied to every lane, query blocks to every strip."""
    spark = embeddings.sparkSession
    vectors = written(integer_vectors(embeddings.select("vec_id", "embedding"), scale), "topk-vectors")
    queries = written(vectors.where(is_query).mapInArrow(_blocks(query_rows), BLOCK), "topk-queries")
    blocks = written(vectors.mapInArrow(_blocks(block_rows), BLOCK), "topk-blocks")
    lanes = max(1, queries.count())
    strips = max(1, min(blocks.count(), -(-shuffle_partitions(spark) // lanes)))
    left = blocks.withColumn("strip", F.pmod(F.xxhash64("part", "k"), F.lit(strips))).withColumn(
        "lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)).cast("array<long>")))
    right = queries.select(
        F.pmod(F.xxhash64("part", "k"), F.lit(lanes)).alias("lane"), F.col("part").alias("q_part"),
        F.col("k").alias("q_k"), "dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
        F.explode(F.sequence(F.lit(0), F.lit(strips - 1)).cast("array<long>")).alias("strip"))
    found = (left.join(right, ["lane", "strip", "dim"])
             .repartition("lane", "strip").sortWithinPartitions("lane", "strip", "part", "k")
             .mapInArrow(_search(k), FOUND))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
