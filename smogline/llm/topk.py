"""Operator 5: exact top-k inner products by the threshold algorithm.

Components become floor(scale * x) as whole numbers. The index is a table of blocks
of candidates, each with one list per dimension that orders the block by that component.
Blocks of queries meet blocks of candidates (a stated query set against all rows, in
blocks). Within a pair of blocks the lists are read from both ends in rounds of
growing depth; what appears in some list is scored in full, and no unseen candidate can
score more than the sum, over dimensions, of the query component times the list value
reached. A query is done when that bound is below its k-th score; equal bounds go on, as
ties count. The bound starts from the k-th score of the blocks before.

Defined results: vectors that are null or hold a null or non-finite component take no
part, nor do rows with a null id; rows repeated with the same id and vector count once; rows with the same id
and other vectors are queries of their own but never candidates of each other; vectors
meet only vectors of the same length; ties go to the smaller id; fewer than k
candidates give fewer rows; an empty table gives none. Sums that pass 2^53 are taken in Python's whole
numbers, exactly; components beyond a long are held at its ends, and so are scores (they tie there).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from smogline.session import pin_table

from . import common

#: Rows of a candidate block and of a query block; both bound what a task holds.
BLOCK, QUERY_BLOCK = 4096, 1024
#: Groups of candidate blocks that one query block is spread over.
GROUPS = 12


def whole(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, dim, q array<long>): the rows that take part."""
    x = F.col(vec_col).cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return (vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & fine)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.size(x).alias("dim"),
                    F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v).cast("long")).alias("q"))
            .dropDuplicates(["vec_id", "q"]))


def packed(rows: DataFrame, block: Column, lists: bool) -> DataFrame:
    """(dim, block, ids, body, lists): a row for each block, ids in ascending order."""
    def pack(key, t):
        dim = key[0].as_py()
        ids = t.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        flat = t.column("q").combine_chunks().flatten().to_numpy() if dim else np.zeros(0, np.int64)
        body = flat.reshape(len(ids), dim)[order]
        kept = np.argsort(body, axis=0, kind="stable").T.astype(np.int32) if lists else np.zeros(0, np.int32)
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         "ids": [ids[order].tobytes()], "body": [body.tobytes()], "lists": [kept.tobytes()]})

    return rows.withColumn("block", block).groupBy("dim", "block").applyInArrow(
        pack, "dim int, block int, ids binary, body binary, lists binary")


class Best:
    """The best k of each query of a block so far."""

    def __init__(self, ids: np.ndarray, body: np.ndarray, k: int):
        self.ids, self.body, self.k = ids, body, k
        self.query = self.cand = self.score = np.zeros(0, np.int64)
        self.kth = np.full(len(ids), -np.inf)

    def widen(self) -> None:
        """From now on scores are Python's whole numbers."""
        self.score, self.kth = self.score.astype(object), self.kth.astype(object)

    def add(self, active: np.ndarray, scores: np.ndarray, cand: np.ndarray) -> None:
        """``scores`` of the active queries (rows) with some candidates (columns)."""
        if self.score.dtype == object:
            self._add_wide(active, scores, cand)
            return
        own = cand[None, :] == self.ids[active][:, None]
        scores = np.where(own, -np.inf, scores)
        least = self.kth[active]
        if scores.shape[1] >= self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        row, col = np.nonzero((scores >= least[:, None]) & ~own)
        query = np.concatenate([self.query, active[row]])
        cand = np.concatenate([self.cand, cand[col]])
        score = np.concatenate([self.score, scores[row, col].astype(np.int64)])
        order = np.lexsort((cand, -score, query))
        query, cand, score = query[order], cand[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < self.k
        self.query, self.cand, self.score = query[keep], cand[keep], score[keep]
        full = rank == self.k - 1
        self.kth[query[full]] = score[full]

    def _add_wide(self, active: np.ndarray, scores: np.ndarray, cand: np.ndarray) -> None:
        """The same with whole numbers of any size, query by query."""
        for i, q in enumerate(active.tolist()):
            mine = self.query == q
            found = [(min(max(int(s), -2**63), 2**63 - 1), int(c)) for s, c in zip(scores[i], cand) if c != self.ids[q]]
            found = sorted([*found, *zip(self.score[mine].tolist(), self.cand[mine].tolist())], key=lambda x: (-x[0], x[1]))[:self.k]
            self.query = np.concatenate([self.query[~mine], np.full(len(found), q)])
            self.cand = np.concatenate([self.cand[~mine], np.array([c for _, c in found], np.int64)])
            self.score = np.concatenate([self.score[~mine], np.array([s for s, _ in found], object)])
            if len(found) == self.k:
                self.kth[q] = found[-1][0]


def threshold_search(best: Best, ids: np.ndarray, body: np.ndarray, lists: np.ndarray, depth: int = 8) -> int:
    """Let the candidates of one block into ``best``; returns how many were scored."""
    n, dim = body.shape
    largest = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (best.body, body)]
    most = largest[0] * largest[1] * max(dim, 1)
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object
    if kind is object:
        best.widen()
    queries, vectors = best.body.astype(kind), body.astype(kind)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    seen, active = np.zeros(n, bool), np.arange(len(best.ids))
    while len(active):
        depth = min(depth, n)
        new = np.zeros(n, bool)
        if dim and 2 * depth < n:
            new[lists[:, :depth]] = True
            new[lists[:, n - depth:]] = True
        else:
            new[:] = True
        new = np.flatnonzero(new & ~seen)
        seen[new] = True
        if len(new):
            scores = queries[active] @ vectors[new].T
            best.add(active, scores if kind is object else scores.astype(np.float64), ids[new])
        if seen.all():
            break
        across = np.arange(dim)
        low, high = vectors[lists[:, depth - 1], across], vectors[lists[:, n - depth], across]
        bound = up[active] @ high + down[active] @ low
        active = active[bound >= best.kth[active]]
        depth *= 2
    return int(seen.sum())


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
          k: int = 20, scale: int = 64) -> DataFrame:
    """(query_id long, rank int, vec_id long, score long) of each query row."""
    spark = vectors.sparkSession
    rows = pin_table(whole(vectors, id_col, vec_col, scale), "vectors")
    asked = pin_table(whole(queries, id_col, vec_col, scale), "queries")
    n_blocks = max(1, -(-rows.count() // BLOCK))
    n_queries = max(1, -(-asked.count() // QUERY_BLOCK))
    groups = min(GROUPS, n_blocks)
    here = F.xxhash64("vec_id", "q")
    cands = packed(rows, common.hash_part(here, n_blocks, "cand"), True).withColumnRenamed("block", "cand_block")
    asks = packed(asked, common.hash_part(here, n_queries, "query"), False).select(
        "dim", "block", F.col("ids").alias("q_ids"), F.col("body").alias("q_body"))
    pairs = (cands.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
             .withColumn("group", F.col("cand_block") % groups))
    spread = asks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    # blocks grow with the tables: never broadcast, whatever their estimated size
    met = pairs.join(spread.hint("merge"), ["dim", "block", "group"])
    met = met.repartition(common.shuffle_parts(spark), "dim", "block", "group").sortWithinPartitions("dim", "block", "group")

    def run(batches):
        at, best = None, None
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(i)[r].as_py() for i, name in enumerate(batch.schema.names)}
                key, dim = (row["dim"], row["block"], row["group"]), row["dim"]
                if key != at:
                    if best is not None:
                        yield _rows(best)
                    q_ids = np.frombuffer(row["q_ids"], np.int64)
                    best, at = Best(q_ids, np.frombuffer(row["q_body"], np.int64).reshape(len(q_ids), dim), k), key
                ids = np.frombuffer(row["ids"], np.int64)
                threshold_search(best, ids, np.frombuffer(row["body"], np.int64).reshape(len(ids), dim),
                                 np.frombuffer(row["lists"], np.int32).reshape(dim, len(ids)))
        if best is not None:
            yield _rows(best)

    found = met.mapInArrow(run, "query_id long, query_key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _rows(best: Best) -> pa.RecordBatch:
    key = (best.body.astype(np.uint64) * (np.arange(best.body.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1))
           * np.uint64(0x9E3779B97F4A7C15)).sum(axis=1, dtype=np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(best.ids[best.query]), pa.array(key[best.query]), pa.array(best.cand), pa.array(best.score.tolist(), pa.int64())],
        names=["query_id", "query_key", "vec_id", "score"])


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all ``embeddings`` for every row whose vec_id is divisible by 20."""
    vectors = common.table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


ORACLE = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
             CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
