"""Exact top-k search: tiled matrix products of queries and shards, partial selection, tree merging.

Queries are dealt into blocks and candidates into shards of bounded size. Each (block, shard) tile is one group with
both sides' vectors; it multiplies them, keeps every query's k best, and the per-query lists are merged by a tree.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import finite_vectors, written

QUERY_BLOCK = 2048
SHARD = 8192
FANIN = 16


def select_best(scores: np.ndarray, k: int) -> np.ndarray:
    """For each row the columns of its k largest scores; of equal ones the smaller column wins. Order is by column."""
    n = scores.shape[1]
    if k >= n:
        return np.broadcast_to(np.arange(n), scores.shape)
    kth = np.partition(scores, n - k, axis=1)[:, n - k : n - k + 1]
    above = scores > kth
    level = scores == kth
    need = k - above.sum(axis=1, keepdims=True)
    if (level.sum(axis=1, keepdims=True) > need).any():
        level &= np.cumsum(level, axis=1) <= need
    return np.nonzero(above | level)[1].reshape(len(scores), k)


def integer_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of float64 matrices of whole numbers, by BLAS where doubles hold them exactly.

    Products that 64 bits may not hold stop the job.
    """
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if most < 2**53:
        return (q @ c.T).astype(np.int64)
    if most >= 2**63:
        raise OverflowError("inner products of these vectors do not fit into 64 bits")
    return q.astype(np.int64) @ c.astype(np.int64).T


def whole_parts(vectors: np.ndarray) -> np.ndarray:
    return np.floor(256.0 * vectors.astype(np.float64))


def unpacked(column, dim: int) -> np.ndarray:
    """The vectors of an Arrow list column as a matrix."""
    values = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return np.asarray(values.flatten()).reshape(-1, dim) if dim else np.zeros((len(values), 0))


def tiles(queries: DataFrame, candidates: DataFrame, query_block: int, shard: int) -> tuple[DataFrame, int]:
    """(queries and candidates of every tile as rows with _block, _shard and _query, number of shards).

    A query goes to every shard and a candidate to every block of queries: the matrix product's own traffic, divided
    by the size of a tile.
    """
    blocks = max(1, -(-queries.count() // query_block))
    shards = max(1, -(-candidates.count() // shard))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    own = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("_block", block).withColumn("_shard", every(shards)).withColumn("_query", F.lit(True))
    right = candidates.withColumn("_shard", own).withColumn("_block", every(blocks)).withColumn("_query", F.lit(False))
    return left.unionByName(right, allowMissingColumns=True), shards


def merged(lists: DataFrame, k: int, shards: int) -> DataFrame:
    """query_id, _shard, best (array of struct<order, vec_id>, ascending) -> one list per query, FANIN lists at a time."""
    n = shards
    while True:
        n = -(-n // FANIN)
        lists = lists.groupBy("query_id", F.floor(F.col("_shard") / FANIN).cast("int").alias("_shard")).agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
        if n <= 1:
            return lists.select("query_id", "best")


def exact_top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", query_block: int = QUERY_BLOCK, shard: int = SHARD) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k largest integer inner products of floor(256 * component).

    is_query: a condition on vec_id. Candidates are all rows with another id; ties go to the smaller vec_id. What
    finite_vectors leaves out takes no part. Vectors meet those of their own length. Different vectors of an id are
    candidates of their own, and as queries they share one list. Scores that 64 bits may not hold
    stop the job. A table with no query or a lone vector gives no rows for it. Extra columns are not read.
    """
    rows = written(finite_vectors(vectors, id_col, vector_col), "vectors")
    grouped, shards = tiles(rows.where(is_query), rows, query_block, shard)

    def tile(table):
        import pyarrow as pa

        ask = np.asarray(table.column("_query").to_numpy(zero_copy_only=False), bool)
        ids = table.column("vec_id").to_numpy()
        dim = len(table.column("vector")[0])
        whole = whole_parts(unpacked(table.column("vector"), dim))
        q_ids, q = ids[ask], whole[ask]
        order = np.argsort(ids[~ask], kind="stable")
        c_ids, c = ids[~ask][order], whole[~ask][order]
        out_q, out_s, out_v = [], [], []
        for lo in range(0, len(q) if len(c) else 0, 512):
            products = integer_products(q[lo : lo + 512], c)
            own = c_ids[None, :] == q_ids[lo : lo + 512, None]
            # As many columns more are selected as a query meets rows of its own id.
            best = select_best(products, min(k + int(own.sum(axis=1).max()), len(c)))
            line = np.arange(len(best))[:, None]
            keep = ~own[line, best]
            out_q.append(np.repeat(q_ids[lo : lo + 512], best.shape[1])[keep.ravel()])
            out_v.append(c_ids[best][keep])
            out_s.append(products[line, best][keep])
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        n = sum(map(len, out_q))
        return pa.table({"query_id": cat(out_q), "_shard": np.full(n, table.column("_shard")[0].as_py() if len(table) else 0, np.int32), "score": cat(out_s), "vec_id": cat(out_v)})

    found = grouped.groupBy(F.size("vector"), "_block", "_shard").applyInArrow(tile, "query_id long, _shard int, score long, vec_id long")
    # Ascending order of the complement is descending order of the score, without overflow at the least long.
    entry = F.struct(F.bitwise_not("score").alias("order"), F.col("vec_id"))
    lists = found.groupBy("query_id", "_shard").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("best"))
    ranked = merged(lists, k, shards).select("query_id", F.posexplode("best").alias("pos", "b"))
    return ranked.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.bitwise_not("b.order").alias("score"))


