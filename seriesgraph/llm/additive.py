"""Approximate nearest neighbours by additive quantisation.

A vector is the sum of one full-dimensional codeword from each of several codebooks. The books are trained on
residuals of a bounded sample; vectors are encoded by beam search; queries score codes from lookup tables of their
products with all codewords, corrected by stored norms; and the best of each shard are ranked again by the original
vectors, in double precision.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import finite_vectors, written
from .topk import QUERY_BLOCK, SHARD, merged, select_best, tiles, unpacked

BOOKS = 16
WORDS = 256
BEAM = 4
#: Vectors that the books are trained on, at most.
SAMPLE = 16_384
#: Candidates of each shard that are ranked again, per query.
RERANK = 128


def train_books(sample: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = 6, seed: int = 7) -> np.ndarray:
    """(books, words, dim) float32 codewords: k-means of what the books before leave over."""
    rng = np.random.default_rng(seed)
    rest = sample.astype(np.float32).copy()
    words = max(1, min(words, len(rest)))
    out = np.zeros((books, words, rest.shape[1]), np.float32)
    for m in range(books):
        centres = rest[rng.choice(len(rest), words, replace=False)].copy()
        for _ in range(rounds):
            near = _nearest(rest, centres)
            counts = np.bincount(near, minlength=words)
            order = np.argsort(near, kind="stable")
            filled = np.flatnonzero(counts)
            sums = np.add.reduceat(rest[order], np.concatenate(([0], np.cumsum(counts[filled])[:-1])), axis=0)
            centres[filled] = sums / counts[filled][:, None]
            if len(filled) < words:
                centres[counts == 0] = rest[rng.choice(len(rest), words - len(filled))]
        out[m] = centres
        rest -= centres[_nearest(rest, centres)]
    return out


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin(((centres**2).sum(1) - 2 * (x @ centres.T)), axis=1)


def encode(vectors: np.ndarray, books: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(codes, sum of each code's codewords); the beam best partial sums survive each book."""
    m, words, dim = books.shape
    out_codes, out_sums = np.empty((len(vectors), m), np.uint8), np.empty((len(vectors), dim), np.float32)
    for lo in range(0, len(vectors), 2048):
        x = vectors[lo : lo + 2048].astype(np.float32)
        rest, codes, error = x[:, None, :], np.zeros((len(x), 1, 0), np.uint8), (x**2).sum(1)[:, None]
        for book in books:
            # Error after adding word w: |r|^2 - 2 r.w + |w|^2.
            cost = error[:, :, None] + (book**2).sum(1) - 2 * (rest @ book.T)
            flat = cost.reshape(len(x), -1)
            keep = min(beam, flat.shape[1])
            best = np.argpartition(flat, keep - 1, axis=1)[:, :keep]
            line = np.arange(len(x))[:, None]
            parent, word = best // words, best % words
            codes = np.concatenate((codes[line, parent], word[:, :, None].astype(np.uint8)), axis=2)
            rest = rest[line, parent] - book[word]
            error = flat[line, best]
        first = np.argmin(error, axis=1)
        line = np.arange(len(x))
        out_codes[lo : lo + 2048] = codes[line, first]
        out_sums[lo : lo + 2048] = x - rest[line, first]
    return out_codes, out_sums


def table_scores(queries: np.ndarray, books: np.ndarray, codes: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """Approximate inner products (candidates x queries) from lookup tables."""
    scores = np.zeros((len(codes), len(queries)), np.float32)
    q = queries.astype(np.float32).T
    for m, book in enumerate(books):
        scores += np.take(book @ q, codes[:, m], axis=0)
    return scores * gains[:, None]


def build_index(rows: DataFrame, books: np.ndarray, beam: int = BEAM) -> DataFrame:
    """vec_id, vector, code (binary), norm (of the vector) and sum_norm (of the sum of its code's words); written."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(books)  # books x words x dim floats, 1 MB at 16 x 256 x 64

    def run(frames):
        import pyarrow as pa

        for batch in frames:
            if not batch.num_rows:
                continue
            x = unpacked(batch.column("vector"), len(batch.column("vector")[0]))
            codes, sums = encode(x, shared.value, beam)
            norm, sum_norm = np.linalg.norm(x.astype(np.float64), axis=1), np.linalg.norm(sums.astype(np.float64), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm), pa.array(sum_norm)], names=["vec_id", "vector", "code", "norm", "sum_norm"])

    kind = rows.schema["vector"].dataType.simpleString()
    return written(rows.mapInArrow(run, f"vec_id long, vector {kind}, code binary, norm double, sum_norm double"), "index")


def approximate_top_k(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", books: int = BOOKS, words: int = WORDS, beam: int = BEAM, sample: int = SAMPLE, rerank: int = RERANK, query_block: int = QUERY_BLOCK, shard: int = SHARD) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: about the k largest inner products, each exact in double precision.

    is_query: a condition on vec_id. Candidates are all rows with another id; ties go to the smaller vec_id. Zero
    vectors and what finite_vectors leaves out take no part. Vectors meet those of their own length. Different vectors
    of an id are candidates of their own, and as queries they share one list. The books of a length are trained on at
    most sample vectors (the first by a hash of the id); every vector is encoded and searched. An empty table gives no
    rows; extra columns are not read.
    """
    spark = vectors.sparkSession
    rows = written(finite_vectors(vectors, id_col, vector_col, nonzero=True), "vectors")
    dims = sorted(r["dim"] for r in rows.select(F.size("vector").alias("dim")).distinct().collect())
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    each = [_found(rows.where(F.size("vector") == dim), dim, is_query, k, books, words, beam, sample, rerank, query_block, shard) for dim in dims]
    found, shards = reduce(DataFrame.unionByName, (x for x, _ in each)), max(n for _, n in each)
    entry = F.struct((-F.col("score")).alias("order"), F.col("vec_id"))
    lists = found.groupBy("query_id", "_shard").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("best"))
    ranked = merged(lists, k, shards).select("query_id", F.posexplode("best").alias("pos", "b"))
    return ranked.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.order")).alias("score"))


def _found(rows: DataFrame, dim: int, is_query, k: int, books: int, words: int, beam: int, sample: int, rerank: int, query_block: int, shard: int) -> tuple[DataFrame, int]:
    """(query_id, _shard, score, vec_id: the best of each shard of vectors of one length; number of shards)."""
    spark = rows.sparkSession
    some = rows.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id", "vector").limit(sample).select("vector").toArrow()
    trained = train_books(unpacked(some.column("vector"), dim), books, words)
    shared = spark.sparkContext.broadcast(trained)
    index = build_index(rows, trained, beam)
    grouped, shards = tiles(rows.where(is_query), index, query_block, shard)

    def tile(table):
        import pyarrow as pa

        ask = np.asarray(table.column("_query").to_numpy(zero_copy_only=False), bool)
        ids = table.column("vec_id").to_numpy()
        x = unpacked(table.column("vector"), dim)
        q_ids, q = ids[ask], x[ask]
        order = np.argsort(ids[~ask], kind="stable")
        c_ids, c = ids[~ask][order], x[~ask][order].astype(np.float64)
        own_rows = table.filter(pa.array(~ask))
        codes = np.frombuffer(b"".join(own_rows.column("code").to_pylist()), np.uint8).reshape(len(c), -1)[order] if len(c) else None
        # A code's sum points about where its vector does; the stored norms give it the vector's length.
        norm, sum_norm = (own_rows.column(c).to_numpy()[order] for c in ("norm", "sum_norm"))
        gains = np.divide(norm, sum_norm, out=np.ones_like(norm), where=sum_norm > 0).astype(np.float32)
        out_q, out_s, out_v = [], [], []
        for lo in range(0, len(q) if len(c) else 0, 256):
            block, block_ids = q[lo : lo + 256], q_ids[lo : lo + 256]
            rough = np.ascontiguousarray(table_scores(block, shared.value, codes, gains).T)
            rough[c_ids[None, :] == block_ids[:, None]] = -np.inf
            best = select_best(rough, min(max(rerank, k), len(c)))
            line = np.arange(len(block))[:, None]
            keep = c_ids[best] != block_ids[:, None]
            score = np.einsum("qrd,qd->qr", c[best], block.astype(np.float64))
            score[~keep] = -np.inf
            top = select_best(score, min(k, score.shape[1]))
            kept = keep[line, top]
            out_q.append(np.repeat(block_ids, top.shape[1])[kept.ravel()])
            out_v.append(c_ids[best[line, top]][kept])
            out_s.append(score[line, top][kept])
        cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        n = sum(map(len, out_q))
        return pa.table({"query_id": cat(out_q, np.int64), "_shard": np.full(n, table.column("_shard")[0].as_py(), np.int32), "score": cat(out_s, np.float64), "vec_id": cat(out_v, np.int64)})

    return grouped.groupBy("_block", "_shard").applyInArrow(tile, "query_id long, _shard int, score double, vec_id long"), shards
