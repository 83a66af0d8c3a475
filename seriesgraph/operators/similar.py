"""Nearest neighbours among stored vectors with relational filters, and chunks of transcripts with their vectors."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.formulas import cosine_distance
from ..functions.parse import word_chunks
from .merge import replace_children


def resolve_target(aliases: DataFrame, entities: DataFrame, handle: str, entity_type: str = "player") -> str:
    """The one entity that an alias of any case stands for; none or several is an error."""
    found = aliases.where(F.lower("platform_name") == handle.lower()).join(entities.where(F.col("entity_type") == entity_type).select("canonical_id"), "canonical_id", "left_semi").select("canonical_id").distinct().limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{handle!r} names {'no entity' if not found else 'several entities'}")
    return found[0][0]


def nearest(vectors: DataFrame, target, k: int = 10, where: Column | None = None, id_col: str = "entity_id", vector_col: str = "embedding", model_col: str | None = "model_version") -> DataFrame:
    """id, distance: the k rows nearest to the target's vector by cosine distance, the target excluded.

    Only rows of the target's model version that meet where (applied before ranking) take part; zero vectors come
    last; ties go to the smaller id. A missing target stops the call.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    model = [F.col(model_col).alias("_model")] if model_col else []
    one = vectors.where(F.col(id_col) == target).select(F.col(vector_col).alias("_target"), *model).limit(1)
    if one.isEmpty():
        raise ValueError(f"no vector for {target!r}")
    rows = vectors.where(F.col(id_col) != target)
    if where is not None:
        rows = rows.where(where)
    rows = rows.crossJoin(F.broadcast(one))  # one row
    if model_col:
        rows = rows.where(F.col(model_col) == F.col("_model"))
    distance = cosine_distance(F.col(vector_col), F.col("_target"))
    return rows.select(F.col(id_col), distance.alias("distance")).orderBy(F.col("distance").asc_nulls_last(), id_col).limit(k)


@dataclass(frozen=True)
class Cells:
    """Stored vectors by coarse cells: rows (id, vector, model_version, cell; one folder a cell) and the cells' centres."""

    rows: DataFrame
    centres: DataFrame


#: Vectors of a cell that are met together, and queries that are held against them at once.
CELL_ROWS, CELL_QUERIES = 8_192, 256


def _unit_rows(column, dim: int) -> np.ndarray:
    """The vectors of an Arrow column of lists as unit rows; NaN where a vector is zero, not finite or of another length."""
    out = np.full((len(column), dim), np.nan)
    for i, v in enumerate(column.to_pylist()):
        if v is not None and len(v) == dim:
            out[i] = v
    with np.errstate(divide="ignore", invalid="ignore"):
        out /= np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out


def _nearest_centres(vectors: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """Row numbers of the n centres nearest to each unit vector, nearest first, ties to the lower; 0 for no vector."""
    d = 1 - np.nan_to_num(vectors) @ centres.T
    return np.argsort(d, axis=1, kind="stable")[:, :n] if n > 1 else d.argmin(axis=1)[:, None]


def _with_cells(rows: DataFrame, centres: DataFrame, vector_col: str, model_col: str, n: int) -> DataFrame:
    """rows with cells: the n nearest of their version's centres; -1 for zero vectors, 0 without centres."""
    by: dict = {}
    for r in centres.orderBy("cell").collect():  # at most 1,024 a model version
        by.setdefault(r["model_version"], []).append((r["cell"], r["centre"]))
    by = {m: (np.array([c for c, _ in found]), _unit_rows(pa.array([c for _, c in found]), len(found[0][1]))) for m, found in by.items()}
    shared = rows.sparkSession.sparkContext.broadcast(by)

    def run(batches):
        for b in batches:
            models, vectors = b.column(model_col).to_pylist(), b.column(vector_col)
            cells: list = [[0]] * b.num_rows
            for model in set(models):
                if model in shared.value:
                    numbers, centres = shared.value[model]
                    at = np.flatnonzero([m == model for m in models])
                    near = _nearest_centres(_unit_rows(vectors.take(pa.array(at)), centres.shape[1]), np.nan_to_num(centres), n)
                    for i, found in zip(at, numbers[near].tolist()):
                        cells[i] = found
            for i, v in enumerate(vectors.to_pylist()):
                if not any(x is not None and x != 0 for x in v):
                    cells[i] = [-1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*b.schema.names, "cells"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, cells array<int>")


def build_cells(vectors: DataFrame, root: str, cells: int | None = None, sample: int = 100_000, id_col: str = "entity_id", vector_col: str = "embedding", model_col: str = "model_version", seed: int = 1) -> Cells:
    """Write vectors below root by cells of each model version, about the square root of their number, at most 1,024.

    Centres are fitted to at most sample vectors of a version (the first by a hash of the id), by k-means on unit
    vectors; every vector is then put into the cell of its nearest centre. Zero vectors lie in cell -1.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import Normalizer
    from pyspark.ml.functions import array_to_vector

    spark = vectors.sparkSession
    own = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(model_col).alias("model_version")).where("id is not null and vector is not null")
    counts = own.groupBy("model_version").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a model version
    unit = Normalizer(inputCol="raw", outputCol="unit")
    centres = []
    for r in counts:
        version = own.where(F.col("model_version").eqNullSafe(r["model_version"]) & F.exists("vector", lambda x: x != 0))
        some = version.orderBy(F.xxhash64("id"), "id").limit(sample).select("id", array_to_vector("vector").alias("raw"))
        some = some.repartition(spark.sparkContext.defaultParallelism, "id")  # a limit leaves one task
        k = min(cells or max(2, min(1024, int(r["n"] ** 0.5))), r["n"])
        if k > 1 and not some.isEmpty():
            model = KMeans(k=k, featuresCol="unit", maxIter=10, seed=seed).fit(unit.transform(some))
            centres += [(r["model_version"], i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
        else:
            centres += [(r["model_version"], 0, x["vector"]) for x in version.select("vector").limit(1).collect()]
    table = spark.createDataFrame(centres, "model_version string, cell int, centre array<double>")
    table.write.mode("overwrite").parquet(f"{root}/centres")
    placed = _with_cells(own, table, "vector", "model_version", 1).withColumn("cell", F.col("cells")[0]).drop("cells")
    placed.write.mode("overwrite").partitionBy("cell").parquet(f"{root}/rows")
    return open_cells(spark, root)


def open_cells(spark, root: str) -> Cells:
    return Cells(spark.read.parquet(f"{root}/rows"), spark.read.parquet(f"{root}/centres"))


def nearest_in_cells(index: Cells, queries: DataFrame, k: int = 10, probes: int = 8) -> DataFrame:
    """query_id, id, distance, rank: about the k nearest of each query (id, vector, model_version) of its own version.

    A query meets the vectors of the probes cells whose centres are nearest to it, exactly and itself left out; with as
    many probes as cells the answer is that of nearest. Cells that no query asks are not read. Zero queries have none.
    """
    asked = queries.where(F.exists("vector", lambda x: x != 0)).select(F.col("id").alias("query_id"), F.col("vector").cast("array<double>").alias("_target"), F.col("model_version").alias("_model"))
    probed = _with_cells(asked, index.centres, "_target", "_model", probes).select("query_id", "_target", "_model", F.explode("cells").alias("cell"))
    # A large cell is met in parts, each on its own, so no cell is too large for a task.
    sizes = index.rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("parts"))
    wanted = F.broadcast(probed.select("cell").distinct())  # no more than there are cells
    wanted = F.broadcast(sizes.join(wanted, "cell"))
    version = lambda c: F.coalesce(F.concat(F.lit("v"), c), F.lit(""))
    met = index.rows.join(wanted, "cell").select("cell", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), version("model_version").alias("version"), "id", "vector")
    probed = probed.join(wanted, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), version("_model").alias("version"), "query_id", "_target")

    def meet(queries: pa.Table, rows: pa.Table) -> pa.Table:
        ids, asking = rows.column("id").to_numpy(), queries.column("query_id").to_numpy()
        own, place, found = [], [], []
        if len(ids) and len(asking):
            dim = len(queries.column("_target")[0])
            x, y = _unit_rows(rows.column("vector"), dim), _unit_rows(queries.column("_target"), dim)
            fit = np.flatnonzero(~np.isnan(x).any(axis=1))
            x, at = x[fit], ids[fit]
            for lo in range(0, len(asking) if len(fit) else 0, CELL_QUERIES):
                near = 1 - y[lo : lo + CELL_QUERIES] @ x.T
                for q, d in enumerate(near, lo):
                    d[at == asking[q]] = np.inf
                    # A little more than k, then each distance on its own, so that equal vectors are equally far.
                    some = np.flatnonzero(d <= np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1] + 1e-12)
                    some = some[np.isfinite(d[some])]
                    exact = 1 - (x[some] * y[q]).sum(axis=1)
                    best = np.lexsort((at[some], exact))[:k]
                    own += [q] * len(best)
                    place.append(fit[some[best]])
                    found.append(exact[best])
        place, found = (np.concatenate([*z, np.zeros(0)]) for z in (place, found))
        return pa.table({"query_id": queries.column("query_id").take(pa.array(own, pa.int64())), "id": rows.column("id").take(pa.array(place.astype(np.int64))), "distance": pa.array(found)})

    kind = lambda df, c: df.schema[c].dataType.simpleString()
    keys = ["cell", "part", "version"]
    rows = probed.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInArrow(meet, f"query_id {kind(probed, 'query_id')}, id {kind(met, 'id')}, distance double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: pairs (query_id, id) of exact, and how many of them were found."""
    hit = found.select("query_id", "id", F.lit(1).alias("_hit"))
    return exact.select("query_id", "id").join(hit, ["query_id", "id"], "left").agg(F.count(F.lit(1)).alias("pairs"), F.count("_hit").alias("found"))


def all_neighbours(vectors: DataFrame, k: int, threshold: float = 0.6, tables: int = 8, bucket: float = 0.5, id_col: str = "entity_id", vector_col: str = "embedding") -> DataFrame:
    """Approximate k nearest of every row by random projections of unit vectors; pairs beyond the distance are not seen."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH, Normalizer
    from pyspark.ml.functions import array_to_vector

    rows = vectors.where(F.exists(vector_col, lambda x: x != 0)).select(F.col(id_col).alias("id"), array_to_vector(F.col(vector_col).cast("array<double>")).alias("raw"))
    unit = Normalizer(inputCol="raw", outputCol="unit").transform(rows)
    model = BucketedRandomProjectionLSH(inputCol="unit", outputCol="hashes", bucketLength=bucket, numHashTables=tables, seed=1).fit(unit)
    # For unit vectors the squared distance is twice the cosine distance.
    near = model.approxSimilarityJoin(unit, unit, (2 * threshold) ** 0.5, "d").where("datasetA.id != datasetB.id")
    pairs = near.select(F.col("datasetA.id").alias(id_col), F.col("datasetB.id").alias("neighbour_id"), (F.col("d") * F.col("d") / 2).alias("distance"))
    rank = F.row_number().over(Window.partitionBy(id_col).orderBy("distance", "neighbour_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k)


def text_chunks(texts: DataFrame, id_col: str, text_col: str, size: int = 180) -> DataFrame:
    """id, chunk_idx (from 0), chunk_text; texts without words have none."""
    return texts.select(id_col, F.posexplode(word_chunks(F.col(text_col), size)).alias("chunk_idx", "chunk_text"))


def embed(chunks: DataFrame, embedder: Callable, dim: int, model_version: str, text_col: str = "chunk_text") -> DataFrame:
    """chunks with embedding and model_version; embedder(list of texts) -> list of vectors, called in tasks by batch."""

    def run(frames):
        import pandas as pd

        for texts in frames:
            vectors = [list(map(float, v)) for v in embedder(texts.tolist())]
            if any(len(v) != dim for v in vectors):
                raise ValueError(f"the embedder must give {dim} numbers a text")
            yield pd.Series(vectors)

    import collections.abc

    import pandas as pd

    run.__annotations__ = {"frames": collections.abc.Iterator[pd.Series], "return": collections.abc.Iterator[pd.Series]}
    return chunks.withColumn("embedding", F.pandas_udf(run, "array<float>")(F.col(text_col))).withColumn("model_version", F.lit(model_version))


def chunk_job(stored: DataFrame, transcripts: DataFrame, embedder: Callable, dim: int, model_version: str, size: int = 180) -> DataFrame:
    """Stored chunks after those of the transcripts in the batch replace their predecessors."""
    fresh = embed(text_chunks(transcripts, "media_id", "text", size), embedder, dim, model_version)
    return replace_children(stored, fresh, ["media_id"], "chunk_idx")


def upsert_vectors(stored: DataFrame, incoming: DataFrame, key: str, dim: int) -> DataFrame:
    """One vector row a key, the incoming ones winning; a wrong dimension stops the job."""
    checked = incoming.withColumn("embedding", F.when(F.size("embedding") == dim, F.col("embedding")).otherwise(F.raise_error(F.lit(f"vectors need {dim} numbers")).cast("array<float>")))
    return stored.join(incoming.select(key), key, "left_anti").unionByName(checked.select(*stored.columns))


def pending(media: DataFrame, done: DataFrame, key: str, oldest: str, limit: int | None = None, include_all: bool = False) -> DataFrame:
    """Rows without a result, oldest first."""
    rows = media if include_all else media.join(done.select(key), key, "left_anti")
    rows = rows.orderBy(oldest, key)
    return rows if limit is None else rows.limit(limit)


def throughput(transcripts: DataFrame, *by: str) -> DataFrame:
    """One row (for each by): seconds of audio and of work, their ratio (NULL without work), languages."""
    return transcripts.groupBy(*by).agg(F.sum("duration_seconds").alias("audio_seconds"), F.sum("wallclock_seconds").alias("work_seconds"), (F.sum("duration_seconds") / F.nullif(F.sum("wallclock_seconds"), F.lit(0.0))).alias("ratio"), F.count_distinct("language").alias("languages"))


def source_mix(media: DataFrame, column: str = "source") -> DataFrame:
    return media.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def search_text(rows: DataFrame, column: str, *patterns: str) -> DataFrame:
    """Case-insensitive LIKE, of any of the patterns."""
    return rows.where(reduce(lambda x, y: x | y, [F.col(column).ilike(p) for p in patterns]))


