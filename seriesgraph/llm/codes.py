"""Vector codes: parts of integer vectors by the nearest entry of a codebook, with exact integer arithmetic.

Vectors are kept as blocks: in each dimension the distinct integers of the block, and for each vector the place of its
integer among them. To find a part's nearest entry, the squared differences of those distinct integers to all entries
are tabulated once a dimension; a part's distances are then gathers from these tables, added up. The means of an entry's
parts come from counts of (entry, place) times the integers, so that no vector is ever unpacked.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, whole_if_small, written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Vectors of a block: its dictionaries have as many integers at most.
BLOCK = 4096


def whole_parts(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * component) as 64-bit integers; components whose squared distances 64 bits can't hold stop the job."""
    floors = np.floor(256.0 * vectors.astype(np.float64))
    _hold(float(np.abs(floors).max(initial=0)), vectors.shape[1])
    return floors.astype(np.int64)


def _hold(largest: float, dim: int) -> None:
    if max(1, dim) * (2 * largest) ** 2 >= 2**63:
        raise OverflowError("squared distances of these vectors do not fit into 64 bits")


def dictionaries(vectors: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(the distinct integers of each dimension, ascending; the place of each vector's integers among them)."""
    values, places = [], np.empty(vectors.shape, np.uint16)
    for d in range(vectors.shape[1]):
        distinct, place = np.unique(vectors[:, d], return_inverse=True)
        values.append(distinct)
        places[:, d] = place
    return values, places


def nearest_entries(values: list[np.ndarray], places: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(each part's nearest entry, ties to the lower; the squared distances to them, added over parts).

    books: (parts, entries, width) integers; dimensions past the last are not there.
    """
    parts, entries, width = books.shape
    chosen, error = np.zeros((len(places), parts), np.int64), np.zeros(len(places), np.int64)
    _hold(max([float(np.abs(books).max(initial=0)), *(float(np.abs(v).max(initial=0)) for v in values)]), len(values))
    for p in range(parts):
        total = np.zeros((len(places), entries), np.int64)
        for j, d in enumerate(range(p * width, min((p + 1) * width, len(values)))):
            table = (values[d][:, None] - books[p, :, j]) ** 2
            total += np.take(table, places[:, d], axis=0)
        chosen[:, p] = total.argmin(axis=1)
        error += total[np.arange(len(places)), chosen[:, p]]
    return chosen, error


def entry_sums(values: list[np.ndarray], places: np.ndarray, chosen: np.ndarray, shape: tuple[int, int, int]) -> np.ndarray:
    """(parts, entries, 1 + width): how many parts chose an entry, and their sums by position."""
    parts, entries, width = shape
    out = np.zeros((parts, entries, 1 + width), np.int64)
    for p in range(parts):
        out[p, :, 0] = np.bincount(chosen[:, p], minlength=entries)
        for j, d in enumerate(range(p * width, min((p + 1) * width, len(values)))):
            n = len(values[d])
            seen = np.bincount(chosen[:, p] * n + places[:, d], minlength=entries * n).reshape(entries, n)
            out[p, :, 1 + j] = seen @ values[d]
    return out


def first_books(vectors: np.ndarray, parts: int) -> np.ndarray:
    """Each part position's codebook from the parts of these vectors; a last part that is too short ends in zeros."""
    width = max(1, -(-vectors.shape[1] // parts))
    padded = np.zeros((len(vectors), parts * width), np.int64)
    padded[:, : vectors.shape[1]] = vectors
    return padded.reshape(len(vectors), parts, width).transpose(1, 0, 2).copy()


def books_digest(books: np.ndarray, dim: int) -> str:
    """SHA-256 of all entries' decimal components by part, entry and position, joined by commas."""
    width = books.shape[2]
    numbers = (str(x) for p, book in enumerate(books) for entry in book for x in entry[: max(0, dim - p * width)].tolist())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _blocks(rows: DataFrame, label_kind: str) -> DataFrame:
    """rows (vec_id, label, vector) as written blocks of one length each."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            lengths = np.asarray(batch.column("vector").value_lengths())
            for dim in np.unique(lengths).tolist():
                of = np.flatnonzero(lengths == dim)
                for lo in range(0, len(of), BLOCK):
                    part = batch.take(pa.array(of[lo : lo + BLOCK]))
                    n = part.num_rows
                    vectors = whole_parts(np.asarray(part.column("vector").flatten(), np.float64).reshape(n, dim))
                    values, places = dictionaries(vectors)
                    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), one(part.column("vec_id")), one(part.column("label")), pa.array([[v.tolist() for v in values]], pa.list_(pa.list_(pa.int64()))), pa.array([places.tobytes()], pa.binary())],
                        names=["dim", "vec_ids", "labels", "values", "places"],
                    )

    return written(rows.mapInArrow(run, f"dim int, vec_ids array<long>, labels array<{label_kind}>, values array<array<long>>, places binary"), "blocks")


def _opened(batches):
    """(dim, ids, labels, values, places) of each block."""
    for batch in batches:
        for i in range(batch.num_rows):
            dim = batch.column("dim")[i].as_py()
            ids = batch.column("vec_ids")[i].values if "vec_ids" in batch.schema.names else None
            labels = batch.column("labels")[i].values if ids is not None else None
            values = [np.asarray(v.values, np.int64) for v in batch.column("values")[i]]
            raw = batch.column("places")[i].as_py()
            n = len(raw) // (2 * dim) if dim else len(ids if ids is not None else ())
            yield dim, ids, labels, values, np.frombuffer(raw, np.uint16).reshape(n, dim)


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row whose vector has finite components only.

    Null vectors and those with null or non-finite components go; an empty vector has the code of all zeros and no
    error. Components become floor(256 * component). A codebook starts as that part of the entries smallest ids (null
    ids last; of equal ids the smaller vector first), so it has fewer entries where rows are fewer. Equal rows stay
    rows of their own and count as often as they come. Vectors meet those of their own length, each with codebooks of
    its own; a length that parts doesn't divide leaves the last parts short. label_error adds the errors of equal
    labels over all lengths, null labels together. Extra columns are not read, so their names don't matter; an empty
    table gives no rows.

    The driver holds codebooks and their sums only: (1 + width) * parts * entries integers a length.
    """
    spark = vectors.sparkSession
    small_batches(spark, BLOCK)
    inf = float("inf")
    label_kind = vectors.select(label_col).schema[0].dataType.simpleString()
    if label_kind == "void":
        label_kind = "int"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast(label_kind).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)))
    blocks = _blocks(rows, label_kind)
    books: dict[int, np.ndarray] = {}
    for dim in sorted(r["dim"] for r in blocks.select("dim").distinct().collect()):
        some = rows.where(F.size("vector") == dim).orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
        books[dim] = first_books(whole_parts(np.array([r["vector"] for r in some], np.float64).reshape(len(some), dim)), parts)
    for _ in range(rounds):
        books = _moved(blocks, books)
    final = spark.sparkContext.broadcast({dim: (b, books_digest(b, dim)) for dim, b in books.items()})

    def code(batches):
        import pyarrow as pa

        for dim, ids, labels, values, places in _opened(batches):
            book, digest = final.value[dim]
            chosen, error = nearest_entries(values, places, book)
            hexes = chosen.astype(np.uint8).tobytes().hex()
            step = 2 * chosen.shape[1]
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array([hexes[i : i + step] for i in range(0, len(hexes), step)], pa.string()), pa.array(error), pa.array([digest] * len(error), pa.string())], names=["vec_id", "label", "code", "error", "codebooks_sha256"])

    coded = written(blocks.mapInArrow(code, f"vec_id long, label {label_kind}, code string, error long, codebooks_sha256 string"), "coded")
    sums = whole_if_small(written(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "labels"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _moved(blocks: DataFrame, books: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Codebooks whose entries are the floored means of the parts nearest to them; unused entries stay."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for dim, _, _, values, places in _opened(batches):
            book = shared.value[dim]
            chosen, _ = nearest_entries(values, places, book)
            found = entry_sums(values, places, chosen, book.shape)
            sums[dim] = sums[dim] + found if dim in sums else found
        for dim, found in sums.items():
            flat = found.ravel()
            cells = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells), dim, np.int32)), pa.array(cells.astype(np.int32)), pa.array(flat[cells])], names=["dim", "cell", "n"])

    # An empty vector has no part to move an entry by.
    used = blocks.where("dim > 0").select("dim", "values", "places")
    totals = used.mapInArrow(run, "dim int, cell int, n long").groupBy("dim", "cell").agg(F.sum("n").alias("n")).collect()
    out = {}
    for dim, book in books.items():
        found = np.zeros((*book.shape[:2], 1 + book.shape[2]), np.int64)
        flat = found.ravel()
        for r in totals:
            if r["dim"] == dim:
                flat[r["cell"]] = r["n"]
        count = found[:, :, :1]
        out[dim] = np.where(count > 0, found[:, :, 1:] // np.maximum(count, 1), book)
    return out
