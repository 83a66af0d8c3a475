"""Token files of independent zstandard frames with a trailing seek table and per-frame checksums.

A file is, in order: one zstandard frame per run of whole documents (raw little-endian unsigned 32-bit ids); a
skippable frame with the directory (per document: id, frame, first id within the frame, number of ids); a skippable
frame with the seek table of the public seekable format (per frame: compressed size, plain size, low 32 bits of the
plain bytes' XXH64; then the number of frames, a descriptor byte and the closing magic). A reader seeks to the end,
reads table and directory, and decompresses only the frames that hold the documents it wants.
"""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import open_store, put_file, shared_folder, small_batches, task_number, written
from .textbytes import batches
from .tokens import encoder

#: Fixed values of the zstandard and seekable formats.
SKIPPABLE_DIRECTORY = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

#: Bytes of text that a file has, about: also what one task writes, and later numbers, at once.
FILE_BYTES = 64 << 20
DIRECTORY = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("frame", "<u4"), ("first", "<u4"), ("n", "<u4")])
SEEK = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])


class FrameWriter:
    """Writes documents to a stream, one frame per frame_bytes of ids or longer single document."""

    def __init__(self, out, frame_bytes: int = 1 << 20, level: int = 3):
        import zstandard

        self.out, self.limit = out, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.waiting: list[bytes] = []
        self.size = 0
        self.seek: list[tuple[int, int, int]] = []
        self.directory: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.waiting and self.size + len(ids) > self.limit:
            self.flush()
        self.directory.append((doc_id or 0, doc_id is not None, len(self.seek), self.size // 4, len(ids) // 4))
        self.waiting.append(ids)
        self.size += len(ids)

    def flush(self) -> None:
        import xxhash

        plain = b"".join(self.waiting)
        packed = self.packer.compress(plain)
        self.out.write(packed)
        self.seek.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.waiting, self.size = [], 0

    def close(self) -> None:
        if self.waiting:
            self.flush()
        rows = np.array(self.directory, DIRECTORY).tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_DIRECTORY, len(rows)) + rows)
        body = np.array(self.seek, SEEK).tobytes() + struct.pack("<IBI", len(self.seek), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(body)) + body)


class FrameReader:
    """Random access to one file; stream is seekable."""

    def __init__(self, stream):
        self.stream = stream
        end = stream.seek(0, io.SEEK_END)
        stream.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", stream.read(9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("no seek table at the end of the file")
        at = end - 9 - n * SEEK.itemsize - 8
        stream.seek(at)
        head = struct.unpack("<II", stream.read(8))
        if head != (SKIPPABLE_SEEK_TABLE, n * SEEK.itemsize + 9):
            raise ValueError("the seek table is damaged")
        self.seek = np.frombuffer(stream.read(n * SEEK.itemsize), SEEK)
        self.starts = np.concatenate(([0], np.cumsum(self.seek["packed"], dtype=np.int64)))
        stream.seek(int(self.starts[-1]))
        kind, size = struct.unpack("<II", stream.read(8))
        if kind != SKIPPABLE_DIRECTORY or size != at - self.starts[-1] - 8:
            raise ValueError("the directory is damaged")
        self.directory = np.frombuffer(stream.read(size), DIRECTORY)

    def frame(self, k: int) -> bytes:
        """The ids of frame k, after both checksums."""
        import xxhash
        import zstandard

        self.stream.seek(int(self.starts[k]))
        packed = self.stream.read(int(self.seek["packed"][k]))
        plain = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(self.seek["plain"][k]))
        if len(plain) != self.seek["plain"][k] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.seek["check"][k]:
            raise ValueError(f"frame {k} fails its checksum")
        return plain

    def documents(self, wanted: set[int] | None = None):
        """(place in the file, doc_id or None, ids) in file order; only frames with wanted documents are decompressed."""
        d = self.directory
        held, plain = -1, b""
        for place, (doc_id, known, frame, first, n) in enumerate(zip(*(d[c].tolist() for c in d.dtype.names))):
            own = doc_id if known else None
            if wanted is not None and own not in wanted:
                continue
            if frame != held:
                held, plain = frame, self.frame(frame)
            yield place, own, plain[4 * first : 4 * (first + n)]


def write_token_frames(docs: DataFrame, folder: str, vocabulary: str, cuts: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Encode every text, append end_id, and write files in ascending id order; returns the written manifest.

    There are as many files as FILE_BYTES of text need (or partitions), whatever the cluster. Manifest: file, part (files
    in order of ids), documents, tokens. Null texts count as empty (just the end id);
    null ids come first; rows that repeat an id lie side by side, ordered by their texts' hashes. An empty table
    gives an empty manifest. Extra columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    size = 0 if partitions else rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    n = partitions or max(1, -(-size // FILE_BYTES))
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def write(frames):
        part, made = task_number(), None
        state = {"documents": 0, "tokens": 0}
        end = struct.pack("<I", end_id)

        def fill(out, first):
            writer = FrameWriter(out)
            for batch in first:
                ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
                for lo, hi in batches(texts, 4_000_000):
                    for doc_id, tokens in zip(ids[lo:hi], encoder(vocabulary, cuts).encode(texts[lo:hi])):
                        writer.add(doc_id, tokens + end)
                        state["documents"] += 1
                        state["tokens"] += len(tokens) // 4 + 1
            writer.close()

        import itertools

        import pyarrow as pa

        frames = (b for b in frames if b.num_rows)
        head = next(frames, None)
        if head is None:
            return
        made = put_file(folder, f"part-{part:06d}.zst", lambda out: fill(out, itertools.chain([head], frames)))
        yield pa.RecordBatch.from_arrays([pa.array([made]), pa.array([part], pa.int32()), pa.array([state["documents"]]), pa.array([state["tokens"]])], names=["file", "part", "documents", "tokens"])

    return written(rows.mapInArrow(write, "file string, part int, documents long, tokens long"), "manifest")


def read_token_frames(manifest: DataFrame, wanted: set[int] | None = None) -> DataFrame:
    """Every document of the files (or the wanted ids, a small set): file, part, place, doc_id, n_tokens, ids (binary)."""

    def read(rows):
        import pyarrow as pa

        schema = pa.schema([("file", pa.string()), ("part", pa.int32()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        for batch in rows:
            for file, part in zip(batch.column("file").to_pylist(), batch.column("part").to_pylist()):
                store, path = open_store(file)
                with store.open_input_file(path) as stream:
                    out, size = [], 0
                    for place, doc_id, ids in FrameReader(stream).documents(wanted):
                        out.append((file, part, place, doc_id, len(ids) // 4, ids))
                        size += len(ids)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                            out, size = [], 0
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    files = manifest.select("file", "part")
    return files.repartition(max(1, files.count()), "part").mapInArrow(read, "file string, part int, place int, doc_id long, n_tokens long, ids binary")


def token_digest(docs: DataFrame, vocabulary: str, cuts: str = "blank", end_id: int = 2) -> DataFrame:
    """Write docs to frames, read them back, and return doc_id, start, n_tokens, ids_crc32 of each document as read.

    start counts the ids of all documents before it: a running sum over the files' totals (one row a file, so one task
    adds as many numbers as there are files), and within each file over its own documents. Null and empty texts have
    the end id alone; null ids come first, repeated ids side by side; an empty table gives no rows; other columns are
    not read.
    """
    manifest = write_token_frames(docs, shared_folder(docs.sparkSession), vocabulary, cuts, end_id)
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("part", before.alias("before"))
    read = read_token_frames(manifest).select("part", "place", "doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    within = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return read.withColumn("within", within).join(files, "part").select("doc_id", (F.col("before") + F.col("within")).cast("long").alias("start"), "n_tokens", F.col("ids_crc32").cast("long").alias("ids_crc32"))


def crc32_of(ids: bytes) -> int:
    return zlib.crc32(ids)
