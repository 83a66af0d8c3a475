"""WARC archives: a writer with one gzip member per record, and a splittable reader.

The reader's tasks get byte ranges. A task scans its range for the gzip magic, takes a candidate as a member only if
its first bytes decode to a WARC version line, and owns the records that start inside its range, however far they
reach beyond it; so every record is read by exactly one task, whatever the ranges.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import open_store, put_file, shared_folder, small_batches, task_number, written

#: Fixed values of the formats.
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:x-page:"
DATE = "2024-01-01T00:00:00Z"

#: Payloads below this many bytes are stored in full even when they repeat.
REVISIT_BYTES = 100
SPLIT_BYTES = 4 << 20

READ_SCHEMA = "file string, offset long, record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def _line(text: str) -> str:
    """A header value on one line."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record(kind: str, record_id: str, uri: str | None, payload: bytes, digest: str, refers_to: str | None = None) -> bytes:
    """One gzip member. A revisit has no payload, only its digest and length."""
    block = b"" if kind == "revisit" else (HTTP % len(payload)) + payload
    heads = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if uri is not None:
        heads.append(f"WARC-Target-URI: {_line(uri)}")
    if kind == "revisit":
        heads += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    else:
        heads.append("Content-Type: application/http; msgtype=response")
    heads.append(f"Content-Length: {len(block)}")
    return gzip.compress(VERSION + "\r\n".join(heads).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, html (null: empty), digest, record_type, refers_to.

    Of equal payloads of at least REVISIT_BYTES the smallest page_id is the response (rows that repeat that id all
    are); a null id never is while another exists. The first ids come from a partial aggregate, so a payload that a
    third of all pages share costs one row a task; the join back is one that Spark splits when it is skewed.
    """
    small_batches(pages.sparkSession)
    html = F.coalesce(F.col(html_col), F.lit(""))
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html")).withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256))
    alike = base.where(F.octet_length("html") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    first = written(alike.select("digest", "first"), "first")
    repeat = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = base.join(first, "digest", "left")
    return joined.select("page_id", "url", "html", "digest", F.when(repeat, "revisit").otherwise("response").alias("record_type"), F.when(repeat, F.col("first")).alias("refers_to"))


def write_warc(marked: DataFrame, folder: str) -> DataFrame:
    """Write the rows of mark_revisits, a file per partition that has rows; returns the written manifest (file, bytes, records)."""

    def write(frames):
        import itertools

        import pyarrow as pa

        frames = (b for b in frames if b.num_rows)
        head = next(frames, None)
        if head is None:
            return
        state = {"bytes": 0, "records": 0}

        def fill(out):
            for batch in itertools.chain([head], frames):
                for row in batch.to_pylist():
                    refers = None if row["refers_to"] is None else f"{RECORD_ID}{row['refers_to']}"
                    own = f"{RECORD_ID}{'null' if row['page_id'] is None else row['page_id']}"
                    member = record(row["record_type"], own, row["url"], row["html"].encode("utf-8", "surrogatepass"), row["digest"], refers)
                    out.write(member)
                    state["bytes"] += len(member)
                    state["records"] += 1

        file = put_file(folder, f"part-{task_number():06d}.warc.gz", fill)
        yield pa.RecordBatch.from_pydict({"file": [file], "bytes": [state["bytes"]], "records": [state["records"]]})

    return written(marked.mapInArrow(write, "file string, bytes long, records long"), "manifest")


class RangeReader:
    """Members of one file that start in [start, end)."""

    STEP = 1 << 18

    def __init__(self, stream, size: int, start: int, end: int):
        self.stream, self.size, self.start, self.end = stream, size, start, min(end, size)

    def _read(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(min(n, self.size - at))

    def _is_member(self, at: int) -> bool:
        """Headers decide: the candidate must inflate to a WARC version line."""
        try:
            return zlib.decompressobj(31).decompress(self._read(at, 4096), 5) == b"WARC/"
        except zlib.error:
            return False

    def _next_member(self, at: int) -> int | None:
        while at < self.end:
            # Two bytes more, for a magic that starts in this step and ends in the next.
            data = self._read(at, min(self.STEP, self.end - at) + len(GZIP_MAGIC) - 1)
            found = data.find(GZIP_MAGIC)
            while found >= 0 and at + found < self.end:
                if self._is_member(at + found):
                    return at + found
                found = data.find(GZIP_MAGIC, found + 1)
            at += self.STEP
        return None

    def _inflate(self, at: int) -> tuple[bytes, int]:
        engine, out = zlib.decompressobj(31), []
        while not engine.eof:
            data = self._read(at, self.STEP)
            if not data:
                raise ValueError("a record ends before its member does")
            out.append(engine.decompress(data))
            at += len(data)
        return b"".join(out), at - len(engine.unused_data)

    def members(self):
        """(offset, plain bytes) of every record owned."""
        at = self._next_member(self.start)
        while at is not None:
            plain, after = self._inflate(at)
            yield at, plain
            at = self._next_member(after) if after < self.end else None


def parse(plain: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, block)."""
    head, _, rest = plain.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return headers, rest[: int(headers.get("content-length", 0))]


def read_warc(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of the archives; files has file and bytes (a manifest, or a binaryFile scan's path and length).

    A response's payload is what follows the HTTP headers and must match its digest; a revisit's payload is null and
    its digest and length are those of the payload it stands for. An empty list of files gives no rows.
    """
    starts = files.select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start"))

    def read(frames):
        import pyarrow as pa

        schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        make = lambda out: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        for batch in frames:
            for row in batch.to_pylist():
                store, path = open_store(row["file"])
                out, held = [], 0
                with store.open_input_file(path) as stream:
                    for at, plain in RangeReader(stream, row["bytes"], row["start"], row["start"] + split_bytes).members():
                        heads, block = parse(plain)
                        kind, digest, payload = heads.get("warc-type"), heads.get("warc-payload-digest", "").removeprefix("sha256:"), None
                        length = int(heads.get("x-payload-length", 0))
                        if kind != "revisit":
                            payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
                            length = len(payload)
                            if digest and hashlib.sha256(payload).hexdigest() != digest:
                                raise ValueError(f"the payload at {row['file']}:{at} doesn't match its digest")
                        out.append((row["file"], at, kind, heads.get("warc-record-id", "").strip("<>"), heads.get("warc-target-uri"), heads["warc-refers-to"].strip("<>") if "warc-refers-to" in heads else None, digest, length, payload))
                        held += len(payload or b"")
                        if held > 8 << 20:
                            yield make(out)
                            out, held = [], 0
                if out:
                    yield make(out)

    n = max(1, starts.count())
    return starts.repartition(n, "file", "start").mapInArrow(read, READ_SCHEMA)


def archive_digest(pages: DataFrame) -> DataFrame:
    """Write pages to archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to of each record.

    Null html counts as empty, null and repeated ids keep their records, an empty table gives none, and columns other
    than page_id, url and html are not read.
    """
    files = write_warc(mark_revisits(pages), shared_folder(pages.sparkSession))
    number = lambda c: F.try_element_at(F.split(F.col(c), RECORD_ID), F.lit(2)).try_cast("long")
    full = F.col("payload").isNotNull()
    return read_warc(files).select(
        number("record_id").alias("page_id"),
        F.when(full, F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        F.when(full, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )
