"""Vector bin packing of examples into fixed-length training sequences.

Every example demands three things of a sequence at once: tokens, segments (one each) and loss-bearing tokens. A
sequence is filled by the dot-product heuristic: of the waiting examples that fit, take the one whose demand (as
shares of the limits) has the largest dot product with what the sequence has left. Tasks stream their own partition
through a bounded pool, so packing needs no shuffle, and one partition leaves one open sequence at most.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, task_number
from .textbytes import batches
from .tokens import encoder


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 4096
    segments: int = 256
    loss: int = 4096


#: Tokens that wait in a task before sequences are filled from them; more gives the heuristic more choice.
POOL_TOKENS = 1 << 20


class Packer:
    """Packs pieces (key, start, ids, loss flags or None) into sequences; emit(sequence, offset, piece, ids) per piece.

    cut: pieces may be cut anywhere; else only those longer than a sequence are. An uncut example that no open
    sequence can hold opens one of its own. The last tokens are dealt to sequences whose lengths are powers of two.
    """

    def __init__(self, limits: Limits, cut: bool, first_sequence: int, pool_tokens: int = POOL_TOKENS):
        self.limits, self.cut, self.pool_tokens = limits, cut, pool_tokens
        self.next = first_sequence
        self.waiting: dict[tuple[int, int], list] = {}  # (tokens, loss) -> pieces, alike in demand
        self.held = 0
        self.out: list[tuple] = []

    @staticmethod
    def _loss(piece) -> int:
        """The first token of a segment has nothing before it to be predicted from."""
        flags = piece[3]
        n = len(piece[2]) // 4
        return n - 1 if flags is None else int(flags[1:].sum())

    def _wait(self, piece) -> None:
        self.waiting.setdefault((len(piece[2]) // 4, self._loss(piece)), []).append(piece)
        self.held += len(piece[2]) // 4

    def _take(self, kind) -> tuple:
        same = self.waiting[kind]
        piece = same.pop()
        if not same:
            del self.waiting[kind]
        self.held -= kind[0]
        return piece

    @staticmethod
    def _split(piece, n: int) -> tuple[tuple, tuple]:
        key, start, ids, flags = piece
        return (key, start, ids[: 4 * n], None if flags is None else flags[:n]), (key, start + n, ids[4 * n :], None if flags is None else flags[n:])

    def add(self, piece) -> None:
        """Whole sequences of a long piece leave at once; what remains waits."""
        while len(piece[2]) // 4 > self.limits.tokens:
            head, piece = self._split(piece, self.limits.tokens)
            if self._loss(head) > self.limits.loss:
                head, tail = self._within_loss(head)
                piece = (piece[0], tail[1], tail[2] + piece[2], None if piece[3] is None else np.concatenate((tail[3], piece[3])))
            self._emit([head])
        while self._loss(piece) > self.limits.loss:
            head, piece = self._within_loss(piece)
            self._emit([head])
        self._wait(piece)
        if self.held >= self.pool_tokens:
            self.fill(self.pool_tokens // 4)

    def _within_loss(self, piece):
        n = len(piece[2]) // 4
        bearing = np.ones(n, bool) if piece[3] is None else piece[3].copy()
        bearing[0] = False
        return self._split(piece, int(np.searchsorted(np.cumsum(bearing), self.limits.loss + 1)))

    def _emit(self, pieces) -> None:
        offset = 0
        for key, start, ids, _ in pieces:
            self.out.append((key, start, ids, self.next, offset))
            offset += len(ids) // 4
        self.next += 1

    def fill(self, leave: int = 0) -> None:
        """Fill sequences until at most leave tokens wait."""
        cap = np.array([self.limits.tokens, self.limits.loss], float)
        while self.held > leave and (leave or self.held >= self.limits.tokens or not self.cut):
            room, loss_room, segments, chosen = self.limits.tokens, self.limits.loss, self.limits.segments, []
            kinds = np.array(list(self.waiting), np.int64)
            left = np.array([len(v) for v in self.waiting.values()])
            share = kinds / cap
            while room and segments:
                fits = (kinds[:, 0] <= room) & (kinds[:, 1] <= loss_room) & (left > 0)
                if not fits.any():
                    break
                # All pieces demand one segment, so that share is the same for each and only breaks no tie.
                value = share[:, 0] * (room / cap[0]) + share[:, 1] * (loss_room / cap[1]) + (segments / self.limits.segments) / self.limits.segments
                k = int(np.argmax(np.where(fits, value, -1.0)))
                chosen.append(self._take(tuple(kinds[k].tolist())))
                left[k] -= 1
                room, loss_room, segments = room - int(kinds[k, 0]), loss_room - int(kinds[k, 1]), segments - 1
            if room and segments and self.cut and self.waiting:
                # The smallest piece that is too long closes the gap; what is cut off waits again.
                longer = [kind for kind in self.waiting if kind[0] > room]
                if longer:
                    head, tail = self._split(self._take(min(longer)), room)
                    if self._loss(head) <= loss_room:
                        chosen.append(head)
                        self._wait(tail)
                    else:
                        self._wait((head[0], head[1], head[2] + tail[2], None if head[3] is None else np.concatenate((head[3], tail[3]))))
            self._emit(chosen)

    def close(self) -> None:
        """The rest: with cutting, sequences of 2048, 1024, ... tokens, so that they need no padding."""
        if not self.cut:
            self.fill()
            return
        self.fill(0)
        rest = [p for same in self.waiting.values() for p in same]
        rest.sort(key=lambda p: -len(p[2]))
        self.waiting, self.held = {}, 0
        while rest:
            total = sum(len(p[2]) // 4 for p in rest)
            size = min(1 << (total.bit_length() - 1), self.limits.tokens)
            chosen, room, loss_room = [], size, self.limits.loss
            while rest and room and len(chosen) < self.limits.segments:
                piece = rest.pop(0)
                if len(piece[2]) // 4 > room:
                    piece, tail = self._split(piece, room)
                    rest.insert(0, tail)
                if self._loss(piece) > loss_room:
                    rest.insert(0, piece)
                    break
                chosen.append(piece)
                room -= len(piece[2]) // 4
                loss_room -= self._loss(piece)
            self._emit(chosen)


def pack_examples(docs: DataFrame, vocabulary: str, cuts: str = "space", end_id: int | None = 2, limits: Limits = Limits(), cut: bool = True, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None, sequence_prefix: int = 0) -> DataFrame:
    """Tokenise examples and pack all of their ids into sequences within limits.

    docs: one example a row; prompt_col, if given, holds text before text_col's whose tokens bear no loss. Returns per
    piece: doc_id, start, length, ids (binary, little-endian unsigned 32-bit), ids_crc32, doc_tokens, sequence_id,
    offset, loss_tokens. Null texts count as empty, null ids stay null, repeated rows are packed each on their own;
    an example without any token gives no piece; an empty table gives no rows; extra columns are not read. A task
    retried after a loss packs its partition the same way again, since order and heuristic have no chance in them.
    """
    small_batches(docs.sparkSession)
    columns = [F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")]
    if prompt_col:
        columns.append(F.coalesce(F.col(prompt_col), F.lit("")).alias("prompt"))
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def pack(frames):
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
        packer = Packer(limits, cut, (sequence_prefix << 56) | (task_number() << 33))

        def batch():
            rows = packer.out
            packer.out = []
            columns = [
                [r[0][0] for r in rows], [r[1] for r in rows], [len(r[2]) // 4 for r in rows], [r[2] for r in rows],
                [zlib.crc32(r[2]) for r in rows], [r[0][1] for r in rows], [r[3] for r in rows], [r[4] for r in rows],
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for frame in frames:
            doc_ids, texts = frame.column("doc_id").to_pylist(), frame.column("text").to_pylist()
            prompts = frame.column("prompt").to_pylist() if prompt_col else None
            for lo, hi in batches(texts, 4_000_000):
                coder = encoder(vocabulary, cuts)
                tokens = coder.encode(texts[lo:hi])
                before = coder.encode(prompts[lo:hi]) if prompts else [b""] * (hi - lo)
                for doc_id, head, ids in zip(doc_ids[lo:hi], before, tokens):
                    whole = head + ids + end
                    if not whole:
                        continue
                    flags = None
                    if prompts:
                        flags = np.ones(len(whole) // 4, bool)
                        flags[: len(head) // 4] = False
                    packer.add(((doc_id, len(whole) // 4), 0, whole, flags))
                if packer.out:
                    yield batch()
        packer.close()
        if packer.out:
            yield batch()

    return docs.select(*columns).mapInArrow(pack, "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
