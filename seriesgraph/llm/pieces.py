"""SentencePiece encoding and decoding, with a max-plus parallel scan for giant documents.

Ordinary documents are encoded by the library, each distinct word once per worker. A giant document is split into
chunks at any character. A boundary's state is the token that holds the character before it; a chunk's transfer matrix
has, for a state at its left and one at its right boundary, the number of tokens that start in between, or minus
infinity where no valid path joins them. Matrices are combined associatively (max over paths, plus along them), the
states of all boundaries follow from the combined ones, and each chunk then traces its own tokens back.

Which paths are valid is the merge rule of the model: a row of tokens is what merging gives exactly if every token is
what merging gives for its own text and every two neighbours are for theirs. So ids equal the library's.
"""

from __future__ import annotations

import functools
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import check_free, single_threaded, small_batches, written
from .textbytes import batches

#: Longer documents are scanned in chunks.
GIANT_CHARS = 65_536
CHUNK_CHARS = 4_096
#: Neighbouring matrices that one task multiplies.
BLOCK = 64
#: Chunks that one task scans.
TASK_CHUNKS = 16
KEPT_WORDS = 500_000
KEPT_PAIRS = 1_000_000
SPACE = "▁"
#: The state before the first token.
START = 0

_MADE: dict[str, "Pieces"] = {}


class Pieces:
    """A model file: the library's processor, and its merge rule on short strings."""

    def __init__(self, path: str):
        single_threaded()
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        own = [i for i in range(n) if not (self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_unused(i))]
        self.ids = {self.library.id_to_piece(i): i for i in own}
        self.rank = {self.library.id_to_piece(i): -self.library.get_score(i) for i in own}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, self.ids))
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces of this model reach over words")
        self.kept: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.stable: dict[str, bool] = {}

    def merge(self, text: str) -> list[str]:
        """Merging from single characters: the best-ranked neighbours first, of equals the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, np.inf) for a, b in zip(parts, parts[1:])]
            best = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[best] == np.inf:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def is_token(self, text: str) -> bool:
        """A piece that merging gives for its own text, or a character without a piece."""
        if text not in self.stable:
            if len(self.stable) > KEPT_PAIRS:
                self.stable.clear()
            self.stable[text] = len(text) == 1 or (text in self.ids and self.merge(text) == [text])
        return self.stable[text]

    def may_follow(self, a: str, b: str) -> bool:
        if a == "":
            return True
        key = (a, b)
        if key not in self.pairs:
            if len(self.pairs) > KEPT_PAIRS:
                self.pairs.clear()
            self.pairs[key] = self.merge(a + b) == [a, b]
        return self.pairs[key]

    def token_ids(self, token: str) -> list[int]:
        return [self.ids[token]] if token in self.ids else [self.bytes[b] for b in token.encode("utf-8", "surrogatepass")]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, as the library has them."""
        cut = [None if "  " in t or t[:1] == " " or SPACE in t else t.split(" ") for t in texts]
        if len(self.kept) > KEPT_WORDS:
            self.kept = {}
        fresh = [w for w in set().union(*(c for c in cut if c)) if w not in self.kept]
        for word, ids in zip(fresh, self.library.encode(fresh, num_threads=1)):
            self.kept[word] = array("I", ids).tobytes()
        # A blank at the end is a word of its own, unlike an empty text.
        self.kept[""] = array("I", [self.ids[SPACE]]).tobytes()
        whole = lambda t: array("I", self.library.encode(t)).tobytes()
        return [(b"" if not t else whole(t) if c is None else b"".join(map(self.kept.__getitem__, c))) for t, c in zip(texts, cut)]

    def decode(self, ids: bytes) -> str:
        return self.library.decode(np.frombuffer(ids, "<u4").tolist())


def pieces(path: str) -> Pieces:
    if path not in _MADE:
        _MADE[path] = Pieces(path)
    return _MADE[path]


def code(before: int, after: int) -> int:
    """A state: the token that starts before characters left of the boundary and ends after characters right of it."""
    return before * 256 + after


def tokens_ending(model: Pieces, text: str, end: int, low: int):
    for start in range(end - 1, max(low, end - model.longest) - 1, -1):
        if model.is_token(text[start:end]):
            yield start


def sweep(model: Pieces, text: str, begin: int, end: int, entries: dict[int, int]) -> dict[int, dict[str, dict[int, int]]]:
    """position -> last token -> entry -> tokens that started in the chunk, for all valid paths.

    text: the chunk with its context; begin, end: the chunk in it; entries: state -> position where its token ends.
    """
    at: dict[int, dict[str, dict[int, int]]] = {}
    for state, position in entries.items():
        last = "" if state == START else text[begin - state // 256 : position]
        at.setdefault(position, {}).setdefault(last, {})[state] = 0
    low = min(at)
    for stop in range(low + 1, min(len(text), end + model.longest) + 1):
        for start in tokens_ending(model, text, stop, max(low, begin)):
            if start >= end or start not in at:
                continue
            token = text[start:stop]
            for last, counts in at[start].items():
                if model.may_follow(last, token):
                    here = at.setdefault(stop, {}).setdefault(token, {})
                    for state, n in counts.items():
                        here[state] = max(here.get(state, 0), n + 1)
    return at


def boundary_states(model: Pieces, text: str, at: int) -> dict[int, int]:
    """The states that a boundary can have: state -> position where the token ends."""
    out = {}
    for start in range(max(0, at - model.longest), at):
        for stop in range(at, min(len(text), start + model.longest) + 1):
            if model.is_token(text[start:stop]):
                out[code(at - start, stop - at)] = stop
    return out


def transfer(model: Pieces, text: str, begin: int, end: int, first: bool, last: bool) -> np.ndarray:
    """The finite entries of a chunk's max-plus matrix: rows (left state, right state, tokens)."""
    entries = {START: begin} if first else boundary_states(model, text, begin)
    at = sweep(model, text, begin, end, entries)
    out = []
    for stop, by_token in at.items():
        if stop < end or (last and stop != end):
            continue
        for token, counts in by_token.items():
            if end - (stop - len(token)) > 0:
                out += [(state, code(end - (stop - len(token)), stop - end), n) for state, n in counts.items()]
    return np.array(out, np.int64).reshape(-1, 3)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two matrices: over common middle states, sums; of several ways the largest."""
    a, b = a[np.argsort(a[:, 1], kind="stable")], b[np.argsort(b[:, 0], kind="stable")]
    lo, hi = np.searchsorted(b[:, 0], a[:, 1]), np.searchsorted(b[:, 0], a[:, 1], side="right")
    n = hi - lo
    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
    left = np.repeat(np.arange(len(a)), n)
    rows = np.column_stack((a[left, 0], b[at, 1], a[left, 2] + b[at, 2]))
    rows = rows[np.lexsort((-rows[:, 2], rows[:, 1], rows[:, 0]))]
    return rows[np.concatenate(([True], (np.diff(rows[:, :2], axis=0) != 0).any(axis=1)))[: len(rows)]]


def choose(matrices: list[np.ndarray], start: int, stop: int | None) -> list[tuple[int, int]]:
    """(left, right) state of each matrix on the best path from start to stop (to any last state if None)."""
    ahead: list[dict[int, int]] = [{}] * (len(matrices) + 1)
    ahead[-1] = {int(s): 0 for s in set(matrices[-1][:, 1])} if stop is None else {stop: 0}
    for k in range(len(matrices) - 1, -1, -1):
        best: dict[int, int] = {}
        for a, b, n in matrices[k].tolist():
            if b in ahead[k + 1]:
                best[a] = max(best.get(a, 0), n + ahead[k + 1][b])
        ahead[k] = best
    out, now = [], start
    for k, matrix in enumerate(matrices):
        follow = max((n + ahead[k + 1][b], -b) for a, b, n in matrix.tolist() if a == now and b in ahead[k + 1])
        out.append((now, -follow[1]))
        now = -follow[1]
    return out


def trace(model: Pieces, text: str, begin: int, end: int, left: int, right: int) -> list[str]:
    """The tokens that start in a chunk, given the states at its boundaries."""
    entry = begin + (0 if left == START else left % 256)
    at = sweep(model, text, begin, end, {left: entry})
    stop = end + right % 256
    token = text[end - right // 256 : stop]
    out: list[str] = []
    while True:
        start = stop - len(token)
        if start < begin or stop <= entry:
            break
        out.append(token)
        if start == entry:
            break
        want = at[stop][token][left] - 1
        token = next(t for t, counts in at[start].items() if counts.get(left) == want and model.may_follow(t, token))
        stop = start
    return out[::-1]


def _read(matrix: bytes) -> np.ndarray:
    return np.frombuffer(matrix, np.int64).reshape(-1, 3)


def _states(each: DataFrame, last: int) -> DataFrame:
    """uid, k, left, right: the states at both ends of every link of a chain, given the links' matrices (uid, k, matrix).

    Up a tree: runs of BLOCK links are multiplied into one, until a chain is one run; then down it: the states at a
    run's ends decide those within. last: the greatest k. A task holds one run.
    """
    import pandas as pd

    out = "uid long, k int, left int, right int"

    def chosen(pdf, start, stop):
        states = choose([_read(m) for m in pdf["matrix"]], start, stop)
        return pd.DataFrame({"uid": pdf["uid"], "k": pdf["k"], "left": [s for s, _ in states], "right": [s for _, s in states]})

    if last < BLOCK:
        return each.groupBy("uid").applyInPandas(lambda pdf: chosen(pdf.sort_values("k"), START, None), out)

    def product(pdf):
        pdf = pdf.sort_values("k")
        return pd.DataFrame({"uid": pdf["uid"].iloc[:1], "k": pdf["run"].iloc[:1], "matrix": [functools.reduce(combine, map(_read, pdf["matrix"])).tobytes()]})

    runs = each.withColumn("run", (F.col("k") / BLOCK).cast("int"))
    ends = _states(written(runs.groupBy("uid", "run").applyInPandas(product, "uid long, k int, matrix binary"), "runs"), last // BLOCK)
    ends = ends.select("uid", F.col("k").alias("run"), F.col("left").alias("s_in"), F.col("right").alias("s_out"))
    within = runs.join(ends, ["uid", "run"]).groupBy("uid", "run")
    return within.applyInPandas(lambda pdf: chosen(pdf.sort_values("k"), int(pdf["s_in"].iloc[0]), int(pdf["s_out"].iloc[0])), out)


def _giants(docs: DataFrame, path: str, chunk: int, longest: int) -> DataFrame:
    """uid, ids of prepared giant texts (uid, text)."""
    wide = docs.select("uid", F.length("text").alias("n"), "text").withColumn("count", F.ceil(F.col("n") / chunk).cast("int"))
    k = wide.select("*", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("k"))
    low = F.greatest(F.col("k") * chunk - longest, F.lit(0))
    text = F.substring("text", low + 1, F.lit(chunk + 2 * longest))
    total, most = wide.agg(F.sum("count"), F.max("count")).first()
    # The chunks are small, but dear to scan: their number decides that of tasks.
    tasks = max(1, -(-(total or 0) // TASK_CHUNKS))
    chunks = written(k.select("uid", "k", (F.col("k") * chunk - low).alias("begin"), F.least(F.col("n"), (F.col("k") + 1) * chunk).cast("int").alias("end"), low.alias("low"), (F.col("k") == F.col("count") - 1).alias("last"), text.alias("text")).repartition(tasks, "uid", "k"), "chunks")

    def matrices(frames):
        import pyarrow as pa

        model = pieces(path)
        for f in frames:
            rows = f.to_pylist()
            data = [transfer(model, r["text"][: r["end"] - r["low"] + (0 if r["last"] else longest)], r["begin"], r["end"] - r["low"], r["k"] == 0, r["last"]).tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays([f.column("uid"), f.column("k"), pa.array(data, pa.binary())], names=["uid", "k", "matrix"])

    each = written(chunks.repartition(tasks, "uid", "k").mapInArrow(matrices, "uid long, k int, matrix binary"), "matrices")
    states = _states(each, (most or 1) - 1)

    def back(frames):
        import pyarrow as pa

        model = pieces(path)
        for f in frames:
            ids = [array("I", [i for t in trace(model, r["text"][: r["end"] - r["low"] + (0 if r["last"] else longest)], r["begin"], r["end"] - r["low"], r["left"], r["right"]) for i in model.token_ids(t)]).tobytes() for r in f.to_pylist()]
            yield pa.RecordBatch.from_arrays([f.column("uid"), f.column("k"), pa.array(ids, pa.binary())], names=["uid", "k", "ids"])

    def whole(pdf):
        import pandas as pd

        return pd.DataFrame({"uid": pdf["uid"].iloc[:1], "ids": [b"".join(pdf.sort_values("k")["ids"])]})

    traced = chunks.join(states, ["uid", "k"]).repartition(tasks, "uid", "k").mapInArrow(back, "uid long, k int, ids binary")
    return traced.groupBy("uid").applyInPandas(whole, "uid long, ids binary")


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", giant: int = GIANT_CHARS, chunk: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) of every row, equal to the library's.

    Null and empty texts have no ids; null and repeated document ids stay as they are; an empty table gives no rows;
    extra columns are not read. chunk must exceed the longest piece.
    """
    small_batches(docs.sparkSession)
    longest = pieces(path).longest
    if chunk <= longest:
        raise ValueError(f"chunks need more than {longest} characters")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def plain(frames):
        import pyarrow as pa

        for f in frames:
            ids, texts = f.column("doc_id"), f.column("text").to_pylist()
            for lo, hi in batches(texts):
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(pieces(path).encode(texts[lo:hi]), pa.binary())], names=["doc_id", "ids"])

    small = rows.where(F.length("text") <= giant).mapInArrow(plain, "doc_id long, ids binary")
    large = written(rows.where(F.length("text") > giant).withColumn("uid", F.monotonically_increasing_id()), "giants")
    prepared = large.select("uid", F.concat(F.lit(SPACE), F.replace("text", F.lit(" "), F.lit(SPACE))).alias("text"))
    found = _giants(prepared, path, chunk, longest)
    return small.unionByName(large.select("doc_id", "uid").join(found, "uid").select("doc_id", "ids"))


def decode_pieces(encoded: DataFrame, path: str, name: str = "text") -> DataFrame:
    """encoded with the text of its ids, under name, which no column of encoded may have.

    Null ids have a null text, no ids an empty one; repeated rows stay and an empty table gives none. Other columns pass
    through.
    """
    check_free((name,), encoded.columns)

    def run(frames):
        import pyarrow as pa

        for f in frames:
            texts = [None if x is None else pieces(path).decode(x) for x in f.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*f.columns, pa.array(texts, pa.string())], names=[*f.schema.names, name])

    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    return encoded.mapInArrow(run, ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in encoded.schema) + f", {quoted(name)} string")


def piece_digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, text_sha256 of the text decoded from the ids, for every document.

    Null and empty texts have no ids, null and repeated ids keep their rows, an empty table gives none, and other
    columns are not read.
    """
    decoded = decode_pieces(encode_pieces(docs, path), path)
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").cast("long").alias("ids_crc32"), F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))
