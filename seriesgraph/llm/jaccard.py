"""N-gram Jaccard join with a token-group matrix.

Documents are sets of word shingles; equal sets are one class. Classes are partitioned into groups of similar ones:
in a few rounds, the classes that agree on a minimum hash are held against one leader, the one whose minima most others
share, and those proven similar to it form a group with it. Each class is brought before one leader a round, so the
rounds are linear whatever the size of a group of near copies, and no pair within a group need be looked at again.

The matrix has, per token, the groups that have it. It need hold no more of a set than its rarest tokens: with n tokens
and a threshold t, two similar sets share at least one of the first n - ceil(t n) + 1 tokens of either in any common
order, and so many of them that most groups which merely share a passage stay closed. The order puts frequent tokens
last. A token in many sets pairs groups only where one has it in the still shorter prefix that suffices on the smaller
side, and its list is met tile by tile. There every group comes with a signature of its matrix tokens, which bounds how
many of them two groups share, so that only pairs that share enough leave the tile.

Of the groups that the matrix pairs, the token unions are stored, in chunks of members. A query's overlap with a chunk's
union bounds its overlap with any member: chunks whose bound is too low stay closed to it, and only the others are
opened and compared exactly. Where pairs are many, each group first asks the group it has most in common with; pairs
that are of one component by then are not opened at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, whole_if_small, written
from .components import components
from .textbytes import batches, mix, sets

#: The similarity is PERCENT / 100 or more.
PERCENT = 75
WIDTH = 5
MINIMA = 8
#: Rounds in which classes that no leader took yet are brought before another one.
ROUNDS = 3
#: Classes of a group whose union is stored together and which are opened together: so many, and shingles in all.
CHUNK = 64
CHUNK_TOKENS = 1 << 19
#: Classes that one task holds against a leader or a chunk.
ASKERS = 512
#: Tokens in more sets than this come last in the order of tokens; at most so many of them (the most frequent), which
#: bounds the list that tasks get at 12 MB. Both change what is compared, never the result.
FREQUENT = 32
FREQUENT_MOST = 1 << 20
#: Tokens that one task counts or meets at once, and that a task holds before it sends them.
BUCKET_TOKENS = 1 << 19
SENT_TOKENS = 1 << 19
#: Tokens in more sets than this are met in tiles of their lists, so many groups a side; and pairs that a task holds.
LONG = 32
TILE = 1024
PAIRS = 500_000
#: Unseen tokens of a group in one row.
UNSEEN = 4096
#: Matrix tokens of a group's classes up to which it has a signature, and the bits of a hash in it.
SIGNED = 2048
SIGN_BITS = 13

#: Rows of a table that goes whole to every task; and of the table of signatures.
WHOLE = 1 << 18
SIGNATURES = 1 << 15

_FACTORS = (mix(np.arange(1, MINIMA + 1, dtype=np.uint64)) | np.uint64(1))[:, None]
_TERMS = mix(np.arange(101, MINIMA + 101, dtype=np.uint64))[:, None]


def _whole(df: DataFrame) -> DataFrame:
    return whole_if_small(df, WHOLE)


def pack(h: np.ndarray) -> bytes:
    """A sorted set in bytes that compress: its upper 16 bits as differences, in two planes, then the lower 48 as they are."""
    steps = np.diff((h >> np.uint64(48)).astype(np.uint16), prepend=np.uint16(0))
    low = h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return (steps >> 8).astype(np.uint8).tobytes() + (steps & 0xFF).astype(np.uint8).tobytes() + low.tobytes()


def unpack(data: bytes) -> np.ndarray:
    n = len(data) // 8
    raw = np.frombuffer(data, np.uint8)
    upper = np.cumsum(raw[:n].astype(np.uint16) << np.uint16(8) | raw[n : 2 * n], dtype=np.uint16)
    out = np.empty((n, 8), np.uint8)
    out[:, :6] = raw[2 * n :].reshape(n, 6)
    out[:, 6:] = upper.astype("<u2").view(np.uint8).reshape(n, 2)
    return out.reshape(-1).view("<u8")


def pack_entries(t: np.ndarray, g: np.ndarray, z: np.ndarray) -> bytes:
    """Ascending tokens with their groups and sizes, byte by byte, compressed: tokens as differences, of the sizes the lower and the distance."""
    steps = np.diff(t, prepend=np.uint64(0)).astype("<u8")
    size = (z >> np.uint32(16)) | ((z & np.uint32(0xFFFF)) - (z >> np.uint32(16)) << np.uint32(16))
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(t), -1).T).tobytes() for x in (steps, g.astype("<i8"), size.astype("<u4"))]
    return len(t).to_bytes(4, "little") + pa.Codec("zstd").compress(b"".join(planes), asbytes=True)


def unpack_entries(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    raw = np.frombuffer(pa.Codec("zstd").decompress(data[4:], 20 * n, asbytes=True), np.uint8)
    steps, g, size = (np.ascontiguousarray(raw[a * n : b * n].reshape(b - a, n).T).reshape(-1).view(kind) for a, b, kind in ((0, 8, "<u8"), (8, 16, "<i8"), (16, 20, "<u4")))
    low = size & np.uint32(0xFFFF)
    return np.cumsum(steps, dtype=np.uint64), g, low << np.uint32(16) | low + (size >> np.uint32(16))


def sign(tokens: np.ndarray) -> tuple[bytes, int]:
    """A signature of distinct tokens: the steps of their short hashes, a byte or more each; and how many hashes coincide."""
    h = np.unique(mix(tokens) >> np.uint64(64 - SIGN_BITS)).astype(np.int64)
    steps = np.diff(h, prepend=0)
    ends = np.cumsum(steps // 255 + 1) - 1
    out = np.full(ends[-1] + 1 if len(h) else 0, 255, np.uint8)
    out[ends] = steps % 255
    return out.tobytes(), len(tokens) - len(h)


def signed(data: bytes) -> np.ndarray:
    """The short hashes of a signature."""
    raw = np.frombuffer(data, np.uint8)
    return np.cumsum(raw, dtype=np.int64)[raw != 255]


def shared_hashes(x: list[bytes | None], y: list[bytes | None]) -> np.ndarray:
    """How many short hashes each signature of x shares with each of y; 0 where there is none."""
    of = lambda some: [signed(d) if d is not None else np.zeros(0, np.int64) for d in some]
    x, y = of(x), of(y)
    names = np.intersect1d(np.concatenate(x), np.concatenate(y))

    def rows(some):
        out = np.zeros((len(some), len(names)), np.float32)
        for k, h in enumerate(some):
            out[k, np.searchsorted(names, np.intersect1d(h, names, assume_unique=True))] = 1
        return out

    return np.rint(rows(x) @ rows(y).T).astype(np.int64)


def set_key(h: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int((mix(mix(h).sum(dtype=np.uint64, keepdims=True)) + np.uint64(len(h))).view(np.int64)[0])


def minima(h: np.ndarray) -> np.ndarray:
    return ((h * _FACTORS + _TERMS) >> np.uint64(1)).min(axis=1).astype(np.int64)


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted distinct arrays reach the similarity."""
    small, large = sorted((len(x), len(y)))
    if 100 * small < PERCENT * large:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def document_sets(docs: DataFrame) -> DataFrame:
    """row, doc_id, key, n, minima, data of each document; key and minima null without words. Written.

    data is the set itself, hashed once for all later steps; of equal sets a task writes one (null for the others).
    """

    def run(frames):
        seen: set[int] = set()
        for frame in frames:
            texts = frame.column("text").to_pylist()
            for lo, hi in batches(texts):
                found = sets(texts[lo:hi], WIDTH)
                keys = [set_key(h) if len(h) else None for h in found]
                low = [minima(h).tolist() if len(h) else None for h in found]
                data = []
                for key, h in zip(keys, found):
                    data.append(None if key is None or key in seen else pack(h))
                    seen.add(key)
                if len(seen) > 1_000_000:
                    seen.clear()
                yield pa.RecordBatch.from_arrays([frame.column("doc_id").slice(lo, hi - lo), pa.array(keys, pa.int64()), pa.array([len(h) for h in found], pa.int64()), pa.array(low, pa.list_(pa.int64())), pa.array(data, pa.binary())], names=["doc_id", "key", "n", "minima", "data"])

    rows = docs.mapInArrow(run, "doc_id long, key long, n long, minima array<long>, data binary")
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "sets", "zstd")


def _classes(own: DataFrame) -> DataFrame:
    """key, rep (the least doc_id), row (the one whose data stands for the class), n, minima. Written."""
    named = own.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("rep"), F.min(F.when(F.col("data").isNotNull(), F.col("row"))).alias("row"))
    named = written(named, "named")
    return written(own.where("data is not null").select("row", "n", "minima").join(_whole(named), "row"), "classes")


class Leader:
    """Links of classes to the leader they are brought before."""

    schema = "a long, b long"

    def __init__(self):
        self.key, self.set = None, None

    def hold(self, key: int, h: np.ndarray) -> None:
        self.key, self.set = key, h

    def ask(self, key: int, h: np.ndarray, gid: str):
        if self.set is not None and similar(h, self.set):
            yield key, self.key

    def close(self, gid: str):
        return ()


class Union:
    """The union of a chunk's sets."""

    schema = "gid string, data binary"

    def __init__(self):
        self.sets: list[np.ndarray] = []

    def hold(self, key: int, h: np.ndarray) -> None:
        self.sets.append(h)

    def close(self, gid: str):
        if self.sets:
            yield gid, pack(np.unique(np.concatenate(self.sets)))


class Bound:
    """The queries whose overlap with a stored union suffices for some member."""

    schema = "gid string, key long"

    def __init__(self):
        self.union = np.zeros(0, np.uint64)

    def hold(self, key: int, h: np.ndarray) -> None:
        self.union = h

    def ask(self, key: int, h: np.ndarray, gid: str):
        if 100 * _common(h, self.union) >= PERCENT * len(h):
            yield gid, key

    def close(self, gid: str):
        return ()


class Open:
    """A link of each query to one similar member of a chunk, if there is any."""

    schema = "a long, b long"

    def __init__(self):
        self.keys: list[int] = []
        self.sets: list[np.ndarray] = []
        self.tokens = None

    def hold(self, key: int, h: np.ndarray) -> None:
        self.keys.append(key)
        self.sets.append(h)

    def ask(self, key: int, h: np.ndarray, gid: str):
        if not self.sets:
            return
        if self.tokens is None:
            self.sizes = np.array([len(x) for x in self.sets])
            tokens, owner = np.concatenate(self.sets), np.repeat(np.arange(len(self.sets)), self.sizes)
            order = np.argsort(tokens)
            self.tokens, self.owner = tokens[order], owner[order]
        lo, hi = np.searchsorted(self.tokens, h), np.searchsorted(self.tokens, h, side="right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.bincount(self.owner[at], minlength=len(self.sizes))
        hits = np.flatnonzero(100 * both >= PERCENT * (len(h) + self.sizes - both))
        if len(hits):
            yield key, self.keys[hits[0]]

    def close(self, gid: str):
        return ()


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """How many of the sorted distinct x the sorted distinct y has."""
    if not len(y):
        return 0
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def _brought(own: DataFrame, places: DataFrame, judge: type, stored: DataFrame | None = None) -> DataFrame:
    """Bring the sets of classes together by gid and let a judge of each gid hold those of side 0 and ask those of 1.

    places, written: gid, side, key, row (of the class's set). stored: gid, data: sets to hold besides.
    A task keeps what one judge holds; those of side 1 stream by.
    """
    rows = own.where("data is not null").select("row", "data").join(_whole(places), "row").select("gid", "side", "key", "data")
    if stored is not None:
        rows = rows.unionByName(stored.select("gid", F.lit(0).alias("side"), F.lit(0).cast("long").alias("key"), "data"))

    def run(frames):
        def answers():
            now, of = None, None
            for frame in frames:
                for gid, side, key, data in zip(*(frame.column(c).to_pylist() for c in ("gid", "side", "key", "data"))):
                    if gid != of:
                        if now is not None:
                            yield now.close(of)
                        now, of = judge(), gid
                    h = unpack(data)
                    if side:
                        yield now.ask(key, h, of)
                    else:
                        now.hold(key, h)
            if now is not None:
                yield now.close(of)

        names, types = zip(*((f.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]]) for f in judge.schema.split(", ")))
        out = chain.from_iterable(answers())
        while some := list(islice(out, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=list(names))

    return rows.repartition("gid").sortWithinPartitions("gid", "side").mapInArrow(run, judge.schema)


def _spread(held: DataFrame | None, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """gid for held (at, ...; or the places themselves) and asked (at, key, ...): the askers of a place are dealt to as
    many copies of it as they need.
    """
    copies = written(asked.groupBy("at").agg(F.ceil(F.count(F.lit(1)) / ASKERS).cast("int").alias("copies")), "copies")
    gid = F.concat_ws(":", "at", "copy")
    few = _whole(copies)
    held = (copies if held is None else held.join(few, "at")).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).withColumn("gid", gid)
    asked = asked.join(few, "at").withColumn("copy", F.pmod(F.xxhash64("key"), F.col("copies"))).withColumn("gid", gid)
    return held, asked


def _groups(own: DataFrame, classes: DataFrame) -> DataFrame:
    """node, component: classes proven to belong together by comparing them with leaders of their minima."""
    keyed = classes.select("key", F.posexplode("minima").alias("which", "low"))
    buckets = written(keyed.groupBy("which", "low").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    # How many classes share a class's minima: what most near copies derive from has the most.
    central = keyed.join(_whole(buckets), ["which", "low"]).groupBy("key").agg(F.sum("size").alias("score"))
    waiting = written(classes.join(_whole(written(central, "central")), "key").select("key", "row", "n", "minima", "score"), "waiting")
    few = (2 * classes.count()) ** 0.5  # so few that all their pairs are as many as the classes: left to the matrix
    every = _whole(waiting)
    found: list[DataFrame] = []
    led, taken = None, []
    for _ in range(ROUNDS):
        pool = waiting if led is None else waiting.join(_whole(led), "key", "left_anti")
        pool = pool.select("key", "score", F.posexplode("minima").alias("which", "low"))
        leads = written(pool.groupBy("which", "low").agg(F.max(F.struct("score", "key")).alias("top")).select("which", "low", F.col("top.key").alias("lead")), "leads")
        open_ = waiting
        for links in taken:
            open_ = open_.join(links, "key", "left_anti")
        # A class meets each of its leaders once, with how many minima they share.
        asks = open_.select("key", "n", F.posexplode("minima").alias("which", "low")).join(_whole(leads), ["which", "low"]).where("key != lead")
        asks = asks.groupBy("key", "lead").agg(F.count(F.lit(1)).alias("met"), F.first("n").alias("n"))
        of_lead = every.select(F.col("key").alias("lead"), F.col("n").alias("lead_n"), F.col("minima").alias("lead_minima"))
        of_key = every.select("key", "minima")
        agree = F.aggregate(F.zip_with("minima", "lead_minima", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
        fits = 100 * F.least("n", "lead_n") >= PERCENT * F.greatest("n", "lead_n")
        asks = asks.join(of_lead, "lead").where(fits).join(of_key, "key").select("key", "lead", agree.alias("agree")).where(F.col("agree") * 2 >= MINIMA)
        best = written(asks.groupBy("key").agg(F.max(F.struct("agree", "lead")).alias("best")).select("key", F.col("best.lead").alias("at")), "asks")
        if best.count() <= few:
            break
        held, asked = _spread(None, best)
        held = held.withColumn("key", F.col("at"))
        rows = held.select("gid", F.lit(0).alias("side"), "key").unionByName(asked.select("gid", F.lit(1).alias("side"), "key"))
        places = written(rows.join(every.select("key", "row"), "key"), "places")
        found.append(written(_brought(own, places, Leader), "led"))
        taken.append(_whole(found[-1]).select(F.col("a").alias("key")))
        heads = held.select("key").distinct()
        led = written(heads if led is None else led.unionByName(heads), "heads")
    return components(reduce(DataFrame.unionByName, found)) if found else classes.sparkSession.createDataFrame([], "node long, component long")


def _bits(n: int) -> int:
    return max(0, (max(1, n) - 1).bit_length())


def _frequent(own: DataFrame, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """(upper halves of tokens in more than FREQUENT sets, ascending, and their counts), the most frequent ones only.

    Tasks send distinct sorted upper halves as differences, byte by byte, so that the exchange packs them to about two
    bytes, and how often those that recur were met again.
    A set that several tasks have counts in each; that moves a token in the order and changes no result.
    """
    bits = _bits(-(-tokens // BUCKET_TOKENS))

    def send(frames):
        held, size = [], 0

        def flush():
            t = np.sort(np.concatenate(held))
            at = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
            n = np.diff(np.append(at, len(t))) - 1
            t = t[at]
            cut = np.searchsorted(t, (np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32 - bits)).astype(np.float64))
            parts = [np.diff(t[a:b], prepend=np.uint32(0)).astype("<u4") for a, b in zip(cut, cut[1:])]
            again = [np.stack((t[a:b][n[a:b] > 0], n[a:b][n[a:b] > 0])).astype("<u4").tobytes() for a, b in zip(cut, cut[1:])]
            return pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([p.view(np.uint8).reshape(-1, 4).T.tobytes() for p in parts], pa.binary()), pa.array(again, pa.binary())], names=["bucket", "data", "again"])

        for frame in frames:
            for data in frame.column("data").to_pylist():
                h = unpack(data)
                held.append((h >> np.uint64(32)).astype(np.uint32))
                size += len(h)
                if size > SENT_TOKENS:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def count(table):
        t = np.concatenate([np.cumsum(np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1), dtype=np.uint32) for x in table.column("data").to_pylist()])
        t.sort()
        first = np.flatnonzero(np.diff(t, prepend=t[:1] + np.uint32(1))) if len(t) else np.zeros(0, np.int64)
        n = np.diff(np.append(first, len(t)))
        t = t[first]
        for x in table.column("again").to_pylist():
            token, more = np.frombuffer(x, "<u4").reshape(2, -1)
            n[np.searchsorted(t, token)] += more
        keep = n > FREQUENT
        return pa.table({"token": t[keep].astype(np.int64), "sets": n[keep].astype(np.int64)})

    counted = own.where("data is not null").select("data").mapInArrow(send, "bucket int, data binary, again binary").groupBy("bucket").applyInArrow(count, "token long, sets long")
    top = counted.orderBy(F.desc("sets"), "token").limit(FREQUENT_MOST).toArrow()
    token, n = top.column("token").to_numpy().astype(np.uint32), top.column("sets").to_numpy()
    order = np.argsort(token)
    return token[order], n[order]


def _leading(h: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], long: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The tokens of a set that the matrix holds: the first n - ceil(t n) + 1, rare ones first, those with long lists
    apart; and how many of the latter are in the index: among the first n - ceil(2 t / (1 + t) n) + 1 tokens.

    Of two similar sets the smaller has a common token in the index which the larger has among its leading tokens.
    """
    many = len(h) - -(-PERCENT * len(h) // 100) + 1
    index = len(h) - -(-2 * PERCENT * len(h) // (100 + PERCENT)) + 1
    token, count = frequent
    if not len(token):
        return h[:many], h[:0], 0
    upper = (h >> np.uint64(32)).astype(np.uint32)
    at = np.minimum(np.searchsorted(token, upper), len(token) - 1)
    often = token[at] == upper
    rare = h[~often]
    if len(rare) >= many:
        return rare[:many], h[:0], 0
    rest, n = h[often], count[at[often]]
    order = np.lexsort((rest, n))[: many - len(rare)]
    rest, short = rest[order], int(np.searchsorted(n[order], long, side="right"))
    return np.concatenate((rare, rest[:short])), rest[short:], max(0, index - len(rare) - short)


def _pair_blocks(first: np.ndarray, run: np.ndarray, most: int):
    """Index arrays (x, y) of the pairs within runs, about so many at once whatever the length of a run."""
    at = np.arange(int(run.sum()))
    after = np.repeat(first + run, run) - at - 1  # partners behind each entry of its run
    ends = np.cumsum(after)
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        n = after[lo:hi]
        x = np.repeat(at[lo:hi], n)
        yield x, x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        lo = hi


def _sums(blocks):
    """Pairs (a, b, count, upper) of blocks of them, equal ones joined as far as about PAIRS rows are held; Arrow batches."""
    batch = lambda out: pa.RecordBatch.from_arrays([pa.array(out[:, k]) for k in range(4)], names=["a", "b", "both", "upper"])
    parts, held = [], 0
    for block in blocks:
        parts.append(block)
        held += len(block)
        if held > PAIRS:
            parts = [_summed(parts)]
            held = len(parts[0])
            if held > PAIRS // 2:
                yield batch(parts[0])
                parts, held = [], 0
    if held:
        yield batch(_summed(parts))


def _scaled(n: np.ndarray, up: bool) -> np.ndarray:
    """Sizes by a logarithm in 16 bits, rounded so that what they rule out is ruled out by the sizes."""
    x = np.log(np.maximum(n, 1)) * SCALE
    return (np.ceil(x) if up else np.floor(x)).astype(np.uint32)


#: Steps of sizes by a factor of e, and the least difference of a larger and a smaller size that may be similar.
SCALE = 512
APART = int(np.floor(np.log(PERCENT / 100) * SCALE))


def _matrix_pairs(own: DataFrame, sized: DataFrame, tokens: int) -> tuple[DataFrame, DataFrame]:
    """(a, b, both, upper: pairs of groups with a common token in the matrix, how many are seen; group, token: unseen ones).

    sized, written: key, group, low, high of every class, the sizes those of its group. Groups whose sizes can't be
    similar are not paired.

    Tokens in at most LONG sets are met in buckets and counted in full. Those of longer lists are met in tiles of the
    list, and only where one side has the token in its index; where neither has, it is among the unseen ones of both.
    Two groups that meet in a tile and have signatures leave it only if these allow enough common tokens in all of the
    matrix: upper is that bound on them then, else 0. A pair that is refused there isn't similar, whatever both says.
    """
    spark = own.sparkSession
    frequent = spark.sparkContext.broadcast(_frequent(own, tokens))  # at most FREQUENT_MOST entries of 12 bytes
    longest, tile, most = LONG, TILE, PAIRS

    def lead(frames):
        for frame in frames:
            data, more, index = [], [], []
            for x in frame.column("data").to_pylist():
                short, long, n = _leading(unpack(x), frequent.value, longest)
                data.append(pack(np.sort(short)))
                more.append(long.view(np.int64).tolist())
                index.append(n)
            yield pa.RecordBatch.from_arrays([frame.column("key"), pa.array(data, pa.binary()), pa.array(more, pa.list_(pa.int64())), pa.array(index, pa.int32())], names=["key", "data", "more", "index"])

    bits = _bits(-(-tokens // BUCKET_TOKENS))

    def send(frames):
        held: list = []
        size = 0

        def flush():
            t = np.concatenate([unpack(d) for _, d, _, _ in held])
            long = [len(d) // 8 for _, d, _, _ in held]
            g = np.repeat(np.array([g for g, *_ in held], np.int64), long)
            z = np.repeat(_scaled(np.array([x[2] for x in held]), False) << np.uint32(16) | _scaled(np.array([x[3] for x in held]), True), long)
            order = np.argsort(t)
            t, g, z = t[order], g[order], z[order]
            cut = np.searchsorted(t >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)) if bits else np.array([0, len(t)])
            rows = [(k, pack_entries(t[a:b], g[a:b], z[a:b])) for k, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "entries"])

        for frame in frames:
            for pair in zip(*(frame.column(c).to_pylist() for c in ("group", "data", "low", "high"))):
                held.append(pair)
                size += len(pair[1]) // 8
                if size > SENT_TOKENS:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, g, z = (np.concatenate(c) for c in zip(*(unpack_entries(x) for b in batches for x in b.column("entries").to_pylist())))
        # Most tokens are one set's own: they go before the expensive sort by token and group.
        order = np.argsort(t)
        t, g, z = t[order], g[order], z[order]
        same = np.concatenate(([False], t[1:] == t[:-1], [False]))
        keep = same[1:] | same[:-1]
        t, g, z = t[keep], g[keep], z[keep]
        del same, keep
        order = np.lexsort((g, t))
        t, g, z = t[order], g[order], z[order]
        new = np.concatenate(([True], (t[1:] != t[:-1]) | (g[1:] != g[:-1])))[: len(t)]
        t, g, z = t[new], g[new], z[new]
        low, high = (z >> np.uint32(16)).astype(np.int64), (z & np.uint32(0xFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1]))[: len(t)])
        run = np.diff(np.append(first, len(t)))

        def blocks():
            for x, y in _pair_blocks(first, run, most):
                fits = (high[x] - low[y] >= APART) & (high[y] - low[x] >= APART)
                x, y = x[fits], y[fits]
                yield np.column_stack((g[x], g[y], np.ones(len(x), np.int64), np.zeros(len(x), np.int64)))

        yield from _sums(blocks())

    def meet_long(frames):
        def met(rows):
            *columns, signs = zip(*rows)
            group, low, high, index, side, lost = (np.array(c) for c in columns)
            told = np.array([s is not None for s in signs])
            x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            step = max(1, most // max(1, len(y)))
            for lo in range(0, len(x) if len(y) else 0, step):
                i, j = x[lo : lo + step, None], y[None, :]
                # Where both have it in the index, the pair is met twice and counts once.
                keep = (group[i] != group[j]) & (~index[j] | (group[i] < group[j]))
                keep &= (100 * high[i] >= PERCENT * low[j]) & (100 * high[j] >= PERCENT * low[i])
                known, upper = told[i] & told[j], np.zeros(keep.shape, np.int64)
                if (known & keep).any():
                    upper = shared_hashes([signs[k] for k in x[lo : lo + step]], [signs[k] for k in y]) + np.minimum(lost[i], lost[j])
                    bound = np.minimum(least_common(high[i], low[j]), least_common(high[j], low[i]))
                    keep &= ~known | (upper > bound)
                p, q = np.nonzero(keep)
                a, b, known = group[x[lo + p]], group[y[q]], known[p, q]
                yield np.column_stack((np.minimum(a, b), np.maximum(a, b), ~known, np.where(known, upper[p, q], 0)))

        def tiles():
            held, of = [], None
            for frame in frames:
                for token, i, j, *row in zip(*(frame.column(c).to_pylist() for c in ("token", "i", "j", "group", "low", "high", "index", "side", "lost", "signs"))):
                    if (token, i, j) != of:
                        if held:
                            yield from met(held)
                        held, of = [], (token, i, j)
                    held.append(row)
            if held:
                yield from met(held)

        yield from _sums(tiles())

    led = own.where("data is not null").select("key", "data").mapInArrow(lead, "key long, data binary, more array<long>, index int").join(_whole(sized), "key")
    # Written, also so that no task has two Python workers at once.
    led = written(led.select("group", "low", "high", "data", "more", "index"), "leading", "zstd")
    found = led.select("group", "data", "low", "high").mapInArrow(send, "bucket int, entries binary").groupBy("bucket").applyInArrow(meet, "a long, b long, both long, upper long")
    entries = led.where(F.size("more") > 0).select("group", "low", "high", "index", F.posexplode("more").alias("pos", "token"))
    entries = written(entries.groupBy("token", "group").agg(F.max(F.col("pos") < F.col("index")).alias("index"), F.first("low").alias("low"), F.first("high").alias("high")), "entries")
    # How many tiles a list has either way; the lists that are in no index make no pairs.
    cuts = entries.groupBy("token").agg(F.ceil(F.count_if("index") / tile).cast("int").alias("is"), F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("js")).where("is > 0")
    placed = entries.join(_whole(written(cuts, "cuts")), "token")
    placed = placed.join(whole_if_small(written(_signatures(led), "signatures"), SIGNATURES), "group", "left").fillna(0, "lost")
    own_cut = lambda n: F.pmod(F.xxhash64("group"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    row = ["token", "group", "low", "high", "index", "lost", "signs"]
    left = placed.where("index").select(*row, F.lit(0).alias("side"), own_cut("is").alias("i"), every("js").alias("j"))
    right = placed.select(*row, F.lit(1).alias("side"), every("is").alias("i"), own_cut("js").alias("j"))
    tiled = left.unionByName(right).repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    found = found.unionByName(tiled.mapInArrow(meet_long, "a long, b long, both long, upper long"))
    return found.groupBy("a", "b").agg(F.sum("both").alias("both"), F.max("upper").alias("upper")), entries.where("not index").select("group", "token")


def _signatures(led: DataFrame) -> DataFrame:
    """group, signs, lost of the groups with a token of a long list, the signature that of all tokens of their classes.

    Groups whose classes have more than SIGNED tokens in the matrix have none.
    """
    total = F.sum(F.length("data") / 8 + F.size("more"))
    few = led.groupBy("group").agg(total.alias("total"), F.max(F.size("more")).alias("long")).where((F.col("long") > 0) & (F.col("total") <= SIGNED))
    some = led.join(_whole(written(few.select("group"), "few")), "group").groupBy("group").agg(F.collect_list("data").alias("data"), F.flatten(F.collect_list("more")).alias("more"))

    def run(frames):
        for frame in frames:
            found = []
            for data, more in zip(frame.column("data").to_pylist(), frame.column("more").to_pylist()):
                found.append(sign(np.unique(np.concatenate([*map(unpack, data), np.array(more, np.int64).view(np.uint64)]))))
            yield pa.RecordBatch.from_arrays([frame.column("group"), pa.array([s for s, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int32())], names=["group", "signs", "lost"])

    return some.mapInArrow(run, "group long, signs binary, lost int")


def _summed(parts: list[np.ndarray]) -> np.ndarray:
    """Rows (a, b, count, upper) with equal a and b: counts added up, the largest upper."""
    pairs = np.concatenate(parts)
    if not len(pairs):
        return pairs
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    new = (pairs[1:, 0] != pairs[:-1, 0]) | (pairs[1:, 1] != pairs[:-1, 1])
    begin = np.flatnonzero(np.concatenate(([True], new)))
    return np.column_stack((pairs[begin, :2], np.add.reduceat(pairs[:, 2], begin), np.maximum.reduceat(pairs[:, 3], begin)))


def _least_common(large: Column, small: Column) -> Column:
    """How many matrix tokens two similar sets share at least, one of size large at most, one of size small at least.

    Their overlap is at least t / (1 + t) times the sum of sizes, and all but the common matrix tokens lie behind the
    leading tokens of one of them, where ceil(t n) - 1 of its n are left. A little slack covers rounding.
    """
    t = PERCENT / 100
    partner = F.greatest(small, large * t)
    return F.floor((large + partner) * (t / (1 + t)) - F.greatest(large, partner) * t - 1e-6)


def least_common(large: np.ndarray, small: np.ndarray) -> np.ndarray:
    """_least_common of arrays."""
    t = PERCENT / 100
    partner = np.maximum(small, large * t)
    return np.floor((large + partner) * (t / (1 + t)) - np.maximum(large, partner) * t - 1e-6).astype(np.int64)


def _links_between(own: DataFrame, classes: DataFrame, groups: DataFrame, tokens: int) -> DataFrame:
    """Links between classes of different groups: bound by the matrix, then by unions, then exactly."""
    member = written(classes.join(_whole(groups), F.col("key") == F.col("node"), "left").select("key", "row", "n", F.coalesce("component", "key").alias("group")), "members")
    # In the matrix a group has the least row of its classes as its number: it packs better than a hash.
    sizes = written(member.groupBy("group").agg(F.min("row").alias("number"), F.min("n").alias("low"), F.max("n").alias("high"), F.count(F.lit(1)).alias("count"), F.ceil(F.greatest(F.count(F.lit(1)) / CHUNK, F.sum("n") / CHUNK_TOKENS)).cast("int").alias("chunks")), "sizes")
    sized = written(member.join(_whole(sizes), "group").select("key", F.col("number").alias("group"), "low", "high"), "sized")
    pairs, unseen = _matrix_pairs(own, sized, tokens)
    pairs = written(pairs, "matrix")
    most = written(unseen.groupBy("group").agg(F.count(F.lit(1)).cast("int").alias("most")), "most")
    numbered = sizes.withColumnRenamed("group", "name").withColumnRenamed("number", "group")
    known = _whole(written(numbered.join(_whole(most), "group", "left").fillna(0, "most"), "known"))
    of = lambda side: known.select(*[F.col(c).alias(f"{side}_{c}" if c != "group" else side) for c in known.columns])
    pairs = pairs.join(of("a"), "a").join(of("b"), "b")
    reach = (100 * F.col("a_high") >= PERCENT * F.col("b_low")) & (100 * F.col("b_high") >= PERCENT * F.col("a_low"))
    bound = F.least(_least_common(F.col("a_high"), F.col("b_low")), _least_common(F.col("b_high"), F.col("a_low")))
    lack = bound - F.col("both")
    short = pairs.where(reach & (F.col("upper") == 0) & (lack >= 0) & (F.least("a_most", "b_most") > lack)).withColumn("lack", lack)
    short = _with_unseen(short, unseen, most)
    # The group with fewer classes asks, the other is asked.
    ask = F.col("a_count") <= F.col("b_count")
    side = lambda first, second: F.when(ask, F.col(first)).otherwise(F.col(second))
    chosen = [side("a_name", "b_name").alias("query"), side("b_name", "a_name").alias("group"), F.greatest("both", "upper").alias("both")]
    kept = written(pairs.where(reach & ((F.col("upper") > 0) | (F.col("both") > bound))).select(*chosen).unionByName(short.select(*chosen)), "candidates")
    if kept.count() <= member.count():
        return _opened(own, member, sizes, kept.select("query", "group"))
    best = written(kept.groupBy("query").agg(F.max(F.struct("both", "group")).alias("best")).select("query", F.col("best.group").alias("group")), "best")
    first = written(_opened(own, member, sizes, best), "first")
    up = written(components(_over(first, groups)), "up")
    rest = kept.join(_whole(best), ["query", "group"], "left_anti").select("query", "group")
    over = _whole(up)
    named = rest.join(over.select(F.col("node").alias("query"), F.col("component").alias("q")), "query", "left").join(over.select(F.col("node").alias("group"), F.col("component").alias("g")), "group", "left")
    rest = written(named.where(F.coalesce("q", "query") != F.coalesce("g", "group")).select("query", "group"), "rest")
    return first if rest.isEmpty() else first.unionByName(_opened(own, member, sizes, rest))


def _with_unseen(short: DataFrame, unseen: DataFrame, most: DataFrame) -> DataFrame:
    """The pairs (a, b, lack, ...) of which more than lack unseen tokens are common.

    A group's tokens lie in as many rows as the longest list needs at UNSEEN a row, dealt by hash, so that equal tokens
    are in rows of one number and no row grows with a group.
    """
    parts = -(-(most.agg(F.max("most")).first()[0] or 1) // UNSEEN)
    listed = _whole(written(unseen.groupBy("group", F.pmod(F.xxhash64("token"), F.lit(parts)).cast("int").alias("part")).agg(F.collect_list("token").alias("unseen")), "unseen"))
    of = lambda side: listed.select(F.col("group").alias(side), "part", F.col("unseen").alias(f"{side}_unseen"))
    met = short.join(of("a"), "a").join(of("b"), ["b", "part"]).withColumn("more", F.size(F.array_intersect("a_unseen", "b_unseen"))).drop("part", "a_unseen", "b_unseen")
    if parts > 1:
        met = met.groupBy("a", "b").agg(F.sum("more").alias("more"), *[F.first(c).alias(c) for c in short.columns if c not in ("a", "b")])
    return met.where("more > lack")


def _opened(own: DataFrame, member: DataFrame, sizes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of query groups and groups: bound by the stored unions of chunks, then exact."""
    few, parts = _whole(member), _whole(sizes).select("group", "chunks")
    chunk = F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int")
    at = lambda c: F.concat_ws(":", "group", c)
    asked = pairs.join(parts, "group").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    asked = written(asked.select("query", at("chunk").alias("at")).join(few.select(F.col("group").alias("query"), "key", "row"), "query").select("at", "key", "row"), "asked")
    wanted = pairs.select("group").distinct().join(parts, "group").join(few, "group")
    held = written(wanted.select(at(chunk).alias("at"), at(chunk).alias("gid"), F.lit(0).alias("side"), "key", "row"), "chunks")
    unions = written(_brought(own, held.drop("at"), Union).withColumnRenamed("gid", "at"), "unions")
    stored, asking = _spread(unions, asked)
    asking = written(asking.select("gid", F.lit(1).alias("side"), "key", "row"), "asking")
    # A place ends in the number of its copy.
    passed = _brought(own, asking, Bound, stored).select(F.regexp_replace("gid", ":[0-9]+$", "").alias("at"), "key")
    passed = written(passed.join(few.select("key", "row"), "key"), "passed")
    opened, asking = _spread(held.drop("gid"), passed)
    rows = opened.select("gid", F.lit(0).alias("side"), "key", "row").unionByName(asking.select("gid", F.lit(1).alias("side"), "key", "row"))
    return _brought(own, written(rows, "opened"), Open)


def _over(links: DataFrame, groups: DataFrame) -> DataFrame:
    """Links between classes as links between their groups."""
    few = _whole(groups)
    up = lambda c: few.select(F.col("node").alias(c), F.col("component").alias(f"{c}_up"))
    both = links.join(up("a"), "a", "left").join(up("b"), "b", "left")
    return both.select(F.coalesce("a_up", "a").alias("a"), F.coalesce("b_up", "b").alias("b"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row: documents whose 5-word shingle sets have Jaccard 0.75 or more are linked.

    component_id is the smallest doc_id reachable over links, the row's own included. Null and empty texts and those
    without words have no shingles and link with nothing: their component is their own id. Equal sets are linked
    whatever their number. Rows that repeat an id are each a document; a class of which all ids are null has a null
    component. An empty table gives no rows; extra columns are not read. Sets are told apart by 64-bit hashes.
    """
    small_batches(docs.sparkSession)
    own = document_sets(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    classes = _classes(own)
    tokens = classes.agg(F.sum("n")).first()[0] or 0
    groups = written(_groups(own, classes), "groups")
    links = _links_between(own, classes, groups, tokens)
    # Links are between classes; over their groups they join whole groups.
    wider = components(_over(links, groups)).select(F.col("node").alias("group"), F.col("component").alias("top"))
    named = classes.select("key", "rep").join(_whole(groups), F.col("key") == F.col("node"), "left").select("key", "rep", F.coalesce("component", "key").alias("group"))
    named = written(named.join(_whole(written(wider, "wider")), "group", "left").select("key", "rep", F.coalesce("top", "group").alias("top")), "named")
    least = written(named.groupBy("top").agg(F.min("rep").alias("component_id")), "least")
    of_key = _whole(written(named.join(_whole(least), "top").select("key", "component_id"), "keys"))
    return own.select("doc_id", "key", "n").join(of_key, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
