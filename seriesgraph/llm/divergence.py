"""How the sources of each language differ: divergence of their term shares, in integers.

Terms are counted where the texts are read, exchanged once and kept one row a term. Pairs of sources meet in tiles: a
task has some terms as a matrix of shares, terms by sources, and adds up each pair's divergence over them. A group's
foremost terms come from dominance skybands: of two terms of a group, the one with no smaller count in the group, no
larger count in the language and the earlier UTF-8 form never ranks behind the other, whatever the totals are, so a term
with k such others can't be among the first k. Partitions keep what is left, these skybands are merged, and the rest is
ranked exactly.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, task_number, whole_if_small, written
from .textbytes import FOLD_TERMS, split_words

#: Documents of a language that a kept term is in, at least; terms that a group's report has, at most.
LEAST_DOCS = 10
TERMS = 10
#: Distinct terms that a task counts before it passes them on; sources and terms of one tile; skybands merged at a time.
HELD = 400_000
TILE = 32
TILE_TERMS = 8192
FANIN = 32


def _counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents it is in): partial counts of tasks."""

    def run(batches):
        import pyarrow as pa

        seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def flush():
            for (lang, source), (n, in_docs) in seen.items():
                terms = list(n)
                for lo in range(0, len(terms), 50_000):
                    some = terms[lo : lo + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some), pa.string()), pa.array([source] * len(some), pa.string()), pa.array(some, pa.binary()).cast(pa.string()), pa.array([n[t] for t in some], pa.int64()), pa.array([in_docs[t] for t in some], pa.int64())],
                        names=["lang", "source", "term", "n", "docs"],
                    )
            seen.clear()

        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                n, in_docs = seen.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(n), set()
                for words in split_words(text, FOLD_TERMS):
                    n.update(words)
                    own.update(words)
                in_docs.update(own)
                held += len(n) - before
                if held >= HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term, lang_n, sources (array of source and n) of the terms in at least so many documents of the language.

    One exchange, by language and term: the two aggregations after it need no other.
    """
    dealt = _counted(docs).repartition("lang", "term")
    by_source = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources"))
    return by_term.where(F.col("docs") >= least_docs).drop("docs")


def share(n: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kinds)) by long division, three digits at a time, so that 64 bits hold it."""
    divisor = total + 2 * kinds
    out, rest = F.call_function("div", n + 2, divisor), (n + 2) % divisor
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + F.call_function("div", rest, divisor), rest % divisor
    return out + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def skyband(n: np.ndarray, lang_n: np.ndarray, k: int, block: int = 256) -> np.ndarray:
    """Which terms, given in order of UTF-8, fewer than k earlier ones dominate: n no smaller and lang_n no larger.

    A term that k others dominate is dominated by k of the skyband, so each block meets the kept terms and itself.
    """
    keep = np.zeros(len(n), bool)
    for lo in range(0, len(n), block):
        a, b = n[lo : lo + block], lang_n[lo : lo + block]
        earlier = np.flatnonzero(keep[:lo])
        over = ((n[earlier] >= a[:, None]) & (lang_n[earlier] <= b[:, None])).sum(axis=1)
        within = (a >= a[:, None]) & (b <= b[:, None])
        over += np.tril(within, -1).sum(axis=1)
        keep[lo : lo + block] = over < k
    return keep


def _banded(table, k: int):
    """The skyband of an Arrow table (term, n, lang_n) of one group."""
    import pyarrow as pa
    import pyarrow.compute as pc

    table = table.take(pc.sort_indices(table.column("term")))
    return table.filter(pa.array(skyband(table.column("n").to_numpy(), table.column("lang_n").to_numpy(), k)))


def _skybands(rows: DataFrame, k: int, most: int = 1 << 20) -> DataFrame:
    """lang, source, term, n, lang_n, part: the skyband of each group within each partition of rows.

    most: rows that a task holds; beyond it all it has goes on, which merging takes in.
    """
    names = ["term", "n", "lang_n"]

    def run(batches):
        import pyarrow as pa

        part = task_number()
        held: dict[tuple[str, str], list] = {}
        size: Counter = Counter()
        banded: Counter = Counter()

        def shrink(key):
            held[key] = [_banded(pa.concat_tables(held[key]), k)]
            size[key] = banded[key] = held[key][0].num_rows

        def out(key):
            table, (lang, source) = held[key][0], key
            for some in table.combine_chunks().to_batches(50_000):
                m = some.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([lang] * m, pa.string()), pa.array([source] * m, pa.string()), *some.columns, pa.array(np.full(m, part, np.int32))], names=["lang", "source", *names, "part"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = table.group_by(["lang", "source"]).aggregate([]).to_pylist()
            codes = {(r["lang"], r["source"]): i for i, r in enumerate(keys)}
            at = np.array([codes[x] for x in zip(table.column("lang").to_pylist(), table.column("source").to_pylist())], np.int64)
            order = np.argsort(at, kind="stable")
            bounds = np.searchsorted(at[order], np.arange(len(keys) + 1))
            for key, i in codes.items():
                piece = table.select(names).take(pa.array(order[bounds[i] : bounds[i + 1]]))
                held.setdefault(key, []).append(piece)
                size[key] += piece.num_rows
                if size[key] >= 4096 + 2 * banded[key]:
                    shrink(key)
            if sum(size.values()) > most:
                for key in list(held):
                    shrink(key)
                if sum(size.values()) > most // 2:
                    for key in held:
                        yield from out(key)
                    held.clear(), size.clear(), banded.clear()
        for key in list(held):
            shrink(key)
            yield from out(key)

    return rows.mapInArrow(run, "lang string, source string, term string, n long, lang_n long, part int")


def top_terms(kept: DataFrame, k: int) -> DataFrame:
    """lang, source, term, n, lang_n: of every group the terms that may be among its first k, by merged skybands."""
    rows = kept.select("lang", "term", "lang_n", F.explode("sources").alias("s")).select("lang", F.col("s.source").alias("source"), "term", F.col("s.n").alias("n"), "lang_n")
    bands = written(_skybands(rows, k), "skybands")
    parts = (bands.agg(F.max("part")).first()[0] or 0) + 1

    def merge(table):
        import pyarrow as pa

        rest = _banded(table.select(["term", "n", "lang_n"]), k)
        keys = {c: table.column(c)[0].as_py() for c in ("lang", "source", "part")}
        of = lambda c, kind: pa.array([keys[c]] * rest.num_rows, kind)
        return pa.Table.from_arrays([of("lang", pa.string()), of("source", pa.string()), *rest.columns, of("part", pa.int32())], names=["lang", "source", "term", "n", "lang_n", "part"])

    while True:
        parts = -(-parts // FANIN)
        bands = bands.withColumn("part", F.floor(F.col("part") / FANIN).cast("int")).groupBy("lang", "source", "part").applyInArrow(merge, bands.schema)
        if parts <= 1:
            return bands.drop("part")


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, idx (from 0 in the language), n_sources, total, lang_total, kinds, p0: every occurring group.

    total and lang_total are sums over kept terms, kinds is their number, p0 the share of a term that the group lacks.
    """
    totals = kept.select("lang", F.explode("sources").alias("s")).groupBy("lang", "s.source").agg(F.sum("s.n").alias("total"))
    kinds = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("lang_n").alias("lang_total"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    rows = docs.groupBy("lang", "source").agg(F.count(F.lit(1))).join(totals, ["lang", "source"], "left").join(kinds, "lang", "left").select("lang", "source", zero("total"), zero("lang_total"), zero("kinds"))
    w = Window.partitionBy("lang")
    rows = rows.withColumn("idx", F.row_number().over(w.orderBy("source")) - 1).withColumn("n_sources", F.count(F.lit(1)).over(w).cast("int"))
    return rows.withColumn("p0", F.when(F.col("kinds") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kinds"))).otherwise(F.lit(1).cast("long")))


def pair_divergence(kept: DataFrame, groups: DataFrame, tile: int = TILE, tile_terms: int = TILE_TERMS) -> DataFrame:
    """lang, source, item, value: for every two sources of a language, both ways round.

    groups is written. Tiles of sources meet in pairs, each over buckets of terms; a task's matrix has tile_terms terms
    (about) by at most two tiles of sources. Terms that no source of two tiles has add the same for every bucket and are
    counted, not met.
    """
    tiles = lambda: F.floor((F.col("n_sources") - 1) / tile).cast("int")
    buckets = F.floor((F.col("kinds") + (tile_terms - 1)) / tile_terms).cast("int")
    info = groups.select("lang", "source", "idx", "p0", "total", "kinds", tiles().alias("last"), F.greatest(buckets, F.lit(1)).alias("buckets")).withColumn("own", F.floor(F.col("idx") / tile).cast("int"))
    small = whole_if_small(info)
    met = lambda: F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
    pair = [F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")]
    rows = kept.select("lang", "term", F.explode("sources").alias("s")).select("lang", "term", F.col("s.source").alias("source"), F.col("s.n").alias("n")).join(small, ["lang", "source"])
    rows = rows.select("lang", "term", "idx", share(F.col("n"), F.col("total"), F.col("kinds")).alias("p"), F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int").alias("bucket"), "own", "last")
    rows = rows.select("lang", "term", "idx", "p", "bucket", "own", met()).select("lang", "term", "idx", "p", "bucket", *pair)
    marks = info.select("lang", F.lit(None).cast("string").alias("term"), "idx", F.col("p0").alias("p"), F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"), "own", "last")
    marks = marks.select("lang", "term", "idx", "p", "bucket", "own", met()).select("lang", "term", "idx", "p", "bucket", *pair)

    def add(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        lang, a, b = (table.column(c)[0].as_py() for c in ("lang", "a", "b"))
        mark = np.asarray(pc.is_null(table.column("term")).to_numpy(zero_copy_only=False), bool)
        idx, p = table.column("idx").to_numpy(), table.column("p").to_numpy()
        order = np.argsort(idx[mark], kind="stable")
        known, empty = idx[mark][order], p[mark][order]
        coded = table.column("term").filter(pa.array(~mark)).combine_chunks().dictionary_encode()
        terms = len(coded.dictionary)
        shares = np.tile(empty, (terms, 1))
        shares[np.asarray(coded.indices, np.int64), np.searchsorted(known, idx[~mark])] = p[~mark]
        left, right = np.flatnonzero(known // tile == a), np.flatnonzero(known // tile == b)
        out_i, out_j, out_v = [], [], []
        for i in left:
            j = right[right > i]
            one, others = shares[:, i : i + 1], shares[:, j]
            out_i.append(np.full(len(j), known[i]))
            out_j.append(known[j])
            out_v.append(((one - others) ** 2 // (one + others)).sum(axis=0))
        cat = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        i, j, v = cat(out_i, np.int32), cat(out_j, np.int32), cat(out_v, np.int64)
        return pa.table({"lang": pa.array([lang] * len(i), pa.string()), "i": i, "j": j, "value": v, "terms": np.full(len(i), terms, np.int64)})

    sums = rows.unionByName(marks).groupBy("lang", "a", "b", "bucket").applyInArrow(add, "lang string, i int, j int, value long, terms long").groupBy("lang", "i", "j").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    end = lambda side: small.select("lang", F.col("idx").alias(side), F.col("source").alias(f"{side}_source"), F.col("p0").alias(f"{side}_p0"), F.col("kinds").alias(f"{side}_kinds"))
    named = sums.join(end("i"), ["lang", "i"]).join(end("j"), ["lang", "j"])
    value = F.col("value") + (F.col("i_kinds") - F.col("terms")) * divergence(F.col("i_p0"), F.col("j_p0"))
    both = F.explode(F.array(F.struct(F.col("i_source").alias("source"), F.col("j_source").alias("item")), F.struct(F.col("j_source").alias("source"), F.col("i_source").alias("item")))).alias("s")
    return named.select("lang", value.alias("value"), both).select("lang", "s.source", "s.item", "value")


def audit_sources(docs: DataFrame, least_docs: int = LEAST_DOCS, terms: int = TERMS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from the others, and by which terms.

    Nulls in the three columns are ''. A row is a document, so repeated rows count each time. Part 'pair' has every
    other source of the language, its value 0 where the language keeps no term; part 'term' a group's first terms by
    value, commoner in the group than in the language. Ranks go down by value, ties by UTF-8. A language with one source
    has no pairs. An empty table gives no rows. Extra columns are not read.
    """
    small_batches(docs.sparkSession)
    own = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    kept = written(kept_terms(own, least_docs), "terms")
    groups = written(_groups(own.select("lang", "source"), kept), "groups")
    pairs = pair_divergence(kept, groups).withColumn("part", F.lit("pair"))
    found = top_terms(kept, terms).join(whole_if_small(groups.select("lang", "source", "total", "lang_total", "kinds")), ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("kinds")), share(F.col("lang_n"), F.col("lang_total"), F.col("kinds"))
    scored = found.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    scored = scored.withColumn("value", divergence(F.col("p"), F.col("q"))).drop("p", "q")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    first = scored.withColumn("rank", rank).where(F.col("rank") <= terms)
    return pairs.withColumn("rank", rank).select("lang", "source", "part", "item", "value", "rank").unionByName(first.select("lang", "source", "part", "item", "value", "rank"))
