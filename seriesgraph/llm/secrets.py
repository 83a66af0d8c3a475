"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of every path is addressed by its content. The ledger holds, per blob and rule version, what a scan
found; a run scans only the pairs it doesn't hold yet, each content once however many paths and versions have it,
and joins the findings back to all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import check_free, shared_folder


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, and the least length of a match or of one of its groups.

    A pattern that ends in a repeated class has the least length in it: a run that is too short has no match inside.
    """

    kind: str
    pattern: str
    least: int
    group: int = 0


#: Fixed values of the contract.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
#: Names the rules in ledgers; a change of the rules needs a new name.
RULES_VERSION = "base-1"

#: start and end in code points, first and last the same in bytes of UTF-8.
SPAN = "struct<start:int,rank:int,end:int,first:int,last:int>"
#: Entries of an array that running() takes together.
RUN = 256


def bound(value: Column, then) -> Column:
    """then(value), the value computed once however often then uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def running(values: Column, combine, start: int = 0) -> Column:
    """For each entry of an array what combine makes of those before it, from start on.

    By blocks of RUN entries: an entry takes what the blocks before it come to and then the few before it in its own, so
    the work grows with the entries and nothing is copied from one to the next.
    """
    zero = F.lit(start)

    def of(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.size(v) - 1, F.lit(RUN)), lambda at: F.aggregate(F.slice(v, at + 1, F.lit(RUN)), zero, combine))
        before = lambda b: F.transform(b, lambda _, k: F.aggregate(F.slice(b, F.lit(1), k), zero, combine))
        return bound(bound(blocks, before), lambda base: F.transform(v, lambda _, i: F.aggregate(F.slice(v, i - i % RUN + 1, i % RUN), F.get(base, F.floor(i / RUN).cast("int")), combine)))

    return bound(values, lambda v: F.when(F.size(v) > 0, of(v)).otherwise(F.array().cast("array<int>")))


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's matches in text, leftmost first and without overlap, as spans; failing ones dropped.

    What split() leaves between the matches of extract_all() gives their places: each starts after all gaps and
    matches before it, whose lengths are added up by running sums. Texts without a match of the whole pattern skip all.
    """
    gaps = F.split(text, rule.pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))

    def sized(gap: Column, hit: Column) -> Column:
        inner = F.regexp_extract(hit, rule.pattern, rule.group) if rule.group else hit
        size = lambda f: F.coalesce(f(hit), F.lit(0))  # noqa: E731  the last gap has no match after it
        return F.struct(F.length(gap).alias("gap"), size(F.length).alias("hit"), F.octet_length(gap).alias("gap_bytes"), size(F.octet_length).alias("hit_bytes"), (F.coalesce(F.length(inner), F.lit(-1)) >= rule.least).alias("keep"))

    def placed(pairs: Column) -> Column:
        add = lambda x, y: x + y
        points = running(F.transform(pairs, lambda p: p["gap"] + p["hit"]), add)
        octets = running(F.transform(pairs, lambda p: p["gap_bytes"] + p["hit_bytes"]), add)

        def span(before: Column, octets_before: Column) -> Column:
            def at(p: Column, i: Column) -> Column:
                start, first = F.get(before, i) + p["gap"], F.get(octets_before, i) + p["gap_bytes"]
                return F.when(p["keep"], F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + p["hit"]).alias("end"), first.alias("first"), (first + p["hit_bytes"]).alias("last")))

            return F.filter(F.transform(pairs, at), lambda s: s.isNotNull())

        return bound(points, lambda x: bound(octets, lambda y: span(x, y)))

    return F.when(text.rlike(rule.pattern), bound(F.zip_with(gaps, hits, sized), placed)).otherwise(F.array().cast(f"array<{SPAN}>"))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, content -> blob, spans (all kinds, by start and then kind as listed)."""
    found = [spans_of(F.col("content"), rule, k) for k, rule in enumerate(rules)]
    return blobs.select("blob", F.array_sort(F.concat(*found)).alias("spans"))


def scan_versions(versions: DataFrame, content_col: str, ledger: DataFrame | None = None, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES, rules_version: str = RULES_VERSION, names: tuple[str, str] = ("blob", "spans")) -> tuple[DataFrame, DataFrame]:
    """(versions with blob and spans, under names; the ledger after this run).

    versions: a row per path and version, content_col its content (null: empty); all other columns pass through, and
    where one has one of the names, other names must be given; none is overwritten. ledger: blob, rules_version, spans of earlier runs. The new findings are
    written to ledger_path, a folder that must not exist yet (below the shared one if not given), and pairs that were
    known are not scanned again. Repeated rows keep their findings each; an empty table gives empty results.
    """
    check_free(names, versions.columns)
    spark = versions.sparkSession
    blob, spans = names
    named = versions.withColumn(blob, F.sha2(F.encode(F.coalesce(F.col(content_col), F.lit("")), "UTF-8"), 256))
    contents = named.select(F.col(blob).alias("blob"), F.coalesce(F.col(content_col), F.lit("")).alias("content"))
    if ledger is not None:
        contents = contents.join(ledger.where(F.col("rules_version") == rules_version).select("blob"), "blob", "left_anti")
    once = contents.groupBy("blob").agg(F.first("content").alias("content"))
    # Contents without findings are held too, so that a later run need not scan them again.
    fresh = scan(once, rules).select("blob", F.lit(rules_version).alias("rules_version"), "spans")
    path = ledger_path or f"{shared_folder(spark)}/ledger"
    fresh.write.parquet(path)
    stored = spark.read.schema(fresh.schema).parquet(path)
    after = stored if ledger is None else ledger.select("blob", "rules_version", "spans").unionByName(stored)
    known = after.where((F.col("rules_version") == rules_version) & (F.size("spans") > 0)).select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    return named.join(known, blob, "left").withColumn(spans, F.coalesce(spans, F.array().cast(f"array<{SPAN}>"))), after


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """text with every span replaced by mark; spans that overlap become one. text must not be null where spans are.

    The bytes between spans are cut out by their places, so the work grows with the text and the spans.
    """

    def cut(data: Column, own: Column) -> Column:
        reached = running(F.transform(own, lambda s: s["last"]), lambda x, y: F.greatest(x, y))
        piece = lambda lo, hi: F.decode(F.substring(data, lo + 1, hi - lo), "UTF-8")
        gaps = lambda before: F.filter(F.transform(own, lambda s, i: F.when(s["first"] >= F.get(before, i), piece(F.get(before, i), s["first"]))), lambda g: g.isNotNull())
        last = F.array_max(F.transform(own, lambda s: s["last"]))
        return F.array_join(F.concat(bound(reached, gaps), F.array(piece(last, F.octet_length(data)))), mark)

    cut_up = bound(F.encode(text, "UTF-8"), lambda data: bound(spans, lambda own: cut(data, own)))
    return F.when(F.size(spans) > 0, cut_up).otherwise(text)


def secret_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end joined by commas) of each document.

    Null and empty texts have no spans, null and repeated ids keep their rows, an empty table gives none, and other
    columns are not read.
    """
    slim, _ = scan_versions(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text")
    kinds = F.array(*[F.lit(r.kind) for r in RULES])
    joined = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda k: F.size(F.filter("spans", lambda s: s["rank"] == k))
    counts = [of(k).cast("long").alias(f"n_{r.kind}") for k, r in enumerate(RULES)]
    return slim.select("doc_id", *counts, F.sha2(joined, 256).alias("base_sha256"), joined.alias("spans"))
