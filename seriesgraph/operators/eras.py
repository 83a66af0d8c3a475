"""Half-open time eras [start, end): assignment, sequence checks, rolling, and the guard against mixed regimes.

Era tables hold tens of rows, as a rule, and then travel as one array; longer ones are met by stretches of time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scans import carried, ranged, within

#: A longer era table is met by stretches of time instead of as one array.
ARRAY_ERAS = 1_000


def ends_from_starts(specs: DataFrame, start: str = "start_date") -> DataFrame:
    """Each era ends where the next begins; the last stays open. Equal or missing starts stop the job."""
    w = Window.orderBy(start)
    after = F.lead(start).over(w)
    bad = F.col(start).isNull() | (F.lag(start).over(w) == F.col(start))
    return specs.withColumn("end_date", F.when(bad, F.raise_error(F.lit("era starts must be given and rise")).cast("timestamp_ntz")).otherwise(after))


def era_windows(eras: DataFrame) -> DataFrame:
    """Open ends as the far future, with is_current."""
    far = F.lit("9999-12-31 23:59:59").cast("timestamp_ntz")
    return eras.withColumn("is_current", F.col("end_date").isNull()).withColumn("end_date", F.coalesce(F.col("end_date").cast("timestamp_ntz"), far))


def sequence_faults(eras: DataFrame, by: list[str] = []) -> DataFrame:
    """era_slug (and by), fault (overlap, gap, open_not_last): what breaks a sequence of eras, or one for each by; an
    open era covers all later time.
    """
    w = Window.partitionBy(*by).orderBy("start_date", "era_slug")
    row = eras.select(*by, "era_slug", "start_date", "end_date", F.lag("end_date").over(w).alias("_end"), F.lag("start_date").over(w).alias("_start"), F.lead("start_date").over(w).alias("_next"))
    fault = (
        F.when(F.col("end_date").isNull() & F.col("_next").isNotNull(), "open_not_last")
        .when(F.col("_start").isNotNull() & (F.col("_end") > F.col("start_date")), "overlap")
        .when(F.col("_start").isNotNull() & (F.col("_end") < F.col("start_date")), "gap")
    )
    return row.select(*by, "era_slug", fault.alias("fault")).where("fault is not null")


def assign_era(rows: DataFrame, eras: DataFrame, ts: str, on_missing: str = "null") -> DataFrame:
    """rows with era_slug: the latest era whose half-open window has ts.

    on_missing: null, error (stop the job) or nearest_prior (the latest start at or before ts, its end ignored). Few
    eras travel as one sorted array, so each row finds its own by a scan of it, without a join that could multiply rows.
    More of them are listed by stretches of time, a row joins the one list of its stretch, and the rest is the same.
    """
    if on_missing not in ("null", "error", "nearest_prior"):
        raise ValueError(on_missing)
    prior = on_missing == "nearest_prior"
    entry = F.struct(F.col("start_date").cast("timestamp_ntz").alias("s"), F.col("end_date").cast("timestamp_ntz").alias("e"), F.col("era_slug").alias("slug"))
    known = eras.where("start_date is not null").select(entry.alias("_era"))
    at = F.col(ts).cast("timestamp_ntz")
    if eras.count() <= ARRAY_ERAS:
        # One row, of at most ARRAY_ERAS entries.
        listed = rows.crossJoin(F.broadcast(known.agg(F.array_sort(F.collect_list("_era")).alias("_eras"))))
    else:
        listed = _by_stretch(rows, known, at, prior)
    fits = (lambda x: x["s"] <= at) if prior else (lambda x: (x["s"] <= at) & (x["e"].isNull() | (at < x["e"])))
    found = F.try_element_at(F.filter("_eras", fits), F.lit(-1))["slug"]
    if on_missing == "error":
        found = F.coalesce(found, F.raise_error(F.concat(F.lit("no era for "), F.coalesce(at.cast("string"), F.lit("NULL")))))
    return listed.withColumn("era_slug", found).drop("_eras")


def _by_stretch(rows: DataFrame, known: DataFrame, at: Column, prior: bool) -> DataFrame:
    """rows with _eras: the eras that cover some of the row's stretch of time, ascending; for prior those that start in
    it, and the last one before it.

    There are as many stretches as eras, so a sequence without overlaps has about two entries in each list. A stretch
    that has most of the rows is one key of a join, which is split where it is hot; its other side is one row.
    """
    micro = lambda c: F.unix_micros(c.cast("timestamp_ltz"))
    n, low, high = known.agg(F.count(F.lit(1)), F.min(micro(F.col("_era.s"))), F.max(micro(F.col("_era.s")))).first()
    width = max(1, -(-(high - low + 1) // n))
    place = lambda t: F.least(F.greatest(F.floor((micro(t) - low) / width), F.lit(0)), F.lit(n - 1)).cast("int")
    if prior:
        own = known.groupBy(place(F.col("_era.s")).alias("_stretch")).agg(F.array_sort(F.collect_list("_era")).alias("_own"))
        every = known.sparkSession.range(n).select(F.col("id").cast("int").alias("_stretch")).join(own, "_stretch", "left")
        # One row a stretch, so as many as eras.
        last = F.last(F.try_element_at("_own", F.lit(-1)), ignorenulls=True).over(Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1))
        lists = every.select("_stretch", F.filter(F.concat(F.array(last), F.coalesce("_own", F.array().cast(own.schema["_own"].dataType))), lambda x: x.isNotNull()).alias("_eras"))
    else:
        until = F.coalesce(F.col("_era.e") - F.expr("interval 1 microsecond"), F.timestamp_micros(F.lit(low + n * width)).cast("timestamp_ntz"))
        first, past = place(F.col("_era.s")), place(until)
        spans = known.where("_era.e is null or _era.e > _era.s").select("_era", F.explode(F.sequence(first, F.greatest(first, past))).alias("_stretch"))
        lists = spans.groupBy("_stretch").agg(F.array_sort(F.collect_list("_era")).alias("_eras"))
    return rows.withColumn("_stretch", place(at)).join(lists, "_stretch", "left").drop("_stretch")


def current_era(eras: DataFrame) -> DataFrame:
    return eras.where("end_date is null")


def roll_era(eras: DataFrame, boundary: str, slug: str, **fields) -> DataFrame:
    """The current era closed at the boundary and a new one opened at the same instant.

    The boundary must be later than the current start, and exactly one era must be open.
    """
    at = F.lit(boundary).cast(eras.schema["start_date"].dataType)
    opened = eras.where("end_date is null").agg(F.count(F.lit(1)).alias("n"), F.max("start_date").alias("s"))
    ok = opened.select(F.when((F.col("n") == 1) & (F.col("s") < at), at).otherwise(F.raise_error(F.lit("one open era that starts before the boundary is needed")).cast(eras.schema["start_date"].dataType)).alias("_at"))
    closed = eras.crossJoin(F.broadcast(ok)).withColumn("end_date", F.when(F.col("end_date").isNull(), F.col("_at")).otherwise(F.col("end_date"))).drop("_at")
    values = {"era_slug": F.lit(slug), "start_date": F.col("_at"), **{k: F.lit(v) for k, v in fields.items()}}
    new = ok.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in eras.schema])
    return closed.unionByName(new)


def regimes(eras: DataFrame) -> DataFrame:
    """eras with regime_id: a running count of major shifts over start_date."""
    return eras.withColumn("regime_id", F.sum(F.coalesce(F.col("is_major_shift").cast("int"), F.lit(0))).over(Window.orderBy("start_date", "era_slug").rowsBetween(Window.unboundedPreceding, 0)).cast("long"))


def bleeding_groups(rows: DataFrame, eras: DataFrame, group: list[str]) -> DataFrame:
    """Groups whose rows (with era_slug) lie in more than one regime: aggregating them would mix rules of play."""
    found = rows.join(regimes(eras).select("era_slug", "regime_id"), "era_slug")
    return found.groupBy(*group).agg(F.min("regime_id").alias("first_regime"), F.max("regime_id").alias("last_regime")).where("first_regime < last_regime")


def assert_no_bleed(eras: DataFrame, chosen: list[str]) -> None:
    """Stop if a major shift begins after the earliest chosen era's start and up to the latest's; its own flag is allowed."""
    if len(set(chosen)) < 2:
        return
    scope = eras.where(F.col("era_slug").isin(list(chosen))).agg(F.min("start_date").alias("lo"), F.max("start_date").alias("hi"))
    crossed = eras.crossJoin(F.broadcast(scope)).where("is_major_shift and start_date > lo and start_date <= hi").orderBy("start_date").select("era_slug").first()
    if crossed:
        raise ValueError(f"the chosen eras cross the major shift {crossed[0]}")


def alias_at(lookups: DataFrame, aliases: DataFrame, keys: list[str], at: str, valid_from: str = "valid_from") -> DataFrame:
    """lookups and the alias that was valid at their time, the latest one; NULL without one.

    Both lie in one row of time per key, so that a lookup takes the last alias before it and meets no other. The rows
    are cut by ranges of (key, time), so a key with most of them is the work of many tasks; a range begins with the
    last alias of those before it.
    """
    rest = [c for c in aliases.columns if c not in keys]
    known = aliases.where(F.col(valid_from).isNotNull()).select(*keys, F.col(valid_from).alias("_t"), F.lit(0).alias("_kind"), F.struct(valid_from, *[c for c in rest if c != valid_from]).alias("_a"))
    asked = lookups.select(*keys, F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.struct(*lookups.columns).alias("_l"))
    placed = ranged(known.unionByName(asked, allowMissingColumns=True), keys, "_t")
    w = within(keys, F.col("_t").asc_nulls_first(), "_kind", "_a").rowsBetween(Window.unboundedPreceding, 0)
    rows = carried(placed, keys, _before=(F.max("_a"), "last")).withColumn("_last", F.coalesce(F.last("_a", ignorenulls=True).over(w), F.col("_before"))).where("_l is not null")
    # A lookup without a time comes before all aliases of its key.
    named = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys], F.col("_t").isNotNull())
    return rows.select("_l.*", *[F.when(named, F.col(f"_last.{c}")).alias(c) for c in rest])
