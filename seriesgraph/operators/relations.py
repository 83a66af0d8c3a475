"""The relationship graph: pairs from shared appearances, decay, re-runs, event folds."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.formulas import DECAY_RATES, decay_rate, decay_strength, pair_kind, shared_strength, weeks_between
from .merge import surrogate_id

#: A side with more entities is paired in blocks of so many.
ROSTER_BLOCK = 64


def _sides(rosters: DataFrame, by: list[str] = []) -> DataFrame:
    """by, map_id, side, who (distinct entities, ascending), at (the latest)."""
    return rosters.where("entity_id is not null").groupBy(*by, "map_id", "side").agg(F.array_sort(F.collect_set("entity_id")).alias("who"), F.max("at").alias("at"))


def latest_at(rosters: DataFrame, by: list[str] = [], name: str = "latest") -> DataFrame:
    """One row: the latest appearance anywhere; from the sides that shared_pairs gathers, so both share one exchange."""
    return _sides(rosters, by).agg(F.max("at").alias(name))


def shared_pairs(rosters: DataFrame, by: list[str] = []) -> DataFrame:
    """src_id < dst_id, maps, last_at of pairs on the same side of the same map; rosters: map_id, side, entity_id, at.

    by: columns that a map lies in as a whole (its era), for pairs of each of them.

    Pairs come from each side's roster as one array, so the rows are shuffled once. A side above ROSTER_BLOCK is cut
    into blocks, and every two blocks are paired on their own, over all tasks; no roster is too large.
    """
    sides = _sides(rosters, by)
    few = sides.where(F.size("who") <= ROSTER_BLOCK)
    left = few.select(*by, "at", "who", F.posexplode("who").alias("i", "src_id"))
    pairs = left.select(*by, "at", "src_id", F.explode(F.slice("who", F.col("i") + 2, F.size("who"))).alias("dst_id"))
    many = sides.where(F.size("who") > ROSTER_BLOCK).withColumn("n", F.ceil(F.size("who") / ROSTER_BLOCK).cast("int"))
    blocks = many.select(*by, "map_id", "side", "at", "who", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    part = lambda c: F.slice("who", F.col(c) * ROSTER_BLOCK + 1, ROSTER_BLOCK)
    blocks = blocks.select(*by, "map_id", "side", "at", "i", "who", part("i").alias("first"), F.explode(F.sequence("i", F.col("n") - 1)).alias("j"))
    blocks = blocks.select(*by, "map_id", "side", "at", "i", "j", "first", part("j").alias("second")).repartition("map_id", "side", "i", "j")
    crossed = blocks.select(*by, "at", "second", F.explode("first").alias("src_id")).select(*by, "at", "src_id", F.explode("second").alias("dst_id")).where("src_id < dst_id")
    return pairs.unionByName(crossed).groupBy(*by, "src_id", "dst_id").agg(F.count(F.lit(1)).alias("maps"), F.max("at").alias("last_at"))


def teammate_edges(rosters: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Pairs with strength, sentiment and kind, as of the latest appearance anywhere (one-player sides count too)."""
    pairs = shared_pairs(rosters) if pairs is None else pairs
    edges = pairs.crossJoin(F.broadcast(latest_at(rosters, name="_latest")))  # one row
    return edges.select(
        surrogate_id(F.col("src_id"), F.col("dst_id"), F.lit("played_with")).alias("edge_id"), "src_id", "dst_id",
        pair_kind(F.col("last_at"), F.col("_latest")).alias("edge_type"), shared_strength(F.col("maps")).alias("strength"),
        F.lit(1.0).alias("sentiment"), F.col("last_at").alias("last_updated_at"), "maps",
    )


def rerun_edges(existing: DataFrame, fresh: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, events) after a bootstrap over edges that may have lived on.

    Per pair one edge of the two kinds stays: the one of the fresh kind, else the other, whose kind flips; id, events
    and sentiment stay. A stale twin is dropped and its events move over. Strength and time are refreshed only if the
    edge was not updated after the last shared map; maps always are. Other kinds and pairs pass through.
    """
    kinds = ["teammate", "ex_teammate"]
    own = existing.where(F.col("edge_type").isin(kinds))
    rest = existing.where(~F.col("edge_type").isin(kinds))
    new = fresh.select("src_id", "dst_id", *[F.col(c).alias(f"_{c}") for c in fresh.columns if c not in ("src_id", "dst_id")], F.lit(True).alias("_fresh"))
    held = own.groupBy("src_id", "dst_id").agg(F.collect_list(F.struct(*[c for c in own.columns if c not in ("src_id", "dst_id")])).alias("_old"))
    both = held.join(new, ["src_id", "dst_id"], "full_outer")
    same = F.filter("_old", lambda e: e["edge_type"] == F.col("_edge_type"))
    keep = F.coalesce(F.try_element_at(same, F.lit(1)), F.try_element_at(F.col("_old"), F.lit(1)))
    both = both.withColumn("_keep", keep)
    refresh = F.col("_keep").isNull() | (F.col("_keep.last_updated_at") <= F.col("_last_updated_at"))
    has = F.col("_fresh").isNotNull()
    pick = lambda c: F.when(has & refresh, F.col(f"_{c}")).otherwise(F.col(f"_keep.{c}"))
    merged = both.where("_fresh is not null").select(
        F.coalesce("_keep.edge_id", "_edge_id").alias("edge_id"), "src_id", "dst_id", F.col("_edge_type").alias("edge_type"),
        pick("strength").alias("strength"), F.coalesce("_keep.sentiment", "_sentiment").alias("sentiment"),
        pick("last_updated_at").alias("last_updated_at"), F.col("_maps").alias("maps"),
    )
    alone = own.join(fresh.select("src_id", "dst_id"), ["src_id", "dst_id"], "left_anti")
    edges = merged.unionByName(alone.select(*merged.columns)).unionByName(rest.select(*merged.columns))
    moved = both.where("_fresh is not null and _old is not null").select(F.explode("_old.edge_id").alias("edge_id"), F.col("_keep.edge_id").alias("_to"))
    return edges, events.join(moved, "edge_id", "left").withColumn("edge_id", F.coalesce("_to", "edge_id")).drop("_to")


def decay_pass(edges: DataFrame, now, rates: Mapping[str, float] = DECAY_RATES) -> DataFrame:
    """Every edge brought to now, with touched; time never moves back, sentiment stays, a rerun touches none."""
    at = F.lit(now).cast(edges.schema["last_updated_at"].dataType)
    later = at > F.col("last_updated_at")
    value = decay_strength(F.col("strength"), F.col("edge_type"), weeks_between(F.col("last_updated_at"), at), rates)
    return edges.withColumn("touched", F.coalesce(later, F.lit(False))).withColumn("strength", value).withColumn("last_updated_at", F.when(later, at).otherwise(F.col("last_updated_at")))


def compose(first, then):
    """The map of one clamped step after another; steps are (a, b, lo, hi) for x -> min(hi, max(lo, a x + b)), a >= 0."""
    a, b, lo, hi = first
    c, d, low, high = then
    held = lambda x: np.minimum(high, np.maximum(low, x))
    return a * c, c * b + d, held(c * lo + d), held(c * hi + d)


def composed(steps: tuple, group: np.ndarray) -> tuple[tuple, np.ndarray]:
    """(one map for each run of equal groups, its steps composed in order; where each run begins), in log2 of the
    longest run passes: each pass composes neighbours."""
    first = np.flatnonzero(np.diff(group, prepend=-1))
    at = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
    while at.max(initial=0) > 0:
        later = np.flatnonzero(at % 2 == 1)
        joined = compose(tuple(s[later - 1] for s in steps), tuple(s[later] for s in steps))
        steps = tuple(s.copy() for s in steps)
        for s, j in zip(steps, joined):
            s[later - 1] = j
        keep = at % 2 == 0
        steps, at = tuple(s[keep] for s in steps), at[keep] // 2
    return steps, first


#: Events that a task folds at once.
FOLD_ROWS = 500_000
_FOLDED = "edge_id string, part int, n int, t long, last long, rate double, sa double, sb double, slo double, shi double, ma double, mb double, mlo double, mhi double"


def _part_maps(batches):
    """One row an edge and stretch of its events: the map of its strength and of its sentiment over these events.

    Rows come sorted by edge and time. Decay between two events belongs to the later one, but that before the first
    depends on what came before, so it is left to the merge.
    """
    import pyarrow as pa
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    held, size, number = [], 0, 0

    def folded():
        nonlocal number
        table = pa.concat_tables(held).combine_chunks()
        ids = table.column("edge_id").to_numpy(zero_copy_only=False)
        t, rate, ds, dm = (table.column(c).to_numpy() for c in ("t", "rate", "ds", "dm"))
        group = np.cumsum(np.concatenate(([0], ids[1:] != ids[:-1])))
        before = np.concatenate(([t[0]], t[:-1]))
        start = np.concatenate(([True], group[1:] != group[:-1]))
        fade = np.exp(-rate * np.where(start, 0, t - before) / 6.048e11)
        full = lambda x: np.full(len(t), x)
        strength, first = composed((fade, ds, full(0.0), full(1.0)), group)
        mood, _ = composed((full(1.0), dm, full(-1.0), full(1.0)), group)
        last = np.append(first[1:], len(t)) - 1
        columns = [pa.array(ids[first], pa.string()), pa.array(np.full(len(first), part, np.int32)), pa.array(np.full(len(first), number, np.int32)), pa.array(t[first]), pa.array(t[last]), pa.array(rate[first]), *map(pa.array, strength), *map(pa.array, mood)]
        number += 1
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _FOLDED.split(", ")])

    for batch in batches:
        if batch.num_rows:
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
        if size >= FOLD_ROWS:
            yield from folded()
            held, size = [], 0
    if held:
        yield from folded()


def fold_events(edges: DataFrame, events: DataFrame, rates: Mapping[str, float] = DECAY_RATES) -> DataFrame:
    """Edges after their events in the order of (occurred_at, event_id): decay up to each, add its deltas, hold to the
    ranges. Events up to the edge's own time are already in it; of several at one instant each counts.

    A step x -> min(hi, max(lo, a x + b)) after another is such a step, so an edge's events need no one place: they are
    dealt to tasks by ranges of (edge, time), a task makes one step of each edge's stretch, and an edge's few stretches
    (one a task that has some of it) are taken in order.
    """
    micro = lambda c: F.unix_micros(c.cast("timestamp"))
    rate = F.coalesce(decay_rate(F.col("edge_type"), rates), F.raise_error(F.concat(F.lit("no decay for "), F.col("edge_type"))).cast("double"))
    own = edges.select("edge_id", micro(F.col("last_updated_at")).alias("since"), rate.alias("rate"))
    delta = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    later = events.select("edge_id", micro(F.col("occurred_at")).alias("t"), F.col("event_id").cast("string").alias("event_id"), delta("delta_strength").alias("ds"), delta("delta_sentiment").alias("dm"))
    later = later.join(own, "edge_id").where("t > since").withColumn("edge_id", F.col("edge_id").cast("string"))
    ordered = later.repartitionByRange("edge_id", "t", "event_id").sortWithinPartitions("edge_id", "t", "event_id")
    maps = ordered.select("edge_id", "t", "rate", "ds", "dm").mapInArrow(_part_maps, _FOLDED)
    step = F.struct(*[c.split()[0] for c in _FOLDED.split(", ")[1:]])
    chain = maps.groupBy(F.col("edge_id").alias("_edge")).agg(F.array_sort(F.collect_list(step)).alias("_steps"))
    rows = edges.withColumn("_rate", rate).join(chain, F.col("edge_id").cast("string") == F.col("_edge"), "left")
    start = F.struct(micro(F.col("last_updated_at")).alias("t"), F.col("strength").cast("double").alias("s"), F.col("sentiment").cast("double").alias("m"))

    def take(acc, e):
        faded = acc["s"] * F.exp(-e["rate"] * (e["t"] - acc["t"]) / F.lit(6.048e11))
        held = lambda x, side: F.least(e[f"{side}hi"], F.greatest(e[f"{side}lo"], e[f"{side}a"] * x + e[f"{side}b"]))
        return F.struct(e["last"].alias("t"), held(faded, "s").alias("s"), held(acc["m"], "m").alias("m"))

    folded = rows.withColumn("_f", F.aggregate(F.coalesce("_steps", F.array().cast(chain.schema["_steps"].dataType)), start, take))
    return folded.withColumns({"strength": F.col("_f.s"), "sentiment": F.col("_f.m"), "last_updated_at": F.timestamp_micros("_f.t").cast(edges.schema["last_updated_at"].dataType)}).select(*edges.columns)


def neighbours(edges: DataFrame) -> DataFrame:
    """Each edge from both ends: entity, neighbour, and the edge's other columns."""
    rest = [c for c in edges.columns if c not in ("src_id", "dst_id")]
    one = edges.select(F.col("src_id").alias("entity_id"), F.col("dst_id").alias("neighbour_id"), *rest)
    return one.unionByName(edges.select(F.col("dst_id").alias("entity_id"), F.col("src_id").alias("neighbour_id"), *rest))
