"""Old table + incoming rows -> new table: appends, upserts, replacements. All are pure; writing is the caller's."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def surrogate_id(*parts: Column) -> Column:
    """A deterministic id from a natural key: the same row gets the same id in every attempt."""
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts]), 256)


def entity_id(kind: str, platform: str, platform_id: str) -> str:
    """The id of a new entity, from the handle that it was made for."""
    return hashlib.sha256("\u0001".join(("entity", kind, platform, platform_id)).encode()).hexdigest()


def first_per_key(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the given order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def latest_per_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the greatest order of each key: a partial aggregate, so a hot key costs one row a task."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, *[c for c in rest if c != order])).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def insert_absent(target: DataFrame, incoming: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The rows to append: first writer wins within the batch and against the target."""
    return first_per_key(incoming, keys, order).join(target.select(*keys), keys, "left_anti")


def append_unseen(seen: DataFrame, incoming: DataFrame, keys: list[str], first: str | None = None) -> DataFrame:
    """Records whose key (say source and content hash) is new, once each: of equal keys the row with the least first.

    The rows of a key are reduced where they are, so a key with many copies costs one row a task.
    """
    if first is None:
        once = incoming.dropDuplicates(keys)
    else:
        rest = [c for c in incoming.columns if c not in keys]
        order = F.struct(F.col(first).isNull(), first, *[c for c in rest if c != first])
        best = incoming.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r"))
        once = best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in incoming.columns])
    return once.join(seen.select(*keys), keys, "left_anti")


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], touched: list[str] = [], kept: list[str] = []) -> DataFrame:
    """Every key once, with outcome: inserted, updated, unchanged (incoming changes nothing) or untouched (not incoming).

    Incoming values replace the target's, but for kept columns, which stay as they were inserted. touched columns take
    incoming values without counting as a change. Both sides have the same columns and one row a key.
    """
    rest = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(*rest).alias("_old"), F.lit(True).alias("_had"))
    new = incoming.select(*keys, F.struct(*rest).alias("_new"), F.lit(True).alias("_has"))
    both = old.join(new, keys, "full_outer")
    compared = [c for c in rest if c not in touched and c not in kept]
    same = reduce(lambda a, b: a & b, [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in compared], F.lit(True))
    outcome = F.when(F.col("_has").isNull(), "untouched").when(F.col("_had").isNull(), "inserted").when(same, "unchanged").otherwise("updated")

    def value(c: str) -> Column:
        stays = F.col("_has").isNull() | (F.col("_had").isNotNull() if c in kept else F.lit(False))
        return F.when(stays, F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}")).alias(c)

    return both.select(*keys, *[value(c) for c in rest], outcome.alias("outcome"))


def replace_children(target: DataFrame, incoming: DataFrame, parent: list[str], position: str) -> DataFrame:
    """Children of parents in the batch become the incoming ones; a row id of a position that stays survives.

    Parents without an incoming row keep their children, so an empty batch changes nothing.
    """
    others = target.join(incoming.select(*parent).distinct(), parent, "left_anti")
    if "row_id" in target.columns and "row_id" not in incoming.columns:
        known = target.select(*parent, position, "row_id")
        incoming = incoming.join(known, [*parent, position], "left").withColumn("row_id", F.coalesce("row_id", surrogate_id(*[F.col(c) for c in [*parent, position]])))
    return others.unionByName(incoming.select(*target.columns))


def replace_rows(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Delete, then insert."""
    return target.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(incoming.select(*target.columns))


def outcome_counts(rows: DataFrame, column: str = "outcome") -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def merge_sources(values: DataFrame, entity: list[str], priority: dict[str, int], order: str = "arrival") -> tuple[DataFrame, DataFrame]:
    """(merged, conflicts) of long rows: entity columns, field, source, value, arrival order.

    Per field the lowest priority number wins, then the earliest arrival; unknown sources stop the job. Each later
    value that differs from the winner is a conflict, whose after is the winner's value.
    """
    rank = F.create_map(*[x for k, v in priority.items() for x in (F.lit(k), F.lit(v))])
    ranked = values.withColumn("_rank", F.coalesce(F.try_element_at(rank, F.col("source")), F.raise_error(F.concat(F.lit("no priority for source "), F.coalesce("source", F.lit("NULL")))).cast("int")))
    keys = [*entity, "field"]
    winner = ranked.groupBy(*keys).agg(F.min_by(F.struct("value", "source"), F.struct("_rank", order, "source")).alias("_win"))
    merged = winner.select(*keys, F.col("_win.value").alias("value"), F.col("_win.source").alias("source"))
    against = ranked.join(winner, keys).where(~F.col("value").eqNullSafe(F.col("_win.value")))
    conflicts = against.select(*keys, F.col("value").alias("rejected"), F.col("_win.value").alias("after"), F.col("source").alias("losing_source"), F.col("_win.source").alias("winning_source"))
    return merged, conflicts


def chunked_overwrite(rows: DataFrame, ts: str, days: int = 7) -> DataFrame:
    """rows with chunk_start, the begin of their backfill chunk; write with dynamic partition overwrite."""
    day = F.datediff(F.col(ts).cast("date"), F.lit("1970-01-01").cast("date"))
    return rows.withColumn("chunk_start", F.date_add(F.lit("1970-01-01").cast("date"), (F.floor(day / days) * days).cast("int")))
