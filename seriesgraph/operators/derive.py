"""Derived player and team metrics, and long edge tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kast(rounds: DataFrame, player: str = "player_id") -> DataFrame:
    """Share of a player's rounds with a kill, an assist, survival or a trade; flags are booleans, NULL is false."""
    flags = [F.coalesce(F.col(c), F.lit(False)) for c in ("kill", "assist", "survived", "traded")]
    return rounds.groupBy(player).agg(F.avg(F.when(reduce(lambda a, b: a | b, flags), 1.0).otherwise(0.0)).alias("kast"))


def adr(damage: DataFrame, player: str = "player_id", amount: str = "damage", round_col: str = "round_id") -> DataFrame:
    """Damage per distinct round."""
    return damage.groupBy(player).agg((F.sum(amount) / F.count_distinct(round_col)).alias("adr"))


def first_rates(kills: DataFrame, rounds_played: DataFrame, round_col: str = "round_id", ts: str = "ts", killer: str = "killer_id", victim: str = "victim_id") -> DataFrame:
    """player_id, fb_rate, fd_rate: first kills and first deaths of rounds over the player's rounds.

    rounds_played: player_id and the round. Ties in time go to the smaller killer, then victim.
    """
    first = kills.groupBy(round_col).agg(F.min(F.struct(ts, killer, victim)).alias("f")).select(F.col(f"f.{killer}").alias("k"), F.col(f"f.{victim}").alias("v"))
    counted = first.select(F.explode(F.array(F.struct(F.col("k").alias("p"), F.lit(1).alias("b"), F.lit(0).alias("d")), F.struct(F.col("v").alias("p"), F.lit(0).alias("b"), F.lit(1).alias("d")))).alias("x")).groupBy(F.col("x.p").alias("player_id")).agg(F.sum("x.b").alias("b"), F.sum("x.d").alias("d"))
    played = rounds_played.groupBy("player_id").agg(F.count_distinct(round_col).alias("n"))
    return played.join(counted, "player_id", "left").select("player_id", (F.coalesce("b", F.lit(0)) / F.col("n")).alias("fb_rate"), (F.coalesce("d", F.lit(0)) / F.col("n")).alias("fd_rate"))


def economy(rounds: DataFrame) -> DataFrame:
    """rounds with credit_efficiency (damage over credits, NULL without credits) and save_value_lost (only of lost rounds)."""
    return rounds.withColumn("credit_efficiency", F.col("damage_dealt") / F.nullif("credits_spent", F.lit(0))).withColumn("save_value_lost", F.when(F.col("round_lost"), F.col("saved_loadout_value")).otherwise(0.0))


def long_edges(parts: dict[str, tuple[DataFrame, str, str, str, str]], attributes: dict[str, dict[str, Column]] | None = None) -> DataFrame:
    """kind, src_type, src_id, dst_type, dst_id, attributes of all kinds; parts: kind -> (rows, source type, its id, target type, its id).

    Rows without an end are dropped; attributes (map of text) are those named for the kind.
    """
    out = []
    for kind, (rows, src_type, src, dst_type, dst) in parts.items():
        named = (attributes or {}).get(kind, {})
        have = F.create_map(*[x for k, v in named.items() for x in (F.lit(k), v.cast("string"))]) if named else F.create_map().cast("map<string,string>")
        out.append(rows.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.lit(kind).alias("kind"), F.lit(src_type).alias("src_type"), F.col(src).cast("string").alias("src_id"), F.lit(dst_type).alias("dst_type"), F.col(dst).cast("string").alias("dst_id"), have.alias("attributes")))
    return reduce(DataFrame.unionByName, out)


def history(edges: DataFrame, kind: str, names: DataFrame, src_name: str, dst_name: str) -> DataFrame:
    """One kind's edges with the names of both ends, for tables that are read as they are."""
    rows = edges.where(F.col("kind") == kind)
    n = lambda end, out: names.select(F.col("type").alias(f"{end}_type"), F.col("id").alias(f"{end}_id"), F.col("name").alias(out))
    return rows.join(n("src", src_name), ["src_type", "src_id"], "left").join(n("dst", dst_name), ["dst_type", "dst_id"], "left")


def pending_intents(notes: DataFrame, intents: DataFrame, prompt_version: str, source: str | None = None, limit: int | None = None) -> DataFrame:
    """Notes without an intent for this prompt version, oldest first, with the text of the request."""
    from ..functions.parse import request_text

    done = intents.where((F.col("prompt_version") == prompt_version) & F.col("patch_note_id").isNotNull()).select(F.col("patch_note_id").alias("id"))
    rows = notes.join(done, "id", "left_anti")
    if source:
        rows = rows.where(F.col("source") == source)
    rows = rows.orderBy("published_at", "id")
    rows = rows if limit is None else rows.limit(limit)
    return rows.withColumn("request", request_text(F.col("title"), F.col("body_text"), F.col("blog_text") if "blog_text" in notes.columns else None))


INTENT_SCHEMA = "agents_affected array<string>, maps_affected array<string>, shifts array<struct<subject:string,direction:string,magnitude:double,rationale:string>>, pro_play_score double, community_score double, confidence double"


def load_intents(replies: DataFrame, schema: str = INTENT_SCHEMA, ranges: tuple[str, ...] = ("pro_play_score", "community_score", "confidence"), directions: tuple[str, ...] = ("buff", "nerf", "rework", "neutral")) -> tuple[DataFrame, DataFrame]:
    """(intents, quarantine with codes) of replies: patch_note_id, prompt_version, reply."""
    from ..functions.parse import json_object
    from .quality import split_bad

    parsed = replies.withColumn("r", json_object(F.col("reply"), schema))
    checks = {"not_an_object": F.col("r").isNull()}
    checks |= {f"{c}_range": F.col("r").isNotNull() & ~F.coalesce(F.col(f"r.{c}").between(0.0, 1.0), F.lit(False)) for c in ranges}
    checks["shift_shape"] = F.exists("r.shifts", lambda s: (F.coalesce(F.trim(s["subject"]), F.lit("")) == "") | ~F.coalesce(s["direction"].isin(list(directions)), F.lit(False)) | ~F.coalesce(s["magnitude"].between(0.0, 1.0), F.lit(False)))
    good, bad = split_bad(parsed, checks)
    return good.select("patch_note_id", "prompt_version", "r.*").drop("_bad"), bad.drop("r")


def affecting(intents: DataFrame, agent: str) -> DataFrame:
    return intents.where(F.array_contains("agents_affected", agent))
