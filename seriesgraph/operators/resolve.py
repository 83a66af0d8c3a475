"""Entity resolution over aliases: exact, then fuzzy within a type, with a review band, rebrands, and batch order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import NameIndex, WinklerIndex
from ..functions.parse import iso_timestamp, normal_name
from ..sources.shared import written
from .merge import entity_id

#: From these scores on a handle is merged, or put up for review.
MERGE, REVIEW = 0.90, 0.70
CANDIDATES = 5
#: Handles that one task decides in order; names of each side that meet in a tile.
BLOCK_ROWS = 4096
TILE_NAMES = 4096
HANDLE = ["platform", "platform_id", "platform_name", "entity_type", "created_at", "id"]

#: Sources and the platform their ids belong to.
PLATFORMS = {"liquipedia": "liquipedia", "vlr": "vlr", "riot": "riot_api", "riot_api": "riot_api", "esportsearnings": "esportsearnings", "twitch": "twitch", "twitter": "twitter"}


def extract_handles(staging: DataFrame, platforms: dict[str, str] = PLATFORMS, now: str | None = None) -> DataFrame:
    """staging with platform, platform_id, platform_name and, for rebrands, new_platform_id and renamed_at; miss if none.

    An explicit id and name come first; else slug (or previous_slug) and name (or display_name). A previous slug that
    differs from the slug is a rebrand: the old one identifies, the new one is to be added. now stands in for a
    rename date that cannot be read.
    """
    text = lambda k: F.get_json_object("payload", f"$.{k}")
    filled = lambda c: F.nullif(c, F.lit(""))
    platform = F.try_element_at(F.create_map(*[F.lit(x) for kv in platforms.items() for x in kv]), F.col("source"))
    explicit = text("platform_id").isNotNull() & text("platform_name").isNotNull()
    slug, before = filled(text("slug")), filled(text("previous_slug"))
    name = F.coalesce(filled(text("name")), text("display_name"))
    moved = ~explicit & before.isNotNull() & slug.isNotNull() & (before != slug)
    out = staging.withColumn("platform", platform).withColumn("platform_id", F.when(explicit, text("platform_id")).otherwise(F.coalesce(before, slug))).withColumn("platform_name", F.when(explicit, text("platform_name")).otherwise(name))
    out = out.withColumn("new_platform_id", F.when(moved, slug)).withColumn("renamed_at", F.when(moved, F.coalesce(iso_timestamp(text("renamed_at")), F.lit(now).cast("timestamp"))))
    return out.withColumn("miss", F.col("platform").isNull() | F.col("platform_id").isNull() | F.col("platform_name").isNull())


def best_matches(names: DataFrame, aliases: DataFrame, floor: float = REVIEW, k: int = 1) -> DataFrame:
    """entity_type, query, canonical_id, name, score: each query name's k best entities of its type from floor on.

    names: entity_type, query; aliases: entity_type, canonical_id, name. An entity counts by its best alias; ties go to
    the lesser id. Distinct normalised names meet in tiles of TILE_NAMES by TILE_NAMES, whatever their type's size; in a
    tile, only pairs are scored whose letter counts and lengths allow them to be among the best.
    """
    q, tiles = _tiles(names, aliases)
    found = tiles.groupBy("entity_type", "_block_q", "_block_a").applyInPandas(_matcher(floor, k), "entity_type string, _q string, canonical_id string, name string, score double")
    best = found.groupBy("entity_type", "_q", "canonical_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "name")).alias("m")) if k > 1 else found
    if k > 1:
        rank = F.row_number().over(Window.partitionBy("entity_type", "_q").orderBy("m.s", "canonical_id"))
        best = best.withColumn("_n", rank).where(F.col("_n") <= k).select("entity_type", "_q", "canonical_id", F.col("m.name").alias("name"), (-F.col("m.s")).alias("score"))
    else:
        one = F.min(F.struct((-F.col("score")).alias("s"), "canonical_id", "name")).alias("m")
        best = best.groupBy("entity_type", "_q").agg(one).select("entity_type", "_q", F.col("m.canonical_id").alias("canonical_id"), F.col("m.name").alias("name"), (-F.col("m.s")).alias("score"))
    return q.join(best, ["entity_type", "_q"]).select("entity_type", "query", "canonical_id", "name", "score")


def pairs_scored(names: DataFrame, aliases: DataFrame, floor: float = REVIEW, k: int = 1) -> DataFrame:
    """One row: pairs of distinct names of one type, and how many of them best_matches scores."""
    _, tiles = _tiles(names, aliases)
    counted = tiles.groupBy("entity_type", "_block_q", "_block_a").applyInPandas(_matcher(floor, k, count=True), "pairs long, scored long")
    return counted.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"), F.coalesce(F.sum("scored"), F.lit(0)).alias("scored"))


def _tiles(names: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    q = names.select("entity_type", "query", normal_name(F.col("query")).alias("_q")).distinct()
    a = aliases.select("entity_type", "canonical_id", "name", normal_name(F.col("name")).alias("_a")).distinct()
    asked = q.select("entity_type", "_q").distinct()
    blocks_q, blocks_a = (max(1, -(-df.count() // TILE_NAMES)) for df in (asked, a))
    block = lambda c, n: F.pmod(F.xxhash64(*c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("_block_q", block(["_q"], blocks_q)).withColumn("_block_a", every(blocks_a))
    right = a.withColumn("_block_a", block(["canonical_id", "_a"], blocks_a)).withColumn("_block_q", every(blocks_q))
    return q, left.unionByName(right, allowMissingColumns=True)


def _matcher(floor: float, k: int, count: bool = False):
    def match(pdf):
        import pandas as pd

        known, asked = pdf[pdf["_a"].notna()], pdf.loc[pdf["_a"].isna(), "_q"]
        index = NameIndex()
        for name, owner, label in known[["_a", "canonical_id", "name"]].itertuples(index=False):
            index.put(name, owner, label)
        out = [(pdf["entity_type"].iloc[0], q, owner, label, score) for q in asked for score, owner, label in index.best(q, floor, k)]
        if count:
            return pd.DataFrame([(len(known) * len(asked), index.scored)], columns=["pairs", "scored"])
        return pd.DataFrame(out, columns=["entity_type", "_q", "canonical_id", "name", "score"])

    return match


CANDIDATE = "array<struct<canonical_id:string,name:string,score:double>>"


def resolve(handles: DataFrame, aliases: DataFrame, entities: DataFrame, queue: DataFrame | None = None, merge: float = MERGE, review: float = REVIEW) -> dict[str, DataFrame]:
    """Resolve a batch of handles: platform, platform_id, platform_name, entity_type, created_at, id; for renames also
    new_platform_id and renamed_at.

    Returns resolved (handles with status matched, auto_merged, pending or created, canonical_id, confidence), the rows
    to append (new_entities, new_aliases, review_queue: one row a handle while pending, its 5 best candidates as of its
    turn, scores rounded to 4), and rebrands with their outcome (added, same, conflict, or unknown while the handle is
    pending). Handles go in the order of (created_at, id): a later one meets the aliases and names that earlier ones
    brought, so a second row of a new handle matches, and a rename counts from the next row on. Blank ids or names stop
    the job.

    Against the known aliases all handles are matched at once, over all tasks. What they make of each other depends on
    their order: one task decides BLOCK_ROWS of them, those without a known alias, in order, and meets only names that
    stand for an entity by then; the next block meets what those before it brought by joins and matches over all tasks.
    """
    blank = (F.coalesce(F.trim("platform_id"), F.lit("")) == "") | (F.coalesce(F.trim("platform_name"), F.lit("")) == "")
    optional = {"new_platform_id": "string", "renamed_at": "timestamp"}
    rows = handles.select(*HANDLE, *[(F.col(c) if c in handles.columns else F.lit(None).cast(kind)).alias(c) for c, kind in optional.items()])
    rows = rows.withColumn("platform_id", F.when(blank, F.raise_error(F.lit("a handle needs an id and a name")).cast("string")).otherwise(F.col("platform_id")))
    active = entities.where("is_active").select("canonical_id", "entity_type")
    exact = aliases.select("platform", "platform_id", F.col("canonical_id").alias("_exact"), F.col("confidence").alias("_confidence"))
    moved = aliases.select("platform", F.col("platform_id").alias("new_platform_id"), F.col("canonical_id").alias("_owner"))
    kinds = active.select(F.col("canonical_id").alias("_exact"), F.col("entity_type").alias("_kind"))
    rows = rows.join(exact, ["platform", "platform_id"], "left").join(moved, ["platform", "new_platform_id"], "left").join(kinds, "_exact", "left")
    rows = written(rows.select(*HANDLE, *optional, "_exact", "_confidence", "_kind", "_owner", normal_name(F.col("platform_name")).alias("_name")), "handles")
    known = aliases.join(active, "canonical_id").select("entity_type", "canonical_id", F.col("platform_name").alias("name"))
    open_rows = rows.where("_exact is null or new_platform_id is not null")
    n = open_rows.count()
    best = _best_of(open_rows.where("_exact is null"), known, review)
    waiting = open_rows.join(best, ["entity_type", "platform_name"], "left")
    blocks = -(-n // BLOCK_ROWS)
    if blocks > 1:
        waiting = written(waiting.repartitionByRange(blocks, "created_at", "id").withColumn("_block", F.spark_partition_id()), "waiting")
    else:
        waiting = waiting.withColumn("_block", F.lit(0))
    parts: list[DataFrame] = []
    for b in range(max(1, blocks)):
        block, listed = waiting.where(F.col("_block") == b), None
        if b:
            brought = _brought(reduce(DataFrame.unionByName, parts))
            block = _with_brought(block, brought, review)
        decided = written(block.groupBy("_block").applyInPandas(_decide(merge, review), _decided_schema(rows)), "decided")
        pending = decided.where("status = 'pending'")
        if not pending.isEmpty():
            names = known if not b else known.unionByName(brought.where("_kind is not null").select(F.col("_kind").alias("entity_type"), "canonical_id", "name"))
            listed = _listed(pending, names)
            decided = written(_with_listed(decided, listed), "listed")
        parts.append(decided)
    done = reduce(DataFrame.unionByName, parts)

    plain = rows.where("_exact is not null and new_platform_id is null").select(*HANDLE, F.lit("matched").alias("status"), F.col("_exact").alias("canonical_id"), F.col("_confidence").alias("confidence"))
    resolved = done.select(*HANDLE, "status", "canonical_id", "confidence").unionByName(plain)
    made = done.where("status = 'created'").select("canonical_id", "entity_type", F.lit(True).alias("is_active"), "created_at")
    named = done.where("status in ('created', 'auto_merged')").select("canonical_id", "platform", "platform_id", "platform_name", "confidence", F.col("created_at").alias("valid_from"))
    rounded = F.transform("candidates", lambda c: F.struct(c["canonical_id"].alias("canonical_id"), c["name"].alias("name"), F.round(c["score"], 4).alias("score")))
    review_rows = done.where("first_pending").select("platform", "platform_id", "platform_name", rounded.alias("candidates"), F.lit("fuzzy_band").alias("reason"), F.lit("pending").alias("status"), "created_at")
    # A handle may be pending in several blocks; its first row is the one for review.
    if blocks > 1:
        review_rows = review_rows.withColumn("_n", F.row_number().over(Window.partitionBy("platform", "platform_id").orderBy("created_at"))).where("_n = 1").drop("_n")
    if queue is not None:
        review_rows = review_rows.join(queue.where("status = 'pending'").select("platform", "platform_id"), ["platform", "platform_id"], "left_anti")
    moves = done.where("outcome is not null").select("platform", "platform_id", "new_platform_id", "platform_name", "renamed_at", "canonical_id", "outcome")
    return {"resolved": resolved, "new_entities": made, "new_aliases": named, "review_queue": review_rows, "rebrands": moves}


def _best_of(rows: DataFrame, known: DataFrame, review: float) -> DataFrame:
    """entity_type, platform_name, _best, _best_id of the names that are like a known one."""
    found = best_matches(rows.select("entity_type", F.col("platform_name").alias("query")), known, review)
    return found.select("entity_type", F.col("query").alias("platform_name"), F.col("score").alias("_best"), F.col("canonical_id").alias("_best_id"))


def _decided_schema(rows: DataFrame) -> str:
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*HANDLE, "new_platform_id", "renamed_at").schema]
    return ", ".join([*kept, "status string", "canonical_id string", "confidence double", "kind string", "outcome string", "first_pending boolean", f"candidates {CANDIDATE}"])


def _decide(merge: float, review: float):
    """A function of a block's rows: each in its turn, against what came with it and the names of the block so far."""
    kept = [*HANDLE, "new_platform_id", "renamed_at"]

    def decide(pdf):
        import pandas as pd

        given = lambda x: None if x is None or x is pd.NaT or x != x else x
        owners: dict[tuple, tuple] = {}  # (platform, id) -> entity, confidence, its type if its names count
        indices: dict[str, NameIndex] = {}
        asked: set[tuple] = set()
        out = []

        def stands(kind, row, canonical):
            if kind is not None:
                indices.setdefault(kind, NameIndex()).put(row.name, canonical, row.platform_name)

        for r in pdf.rename(columns=lambda c: c.lstrip("_")).sort_values(["created_at", "id"]).itertuples(index=False):
            key, near, first = (r.platform, r.platform_id), [], False
            exact, outcome, name = given(r.exact), None, r.name
            owner = owners.get(key) if exact is None else (exact, given(r.confidence), given(r.kind))
            if owner is not None:
                status, (canonical, score, kind) = "matched", owner
            else:
                kind = r.entity_type
                index = indices.get(kind)
                known, own = given(r.best), index.best(name, review) if index else []
                tops = [(-known, r.best_id)] if known is not None else []
                score, canonical = min(tops + [(-s, c) for s, c, _ in own], default=(0.0, None))
                score = -score
                if score >= merge:
                    status = "auto_merged"
                elif score >= review:
                    status, canonical = "pending", None
                    near = [{"canonical_id": c, "name": n, "score": s} for s, c, n in (index.best(name, 0.0, CANDIDATES) if index else [])]
                    first = key not in asked
                    asked.add(key)
                else:
                    status, score, canonical = "created", 1.0, entity_id(kind, *key)
                if canonical is not None:
                    owners[key] = (canonical, score, kind)
                    stands(kind, r, canonical)
            to = given(r.new_platform_id)
            if to is not None:
                has = owners.get((r.platform, to), (given(r.owner),))[0]
                outcome = "unknown" if canonical is None else "added" if has is None else "same" if has == canonical else "conflict"
                if outcome == "added":
                    owners[r.platform, to] = (canonical, 1.0, kind)
                    stands(kind, r, canonical)
            out.append((*(getattr(r, c) for c in kept), status, canonical, score, kind, outcome, first, near))
        return pd.DataFrame(out, columns=[*kept, "status", "canonical_id", "confidence", "kind", "outcome", "first_pending", "candidates"])

    return decide


def _brought(done: DataFrame) -> DataFrame:
    """platform, platform_id, canonical_id, name, _confidence, _kind: the aliases that decided rows brought."""
    own = done.where("status in ('created', 'auto_merged')").select("platform", "platform_id", "canonical_id", F.col("platform_name").alias("name"), F.col("confidence").alias("_confidence"), F.col("kind").alias("_kind"))
    moved = done.where("outcome = 'added'").select("platform", F.col("new_platform_id").alias("platform_id"), "canonical_id", F.col("platform_name").alias("name"), F.lit(1.0).alias("_confidence"), F.col("kind").alias("_kind"))
    return own.unionByName(moved)


def _with_brought(block: DataFrame, brought: DataFrame, review: float) -> DataFrame:
    """A block's rows with what earlier blocks brought: exact owners, owners of new ids, and better matches."""
    exact = brought.select("platform", "platform_id", F.col("canonical_id").alias("_e"), F.col("_confidence").alias("_c"), F.col("_kind").alias("_k"))
    moved = brought.select("platform", F.col("platform_id").alias("new_platform_id"), F.col("canonical_id").alias("_o"))
    names = brought.where("_kind is not null").select(F.col("_kind").alias("entity_type"), "canonical_id", "name")
    best = _best_of(block.where("_exact is null"), names, review).withColumnsRenamed({"_best": "_b", "_best_id": "_i"})
    both = block.join(exact, ["platform", "platform_id"], "left").join(moved, ["platform", "new_platform_id"], "left").join(best, ["entity_type", "platform_name"], "left")
    top = F.least(*[F.when(F.col(s).isNotNull(), F.struct((-F.col(s)).alias("s"), F.col(i).alias("i"))) for s, i in (("_best", "_best_id"), ("_b", "_i"))])
    new = {"_confidence": F.when(F.col("_exact").isNull(), F.col("_c")).otherwise(F.col("_confidence")), "_kind": F.when(F.col("_exact").isNull(), F.col("_k")).otherwise(F.col("_kind")), "_exact": F.coalesce("_exact", "_e"), "_owner": F.coalesce("_owner", "_o"), "_best": -top["s"], "_best_id": top["i"]}
    return both.select(*[new.get(c, F.col(c)).alias(c) for c in block.columns])


def _listed(pending: DataFrame, names: DataFrame) -> DataFrame:
    """entity_type, platform_name, _list: the best candidates of pending names among the names from before their block."""
    top = best_matches(pending.select("entity_type", F.col("platform_name").alias("query")), names, 0.0, CANDIDATES)
    entry = F.struct("canonical_id", "name", "score")
    return top.groupBy("entity_type", F.col("query").alias("platform_name")).agg(F.collect_list(entry).alias("_list"))


def _with_listed(decided: DataFrame, listed: DataFrame) -> DataFrame:
    """Candidates of pending rows from both lists: an entity once, by its best name, at most CANDIDATES, best first."""
    both = F.concat(F.coalesce("candidates", F.array().cast(CANDIDATE)), F.coalesce("_list", F.array().cast(CANDIDATE)))
    order = F.array_sort(F.transform(both, lambda c: F.struct((-c["score"]).alias("s"), c["canonical_id"].alias("canonical_id"), c["name"].alias("name"))))
    once = F.filter(order, lambda c, i: ~F.exists(F.slice(order, 1, i), lambda e: e["canonical_id"] == c["canonical_id"]))
    best = F.slice(F.transform(once, lambda c: F.struct(c["canonical_id"].alias("canonical_id"), c["name"].alias("name"), (-c["s"]).alias("score"))), 1, CANDIDATES)
    joined = decided.join(listed, ["entity_type", "platform_name"], "left").withColumn("candidates", F.when(F.col("status") == "pending", best).otherwise(F.col("candidates")))
    return joined.select(*decided.columns)


def rebrands(moves: DataFrame, aliases: DataFrame) -> DataFrame:
    """moves (platform, platform_id, new_platform_id, platform_name, renamed_at) with canonical_id and outcome.

    added: the new id becomes an alias of the old one's entity from renamed_at on; same: it already is; conflict: it
    belongs to another entity; unknown: the old id has no alias.
    """
    old = aliases.select("platform", "platform_id", F.col("canonical_id").alias("_old"))
    new = aliases.select("platform", F.col("platform_id").alias("new_platform_id"), F.col("canonical_id").alias("_new"))
    both = moves.join(old, ["platform", "platform_id"], "left").join(new, ["platform", "new_platform_id"], "left")
    outcome = F.when(F.col("_old").isNull(), "unknown").when(F.col("_new").isNull(), "added").when(F.col("_new") == F.col("_old"), "same").otherwise("conflict")
    return both.withColumn("outcome", outcome).withColumn("canonical_id", F.col("_old")).drop("_old", "_new")


def drain(staging: DataFrame, aliases: DataFrame, entities: DataFrame, queue: DataFrame | None = None, limit: int | None = None, now: str | None = None, extract=extract_handles) -> dict[str, DataFrame]:
    """Pending staging rows, oldest first, through extraction, resolution and rebrands.

    Returns resolve()'s tables, staging after the pass (processed, review, or pending for misses; other rows
    untouched) and rebrand_aliases. Misses stay in the queue and don't count against limit, so that they never hold it
    up. extract is a function of DataFrames.
    """
    waiting = staging.where("status = 'pending'")
    found = extract(waiting, now=now) if extract is extract_handles else extract(waiting)
    found = found.where("not miss")
    if limit is not None:
        found = found.orderBy("created_at", "id").limit(limit)
    out = resolve(found.select(*HANDLE, "new_platform_id", "renamed_at"), aliases, entities, queue)
    done = out["resolved"].select("id", F.col("status").alias("_status"), F.col("canonical_id").alias("_canonical"))
    after = staging.join(done, "id", "left").withColumn("canonical_id", F.coalesce("_canonical", "canonical_id"))
    out["staging"] = after.withColumn("status", F.when(F.col("_status").isNull(), F.col("status")).when(F.col("_status") == "pending", "review").otherwise("processed")).select(*staging.columns)
    out["rebrand_aliases"] = out["rebrands"].where("outcome = 'added'").select("canonical_id", "platform", F.col("new_platform_id").alias("platform_id"), "platform_name", F.lit(1.0).alias("confidence"), F.col("renamed_at").alias("valid_from"))
    return out


def oldest_pending_review(queue: DataFrame) -> DataFrame:
    rest = [c for c in queue.columns if c not in ("platform", "platform_id")]
    return queue.where("status = 'pending'").groupBy("platform", "platform_id").agg(F.min_by(F.struct(*rest), "created_at").alias("_r")).select("platform", "platform_id", "_r.*")


def blocked_matches(left: DataFrame, right: DataFrame, name: str = "name", prefix: int = 2, likely: float = 0.92, possible: float = 0.78, exact_bonus: float = 0.85, country: str | None = None, country_bonus: float = 0.05) -> DataFrame:
    """left_id, right_id, score, verdict (match, review) of names that share their first characters.

    Score: Jaro-Winkler of the lower-cased names if at least likely, exact_bonus at least if they are equal, plus a
    bonus for the same country, at most 1. Names are compared within their block only. A block with many names is cut
    into tiles of TILE_NAMES distinct names a side; in a tile, only pairs are scored whose letters allow the score.
    """
    cut = lambda df, side: df.select(F.col("id").alias(f"{side}_id"), F.lower(name).alias(f"{side}_name"), *([F.col(country).alias(f"{side}_country")] if country else [])).where(F.col(f"{side}_name").isNotNull())
    first, second = cut(left, "left"), cut(right, "right")
    names = lambda df, side: df.select(F.substring(f"{side}_name", 1, prefix).alias("_block"), F.col(f"{side}_name").alias("_name")).distinct()
    one, two = names(first, "left"), names(second, "right")
    parts = lambda df, c: df.groupBy("_block").agg(F.ceil(F.count(F.lit(1)) / TILE_NAMES).cast("int").alias(c))
    sizes = parts(one, "_m").join(parts(two, "_n"), "_block")
    part = lambda c: F.pmod(F.xxhash64("_name"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    dealt = one.join(sizes, "_block").select("_block", "_name", part("_m").alias("_i"), every("_n").alias("_j"), F.lit(True).alias("_left"))
    tiles = dealt.unionByName(two.join(sizes, "_block").select("_block", "_name", every("_m").alias("_i"), part("_n").alias("_j"), F.lit(False).alias("_left")))
    floor = possible - (country_bonus if country else 0.0)

    def match(pdf):
        import pandas as pd

        index, out = WinklerIndex(), []
        for n in pdf.loc[~pdf["_left"], "_name"]:
            index.add(n)
        for n in pdf.loc[pdf["_left"], "_name"]:
            out += [(n, index.names[i], score) for i, score in index.near(n, floor)]
        return pd.DataFrame(out, columns=["left_name", "right_name", "_jw"])

    # Many blocks are small: a task takes as many as its share of the exchange has.
    pairs = tiles.groupBy("_block", "_i", "_j").applyInPandas(match, "left_name string, right_name string, _jw double")
    rows = first.join(pairs, "left_name").join(second, "right_name").withColumn("score", F.greatest(F.col("_jw"), F.when(F.col("left_name") == F.col("right_name"), F.lit(exact_bonus))))
    if country:
        rows = rows.withColumn("score", F.least(F.lit(1.0), F.col("score") + F.when(F.col("left_country") == F.col("right_country"), country_bonus).otherwise(0.0)))
    verdict = F.when(F.col("score") >= likely, "match").when(F.col("score") >= possible, "review")
    return rows.withColumn("verdict", verdict).where("verdict is not null").select("left_id", "right_id", "score", "verdict")
