"""Whole passes over sources: landing to staging, articles to notes, map CSV to facts, match pages to player stats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse
from ..operators import merge, resolve
from ..operators.quality import violations
from ..sources import pages as page_source
from ..sources.shared import whole_if_small, written
from ..sources.tables import SourceSpec

#: Fixed values of the source: the columns of its CSV.
INT_COLUMNS = ["Team1 Rounds", "Team2 Rounds", "Team1 Atk Rounds", "Team1 Def Rounds", "Team2 Atk Rounds", "Team2 Def Rounds", "Map"]
TEAM_FIELDS = ["ACS", "Kills", "Deaths", "Assists", "DeltaK/D", "KAST", "ADR", "HS", "FK", "FD", "DeltaFK/FD", "Pistols", "EcosWon", "Ecos", "Semibuys Won", "Semibuys", "Fullbuys Won", "Fullbuys"]
CSV_COLUMNS = ["MatchID", "GameID", "EventID", "Date", "Team1ID", "Team2ID", "Team1 Name", "Team2 Name", "Event Name", "Series Odds", "Team1 Map Odds", *INT_COLUMNS, *[f"Team{t} {f}" for t in (1, 2) for f in TEAM_FIELDS], "VOD Link"]
#: Fixed values of the source: a date that stands for none, ids that name nothing.
SENTINEL_DATES, NULL_IDS = ["1970-01-01"], ["0", ""]
#: Fixed value: the cells of a match page's player row, in order; the first two name the player and the agent.
STAT_COLUMNS = ["player", "agent", "rating", "acs", "kills", "deaths", "assists", "kd_diff", "kast_pct", "adr", "hs_pct", "first_kills", "first_deaths", "fk_diff"]


def ingest(raw: DataFrame, spec: SourceSpec, seen: DataFrame, aliases: DataFrame, entities: DataFrame, queue: DataFrame | None = None) -> dict[str, DataFrame]:
    """One pass over a source's raw payloads (source, fetched_at, payload).

    Payloads whose hash is known are skipped, of equal ones the first fetched counts; ok and drifting ones are kept raw, transient ones are not, so that they
    are tried again; records of the good ones are resolved and staged under deterministic ids, one after another by
    fetched_at, payload and place in it (fetched_at and pos, where the records have them). Returns raw_records, drift,
    staging, resolve()'s tables, and stats (one row of counts).
    """
    hashed = raw.withColumn("content_hash", parse.content_hash(F.col("source"), F.col("payload")))
    new = written(merge.append_unseen(seen, hashed, ["source", "content_hash"], "fetched_at").withColumn("transient", spec.transient()), "new")
    good, drift = spec.validate(new.where("not transient"))
    records = written(spec.transform(good), "records")
    keyed = records.withColumn("id", merge.surrogate_id(F.col("source"), F.col("entity_type"), F.col("platform_id"), F.col("platform_name")))
    has = lambda c, kind, other: F.coalesce(F.col(c).cast(kind), other) if c in records.columns else other
    keyed = keyed.withColumn("created_at", has("fetched_at", "timestamp", F.lit("1970-01-01").cast("timestamp")))
    # The id that orders: payload, place in it, and last the staging id.
    place = F.concat_ws(":", has("content_hash", "string", F.lit("")), F.lpad(has("pos", "string", F.lit("0")), 9, "0"), "id")
    keyed = keyed.withColumn("id", place)
    platform = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in resolve.PLATFORMS.items() for x in kv]), F.col("source")), F.col("source"))
    out = resolve.resolve(keyed.withColumn("platform", platform).select("platform", "platform_id", "platform_name", "entity_type", "created_at", "id").distinct(), aliases, entities, queue)
    out["raw_records"] = new.where("not transient").select("source", "fetched_at", "payload", "content_hash")
    out["drift"] = drift.select("source", "payload", "content_hash", "violations")
    status = F.when(F.col("status") == "pending", "review").otherwise("processed")
    out["resolved"] = out["resolved"].withColumn("id", F.substring_index("id", ":", -1))
    out["staging"] = out["resolved"].select("id", "entity_type", "canonical_id", "platform", "platform_id", status.alias("status")).dropDuplicates(["id"])
    counts = [raw.agg(F.count(F.lit(1)).alias("fetched")), new.agg(F.count(F.lit(1)).alias("new"), F.count_if("transient").alias("transient")), drift.agg(F.count(F.lit(1)).alias("drift")), records.agg(F.count(F.lit(1)).alias("records"))]
    out["stats"] = reduce(DataFrame.crossJoin, counts).withColumn("duplicate", F.col("fetched") - F.col("new"))  # one row each
    return out


def ingest_articles(pages: DataFrame, stored: DataFrame, source: str, fetched_at: str) -> tuple[DataFrame, DataFrame]:
    """(notes after the pass with outcomes, drifting pages); fetched_at moves even where nothing else changed."""
    read = page_source.articles(pages).join(pages.select("page_id", "url", F.col("html").alias("raw_html")), "page_id")
    notes = read.where("not drift").select(F.lit(source).alias("source"), "patch_version", "published_at", "raw_html", "body_text", "url", F.lit(fetched_at).cast("timestamp").alias("fetched_at"))
    one = merge.first_per_key(notes, ["source", "patch_version"], [F.desc("published_at"), F.col("url")])
    return merge.upsert(stored, one.select(*stored.columns), ["source", "patch_version"], touched=["fetched_at"]), read.where("drift")


def seed_maps(rows: DataFrame, matches: DataFrame, maps: DataFrame, order: list[str] = ["Date", "MatchID", "GameID"]) -> dict[str, DataFrame]:
    """A map-level CSV (all text) into entities, matches, maps and a quarantine.

    Entities come first, from every row without a sentinel date, malformed ones included; the last name in order is a
    team's name. A match is its first row that is valid in full; later rows of a known match need no date. Repeated
    game ids keep the first; known matches and games are not touched; nothing is matched by likeness.
    """
    rows = rows.where(~F.coalesce("Date", F.lit("")).isin(SENTINEL_DATES))
    real = lambda c: F.when(~F.coalesce(F.trim(c), F.lit("")).isin(NULL_IDS), F.trim(c))
    at = F.struct(*order)
    sides = rows.select(F.explode(F.array(*[F.struct(real(f"Team{t}ID").alias("n"), F.col(f"Team{t} Name").alias("name"), at.alias("at"), F.lit(t).alias("t")) for t in (1, 2)])).alias("s")).where("s.n is not null")
    teams = sides.groupBy(F.col("s.n").alias("n")).agg(F.max_by("s.name", F.struct("s.at", "s.t")).alias("name")).select(F.lit("team").alias("entity_type"), F.col("n").alias("site_id"), "name")
    events = rows.select(real("EventID").alias("site_id"), F.col("Event Name").alias("name"), at.alias("at")).where("site_id is not null").groupBy("site_id").agg(F.max_by("name", "at").alias("name")).select(F.lit("tournament").alias("entity_type"), "site_id", "name")
    entities = teams.unionByName(events).withColumn("platform_id", parse.namespaced(F.col("entity_type"), F.col("site_id"))).withColumn("canonical_id", merge.surrogate_id(F.lit("site"), F.col("platform_id")))

    known = matches.select(F.col("site_match_id").alias("MatchID"), F.lit(True).alias("_known"))
    ints = {c: parse.whole_int(F.col(c)) for c in INT_COLUMNS}
    checks = {"no_match_id": F.coalesce(F.trim("MatchID"), F.lit("")) == "", "no_game_id": F.coalesce(F.trim("GameID"), F.lit("")) == "", **{f"not_whole:{c}": v.isNull() for c, v in ints.items()}}
    shaped = rows.withColumn("violations", violations(checks)).withColumn("_date", parse.iso_date(F.col("Date"))).join(known, "MatchID", "left")
    fine = F.size("violations") == 0
    first = shaped.where(fine & F.col("_date").isNotNull()).groupBy("MatchID").agg(F.min(at).alias("_first"))
    shaped = written(shaped.join(first, "MatchID", "left"), "shaped")
    # A row without a date may follow the row that made its match, or belong to a match that was known before.
    usable = fine & (F.col("_known").isNotNull() | F.col("_date").isNotNull() | (F.col("_first") < at))
    bad = shaped.where(~F.coalesce(usable, F.lit(False))).withColumn("violations", F.when(fine, F.array(F.lit("bad_date"))).otherwise(F.col("violations"))).select(*rows.columns, "violations")
    good = shaped.where(usable)
    fk = lambda c, kind: F.when(real(c).isNotNull(), merge.surrogate_id(F.lit("site"), parse.namespaced(F.lit(kind), real(c))))
    made = good.where(F.col("_known").isNull() & F.col("_date").isNotNull()).withColumn("_n", at)
    new_matches = merge.first_per_key(made, ["MatchID"], ["_n"]).select(
        merge.surrogate_id(F.lit("match"), F.col("MatchID")).alias("match_id"), F.col("MatchID").alias("site_match_id"), F.col("_date").alias("match_date"),
        fk("Team1ID", "team").alias("team1"), fk("Team2ID", "team").alias("team2"), fk("EventID", "tournament").alias("tournament"), parse.permissive_double(F.col("Series Odds")).alias("odds"),
    )
    bag = lambda t: F.map_from_arrays(F.array(*[F.lit(f) for f in TEAM_FIELDS]), F.array(*[parse.permissive_double(F.col(f"Team{t} {f}")) for f in TEAM_FIELDS]))
    games = good.withColumn("_n", at).select(
        merge.surrogate_id(F.lit("map"), F.col("GameID")).alias("map_result_id"), F.col("GameID").alias("site_game_id"), merge.surrogate_id(F.lit("match"), F.col("MatchID")).alias("match_id"),
        *[parse.whole_int(F.col(c)).alias(c.lower().replace(" ", "_")) for c in INT_COLUMNS], bag(1).alias("team1_stats"), bag(2).alias("team2_stats"), "_n",
    )
    new_maps = merge.insert_absent(maps, games, ["site_game_id"], ["_n"]).drop("_n")
    return {"entities": entities, "matches": new_matches, "maps": new_maps, "quarantine": bad}


def backfill_stats(match_pages: DataFrame, maps: DataFrame, aliases: DataFrame, stored: DataFrame) -> dict[str, DataFrame]:
    """Player stats of match pages (page_id, html): for known maps and players known by their namespaced id; first writer wins.

    Returns stats (rows to append), drift (rows with another number of cells), unknown_maps, unresolved.
    """
    rows = written(page_source.stat_rows(match_pages), "stat_rows")
    known = rows.where("not drift").join(maps.select(F.col("site_game_id").alias("game_id"), "map_result_id"), "game_id", "left")
    # A player's rows may be most of all, so few players go whole to the rows.
    players = whole_if_small(written(aliases.where("platform = 'vlr'").select("platform_id", "canonical_id"), "players"))
    found = known.where("map_result_id is not null").withColumn("platform_id", parse.namespaced(F.lit("player"), F.col("player_id"))).join(players, "platform_id", "left")
    number = {"kast_pct": parse.percent, "hs_pct": parse.percent}
    whole = ("kills", "deaths", "assists", "first_kills", "first_deaths")
    value = lambda i, c: (lambda x: number[c](x) if c in number else parse.whole_int(x, True) if c in whole else parse.permissive_double(x, True))(F.element_at("cells", i + 1))
    wanted = [(i, c) for i, c in enumerate(STAT_COLUMNS) if c in ("rating", "acs", "adr", *number, *whole)]
    stats = found.where("canonical_id is not null").select("map_result_id", F.col("canonical_id").alias("entity_id"), F.col("side").alias("team_side"), "agent", *[value(i, c).alias(c) for i, c in wanted], "page_id")
    return {"stats": merge.insert_absent(stored, stats, ["map_result_id", "entity_id"], ["page_id"]).drop("page_id"), "drift": rows.where("drift"), "unknown_maps": known.where("map_result_id is null"), "unresolved": found.where("canonical_id is null")}
