"""Scans and sinks: CSV, JSON landings, event logs, file trees, snapshots of JSON."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import split_bad


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with a header, every column as text; a byte-order mark is dropped and blank cells are NULL."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).option("header", True).csv(path)


def since(rows: DataFrame, ts: str, floor: Column | None, keep_null: bool = True, inclusive: bool = False) -> DataFrame:
    """Rows later than the floor (or at it); rows without a time stay where the source has no times for some."""
    if floor is None:
        return rows
    later = F.col(ts) >= floor if inclusive else F.col(ts) > floor
    return rows.where(F.col(ts).isNull() | later if keep_null else later)


def read_landing(spark: SparkSession, path: str, schema: str, ts: str | None = None, floor: Column | None = None) -> DataFrame:
    rows = spark.read.schema(schema).json(path)
    return since(rows, ts, floor) if ts else rows


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def keyed(rows: DataFrame, **equal) -> DataFrame:
    """Rows by equality, or membership for lists; the filters reach the scan."""
    for c, v in equal.items():
        rows = rows.where(F.col(c).isin(v) if isinstance(v, (list, tuple, set)) else F.col(c) == v)
    return rows


def file_tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def write_json_documents(rows: DataFrame, root: str, number: int, partition: str = "language") -> None:
    """One JSON line a row, partitioned, beside all that is stored; number rises from write to write.

    Nothing is taken away: a document that was written before is superseded for readers, its neighbours stay. A write
    that is done again under its number replaces what it wrote.
    """
    rows.write.mode("overwrite").partitionBy(partition).json(f"{root}/write={number}")


def read_json_documents(spark: SparkSession, root: str, schema: str, key: str) -> DataFrame:
    """The latest document of each key; schema includes the partition column."""
    from ..operators.merge import latest_per_key

    return latest_per_key(spark.read.schema(f"{schema}, write long").json(root), [key], "write").drop("write")


#: Kinds of the typed event log and the fields of their payloads; a caller may pass its own.
EVENT_KINDS = {
    "match_played": "match_id string, winner_id string, loser_id string",
    "player_signed": "player_id string, team_id string, salary_cents bigint",
    "player_released": "player_id string, team_id string",
    "prize_awarded": "team_id string, amount_cents bigint",
    "patch_released": "patch_version string",
    "tournament_started": "tournament_id string",
    "tournament_ended": "tournament_id string, winner_id string",
    "relationship_changed": "src_id string, dst_id string, delta double",
}


def read_events(lines: DataFrame, kinds: dict[str, str] = EVENT_KINDS, column: str = "value") -> tuple[dict[str, DataFrame], DataFrame]:
    """(rows of each kind: id, kind, ts and its own fields, quarantine: lines of unknown kind or bad shape)."""
    envelope = F.from_json(F.col(column), "id string, kind string, ts string")
    rows = lines.select(F.col(column).alias("line"), envelope.alias("e"))
    typed = {}
    bad = F.coalesce(F.col("e.id").isNull() | ~F.col("e.kind").isin(list(kinds)), F.lit(True))
    for kind, schema in kinds.items():
        body = F.from_json("line", schema)
        typed[kind] = rows.where(~bad & (F.col("e.kind") == kind)).select(F.col("e.id").alias("id"), F.col("e.kind").alias("kind"), F.try_to_timestamp(F.col("e.ts")).alias("ts"), body.alias("b")).select("id", "kind", "ts", "b.*")
    return typed, rows.where(bad).select("line")


@dataclass(frozen=True)
class SourceSpec:
    """How a source's payloads are checked and turned into records; fetching them is not this library's part.

    schema: of the payload JSON. checks: conditions of being bad, over the column p and the raw payload. transform:
    good rows (source, payload, p, ...) -> records (source, entity_type, payload, ...).
    """

    name: str
    schema: str
    checks: Callable[[], dict[str, Column]]
    transform: Callable[[DataFrame], DataFrame]
    transient: Callable[[], Column] = field(default=lambda: F.lit(False))

    def validate(self, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(good, drift); corrupt JSON is drift."""
        parsed = raw.withColumn("p", F.from_json("payload", f"{self.schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}))
        return split_bad(parsed, {"corrupt": F.col("p").isNull() | F.col("p._corrupt").isNotNull(), **self.checks()})


def _origin(good: DataFrame) -> list[str]:
    """What tells when a record came, as far as the payloads have it."""
    return [c for c in ("source", "fetched_at", "content_hash") if c in good.columns]


#: Fixed values of the source.
PAGE_TYPES = ("stats", "matches", "rankings")


def page_payload_spec() -> SourceSpec:
    """Parsed page payloads: known page_type, and rows as a list of objects with entity_type, site_id and name."""
    rows = F.col("p.rows")
    return SourceSpec(
        "pages", "page_type string, url string, rows array<struct<entity_type:string,site_id:string,name:string>>",
        lambda: {"page_type": ~F.coalesce(F.col("p.page_type").isin(list(PAGE_TYPES)), F.lit(False)), "url": F.col("p.url").isNull(), "rows": rows.isNull(), "row_keys": ~F.forall(rows, lambda r: r["entity_type"].isNotNull() & r["site_id"].isNotNull() & r["name"].isNotNull())},
        lambda good: good.select(*_origin(good), F.posexplode("p.rows").alias("pos", "r")).select(*_origin(good), "pos", F.col("r.entity_type").alias("entity_type"), F.concat_ws("-", "r.entity_type", "r.site_id").alias("platform_id"), F.col("r.name").alias("platform_name")),
    )


#: Fixed value: the fields of match JSON that are read.
MATCH_SCHEMA = (
    "matchInfo struct<matchId:string,mapId:string,gameVersion:string,gameLengthMillis:bigint,gameStartMillis:bigint,queueId:string,seasonId:string,isCompleted:boolean>, "
    "players array<struct<puuid:string,gameName:string,tagLine:string,teamId:string,characterId:string,stats:struct<score:int,kills:int,deaths:int,assists:int>>>, "
    "roundResults array<struct<roundNum:int,roundResult:string,winningTeam:string,playerStats:array<struct<puuid:string,score:int>>>>"
)


def match_spec() -> SourceSpec:
    """Match JSON: matchInfo, a list of players, a list of rounds."""
    return SourceSpec("match", MATCH_SCHEMA, lambda: {"match_info": F.col("p.matchInfo").isNull(), "players": F.col("p.players").isNull(), "rounds": F.col("p.roundResults").isNull()}, match_players)


def match_players(good: DataFrame) -> DataFrame:
    """One row per player with a full identity (puuid, name, tag), with the rounds as that player saw them."""
    from ..functions.parse import slim_rounds

    each = good.select(*_origin(good), "p", F.posexplode("p.players").alias("pos", "q"))
    full = each.where("q.puuid is not null and q.puuid != '' and q.gameName is not null and q.gameName != '' and q.tagLine is not null and q.tagLine != ''")
    return full.select(
        *_origin(good), "pos", F.lit("player").alias("entity_type"), F.col("q.puuid").alias("platform_id"), F.concat_ws("#", "q.gameName", "q.tagLine").alias("platform_name"),
        F.col("p.matchInfo.matchId").alias("match_id"), F.col("q.teamId").alias("team_id"), F.col("q.characterId").alias("agent"), F.col("q.stats").alias("stats"),
        slim_rounds(F.col("p.roundResults"), F.col("q.puuid")).alias("rounds"),
    )


def incomplete_players(good: DataFrame) -> DataFrame:
    """One row: how many players had no full identity."""
    missing = lambda q: F.coalesce(q["puuid"], F.lit("")).eqNullSafe("") | F.coalesce(q["gameName"], F.lit("")).eqNullSafe("") | F.coalesce(q["tagLine"], F.lit("")).eqNullSafe("")
    return good.agg(F.coalesce(F.sum(F.size(F.filter("p.players", missing))), F.lit(0)).alias("dropped"))
