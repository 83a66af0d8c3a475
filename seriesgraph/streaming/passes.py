"""Streamed passes: payloads that arrive are deduplicated, resolved and staged, batch by batch and each batch at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse
from ..operators import spend
from ..plans.ingest import ingest
from ..sources.tables import SourceSpec

#: Tables of a streamed pass and their columns; payloads that drift and handles for review are kept as well.
PASS_TABLES = {
    "raw": "source string, fetched_at timestamp, payload string, content_hash string",
    "drift": "source string, payload string, content_hash string, violations array<string>",
    "aliases": "canonical_id string, platform string, platform_id string, platform_name string, confidence double, valid_from timestamp",
    "entities": "canonical_id string, entity_type string, is_active boolean, created_at timestamp",
    "review": "platform string, platform_id string, platform_name string, candidates array<struct<canonical_id:string,name:string,score:double>>, reason string, status string, created_at timestamp",
    "staging": "id string, entity_type string, canonical_id string, platform string, platform_id string, status string",
}
LEDGER = "id string, timestamp timestamp_ntz, purpose string, phase string, usd_cost double"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class BatchTables:
    """Tables in one folder that grow batch by batch; readers see a batch in all of them or in none.

    Each table has a folder a batch. When all are written, one small file says so, and only batches up to the last such
    file are read. A batch that was cut off is written again from the start; one that was finished is left alone.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str, schema: str, partitions: str = "") -> DataFrame:
        full = f"{schema}, batch long" + (f", {partitions}" if partitions else "")
        try:
            return self.spark.read.schema(full).option("basePath", f"{self.root}/{name}").parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], full)

    def last(self) -> int:
        """The last finished batch, -1 without one."""
        found = self._read("finished", "number long").agg(F.max("number")).first()[0]
        return -1 if found is None else found

    def read(self, name: str, schema: str, partitions: str = "") -> DataFrame:
        """A table's rows of finished batches, without the batch; partitions: further columns that it is dealt by."""
        return self._read(name, schema, partitions).where(F.col("batch") <= self.last()).drop("batch")

    def put(self, name: str, batch: int, rows: DataFrame, by: list[str] = []) -> DataFrame:
        """Write a batch's rows of a table, not yet to be seen; what an attempt before wrote goes. Returns them read back."""
        path = f"{self.root}/{name}/batch={batch}"
        rows.write.mode("overwrite").partitionBy(*by).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def finish(self, batch: int) -> None:
        self.put("finished", batch, self.spark.createDataFrame([(batch,)], "number long").coalesce(1))


def unseen(stream: DataFrame) -> DataFrame:
    """A stream of payloads (source, fetched_at, payload), each content once, with content_hash.

    What was seen lies in the stream's keyed state, dealt to tasks by hash and held in RocksDB: a batch looks up its own
    hashes and reads no history. The state goes with the checkpoint, so a batch that is run again has the same rows.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    hashed = stream.withColumn("content_hash", parse.content_hash(F.col("source"), F.col("payload")))
    return hashed.dropDuplicates(["source", "content_hash"])


def staging_pass(tables: BatchTables, spec: SourceSpec) -> Callable[[DataFrame, int], None]:
    """For foreachBatch over unseen(): validate, resolve and stage a batch's payloads against what earlier ones left.

    A batch's tables (PASS_TABLES) are finished together. Transient payloads are not kept, as in the batch pass; a
    source must deliver them anew with another content to be tried again.
    """
    nothing = tables.spark.createDataFrame([], "source string, content_hash string")

    def each(batch: DataFrame, number: int) -> None:
        if number <= tables.last():
            return
        # The stream's own plan, with its state, runs once; all else reads what it wrote.
        landed = tables.put("landed", number, batch.select("source", "fetched_at", "payload"))
        known = {name: tables.read(name, schema) for name, schema in PASS_TABLES.items()}
        out = ingest(landed, spec, nothing, known["aliases"], known["entities"], known["review"])
        for name, rows in (("raw", out["raw_records"]), ("drift", out["drift"]), ("entities", out["new_entities"]), ("aliases", out["new_aliases"]), ("review", out["review_queue"]), ("staging", out["staging"])):
            kinds = {f.name: f.dataType for f in known[name].schema}
            tables.put(name, number, rows.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()]))
        tables.finish(number)

    return each


def trailing_pass(tables: BatchTables) -> Callable[[DataFrame, int], None]:
    """For foreachBatch over calls (LEDGER): each with its exact trailing spend and breach, in the table audit.

    The ledger is dealt by day, so a batch reads only the seven days before its first call. A call counts those that
    came up to its batch; one that comes late changes no earlier answer.
    """

    def each(batch: DataFrame, number: int) -> None:
        if number <= tables.last():
            return
        names = [c.split()[0] for c in LEDGER.split(", ")]
        day = F.to_date("timestamp").alias("day")
        own = tables.put("ledger", number, batch.select(*names, day), ["day"])
        first = own.agg(F.min("timestamp").alias("t")).first()[0]
        before = tables.read("ledger", LEDGER, "day date")
        recent = before.where(F.col("day") >= F.date_sub(F.to_date(F.lit(first)), 8)) if first is not None else before.limit(0)
        both = recent.select(*names, F.lit(False).alias("_own")).unionByName(own.select(*names, F.lit(True).alias("_own")))
        audit = spend.audit_caps(both).where("_own").select("id", "timestamp", "purpose", "purpose_trailing", "total_trailing", "breach")
        tables.put("audit", number, audit)
        tables.finish(number)

    return each
