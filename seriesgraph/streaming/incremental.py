"""Incremental forms: landings that arrive, exact deduplication by batch, edges that evolve, spend by windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import parse
from ..functions.formulas import DECAY_RATES

EDGE_STATE = "strength double, sentiment double, at_micros long"
EDGE_UPDATE = "edge_id string, strength double, sentiment double, at_micros long, events int, late int"


def read_landing_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """New JSON files of a landing; the checkpoint stands for the floor of a poll."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Everything that has arrived, then stop."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_raw(raw_path: str, then: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: keep payloads (source, fetched_at, payload) whose hash the table does not have yet.

    A batch writes its own partition with overwrite and compares with the other batches' only, so a batch that is
    replayed after a failure writes the same rows again and changes nothing.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("content_hash", parse.content_hash(F.col("source"), F.col("payload"))).dropDuplicates(["source", "content_hash"])
        try:
            seen = spark.read.parquet(raw_path).where(F.col("batch") != number).select("source", "content_hash")
            rows = rows.join(seen, ["source", "content_hash"], "left_anti")
        except AnalysisException as error:  # the first batch finds no table
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        rows.write.mode("overwrite").parquet(f"{raw_path}/batch={number}")
        if then is not None:
            then(spark.read.parquet(f"{raw_path}/batch={number}"), number)

    return each


def distinct_within(stream: DataFrame, delay: str = "1 day", ts: str = "fetched_at") -> DataFrame:
    """Deduplication with bounded state: copies that arrive within the delay of each other are dropped."""
    hashed = stream.withColumn("content_hash", parse.content_hash(F.col("source"), F.col("payload")))
    return hashed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["source", "content_hash"])


def evolve_edges(events: DataFrame, rates: dict[str, float] = DECAY_RATES) -> DataFrame:
    """A stream of events (edge_id, edge_type, event_id, occurred_at, delta_strength, delta_sentiment) -> edges as they evolve.

    State is an edge's strength, sentiment and time: decay up to each event, add its deltas, hold to the ranges, in the
    order of (occurred_at, event_id); every event of one instant counts. Events before the edge's time are counted as
    late and left to the batch fold. New edges begin at zero.
    """
    prepared = events.select("edge_id", "edge_type", "event_id", F.unix_micros(F.col("occurred_at").cast("timestamp")).alias("t"), F.coalesce("delta_strength", F.lit(0.0)).alias("ds"), F.coalesce("delta_sentiment", F.lit(0.0)).alias("dm"))

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import math

        strength, mood, at = state.get if state.exists else (0.0, 0.0, None)
        n = late = 0
        rows = pd.concat(list(frames)).sort_values(["t", "event_id"])
        for kind, t, ds, dm in zip(rows["edge_type"], rows["t"], rows["ds"], rows["dm"]):
            if at is not None and t < at:
                late += 1
                continue
            if at is not None:
                strength *= math.exp(-rates[kind] * (t - at) / 6.048e11)
            strength, mood, at, n = min(1.0, max(0.0, strength + ds)), min(1.0, max(-1.0, mood + dm)), int(t), n + 1
        if at is not None:
            state.update((float(strength), float(mood), at))
            yield pd.DataFrame([(key[0], strength, mood, at, n, late)], columns=["edge_id", "strength", "sentiment", "at_micros", "events", "late"])

    return prepared.groupBy("edge_id").applyInPandasWithState(fold, EDGE_UPDATE, EDGE_STATE, "update", GroupStateTimeout.NoTimeout)


def windowed_spend(ledger: DataFrame, delay: str = "1 day", window: str = "7 days", slide: str = "1 day") -> DataFrame:
    """Spend by purpose in sliding windows of event time; works on streams and tables."""
    if ledger.isStreaming:
        ledger = ledger.withWatermark("timestamp", delay)
    return ledger.groupBy(F.window("timestamp", window, slide), "purpose").agg(F.sum("usd_cost").alias("spend")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "purpose", "spend")
