"""Written intermediate tables, in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below spark.checkpoint.dir.

    Where that is unset, a local master has a temporary folder, one a session; on a cluster the job stops, since
    executors would write to disks of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = getattr(spark, "_seriesgraph_folder", None) or tempfile.mkdtemp(prefix="seriesgraph-")
        spark._seriesgraph_folder = base
    return f"{base.rstrip('/')}/seriesgraph-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """df as a parquet table in a new shared folder, read back: what lies before it is not computed again."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a small table that tasks get whole.
SMALL_TABLE = 1 << 20


def whole_if_small(df: DataFrame, most: int = SMALL_TABLE) -> DataFrame:
    """A table of narrow rows, sent whole to every task if its counted rows are few; else the join exchanges both sides."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


#: Rows that a task gathers by key.
TASK_ROWS = 1_000_000


def tasks_for(df: DataFrame, rows: int = TASK_ROWS) -> int:
    """How many tasks the counted rows of a table need, at least one a core, so that a task's rows do not grow with it."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
