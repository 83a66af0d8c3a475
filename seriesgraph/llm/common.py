"""What the operators of this subpackage share: the shared folder, written tables and files in it."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below spark.checkpoint.dir, which all executors share.

    Where that setting is absent and the master is local (tests, a laptop) a temporary folder takes its place; on a
    cluster its absence stops the job, since executors would write to disks of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = getattr(spark, "_seriesgraph_folder", None) or tempfile.mkdtemp(prefix="seriesgraph-")
        spark._seriesgraph_folder = base
    return f"{base.rstrip('/')}/seriesgraph-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table", compression: str = "snappy") -> DataFrame:
    """df as a table in the shared folder, read back: lineage ends here and a lost executor costs nothing."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a few numbers that tasks get whole (about 40 MB); larger tables are joined by an exchange.
SMALL_TABLE = 1 << 20


def whole_if_small(df: DataFrame, most: int = SMALL_TABLE) -> DataFrame:
    """A written table, sent whole to every task if its counted rows are few; else the join exchanges both sides."""
    return F.broadcast(df) if df.count() <= most else df


def open_store(uri: str):
    """(pyarrow file system, path in it) of a URI or a plain local path; for use inside tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def put_file(uri: str, name: str, write) -> str:
    """Let write(stream) fill a file of the folder uri; it appears under its name only when whole.

    A retried or speculative task writes the same bytes under another temporary name, so the last move wins harmlessly.
    """
    store, folder = open_store(uri)
    store.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        write(out)
    store.move(part, f"{folder}/{name}")
    return f"{uri.rstrip('/')}/{name}"


def free_name(name: str, *taken: str) -> str:
    """name, with as many underscores as it takes to differ from the taken ones, whatever their case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def check_free(names, columns) -> None:
    """Stop where a result's own columns would replace columns of the input."""
    clash = {n.lower() for n in names} & {c.lower() for c in columns}
    if clash:
        raise ValueError(f"the input has columns named {', '.join(sorted(clash))}; give the results other names")


def task_number() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


def small_batches(spark: SparkSession, rows: int = 1_000, size: int = 4 << 20) -> None:
    """At most so many rows, and about so many bytes, in an Arrow batch of this session from now on.

    Texts can be long, and a batch is held several times on its way; a single longer text is a batch of its own. Spark
    reads the settings when a job runs, so they stay set for the caller.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def single_threaded() -> None:
    """One core a task: tokenizers' own thread pool would take the other tasks' cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def finite_vectors(df: DataFrame, id_col: str, vector_col: str, nonzero: bool = False) -> DataFrame:
    """(vec_id, vector) of the rows that can take part in a search.

    Out: null ids, null and empty vectors, null or non-finite components, and zero vectors where asked. Rows that repeat
    both id and vector count once; other vectors of an id are rows of their own. Lengths may differ.
    """
    inf = float("inf")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")).where(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    )
    if nonzero:
        rows = rows.where(F.exists("vector", lambda x: x != 0))
    return rows.distinct()
