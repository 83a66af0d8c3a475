"""Snapshot validation, fingerprints, publishing, and the log of runs."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from .merge import surrogate_id
from .schema import EDGES, NODES, SCHEMA_VERSION

#: Slack on the 0..1 range of features.
SLACK = 1e-5

_ISSUE = "code string, severity string, location string, message string"


def _issues(rows: DataFrame, code: str, location: Column, message: Column, severity: str = "error") -> DataFrame:
    return rows.select(F.lit(code).alias("code"), F.lit(severity).alias("severity"), location.cast("string").alias("location"), message.cast("string").alias("message"))


def _static(spark, code: str, location: str, message: str, severity: str = "error") -> DataFrame:
    return spark.createDataFrame([(code, severity, location, message)], _ISSUE)


def _numbers(block: DataFrame, names: list[str], at: str, finite_code: str, range_code: str) -> list[DataFrame]:
    """One aggregate for the block: how many cells of each column aren't finite or are out of range."""
    have = [n for n in names if n in block.columns]
    if not have:
        return []
    odd = lambda c: F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf"))
    wide = lambda c: ~odd(c) & ((F.col(c) < -SLACK) | (F.col(c) > 1 + SLACK))
    counts = block.groupBy("era_slug").agg(*[F.count_if(odd(c)).alias(f"{c}__o") for c in have], *[F.count_if(wide(c)).alias(f"{c}__w") for c in have])
    kinds = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"{c}__o").alias("o"), F.col(f"{c}__w").alias("w")) for c in have]))
    long = counts.select("era_slug", kinds.alias("k"))
    place = F.concat_ws("/", "era_slug", F.lit(at), "k.c")
    return [_issues(long.where("k.o > 0"), finite_code, place, F.concat(F.col("k.o"), F.lit(" cells are not finite"))), _issues(long.where("k.w > 0"), range_code, place, F.concat(F.col("k.w"), F.lit(" cells outside 0..1")))]


def validate(blocks: dict[str, DataFrame], links: dict[tuple, DataFrame], schema_version: str = SCHEMA_VERSION, node_types: dict = NODES, edge_types: dict = EDGES) -> DataFrame:
    """All issues of snapshots, as code, severity, location, message; empty if they are sound. Codes are fixed values.

    shape_mismatch and edge_index_shape are about tensors; for tables they become checks that the index columns exist
    and are whole.
    """
    spark = next(iter([*blocks.values(), *links.values()])).sparkSession
    out: list[DataFrame] = []
    if schema_version != SCHEMA_VERSION:
        out.append(_static(spark, "schema_version_mismatch", "snapshot", f"{schema_version} is not {SCHEMA_VERSION}"))
    for t in blocks.keys() - node_types.keys():
        out.append(_static(spark, "unknown_node_type", t, "not in the schema", "warn"))
    for k in links.keys() - edge_types.keys():
        out.append(_static(spark, "unknown_edge_type", "/".join(k), "not in the schema", "warn"))
    for t, features in node_types.items():
        names = [f.name for f in features]
        if t not in blocks:
            out.append(_static(spark, "missing_node_block", t, "no block"))
            continue
        b = blocks[t]
        if [c for c in b.columns if c not in ("era_slug", "id", "idx")] != names:
            out.append(_static(spark, "column_mismatch", t, "columns differ from the schema"))
        if not {"era_slug", "id", "idx"} <= set(b.columns):
            out.append(_static(spark, "shape_mismatch", t, "era_slug, id and idx are needed"))
            continue
        size = b.groupBy("era_slug").agg(F.count(F.lit(1)).alias("n"), F.max("idx").alias("top"), F.count_if(F.col("id").isNull() | (F.trim("id") == "")).alias("blank"))
        out.append(_issues(size.where("top + 1 != n"), "shape_mismatch", F.concat_ws("/", "era_slug", F.lit(t)), F.lit("idx is not dense")))
        out.append(_issues(size.where("blank > 0"), "empty_node_ids", F.concat_ws("/", "era_slug", F.lit(t)), F.concat(F.col("blank"), F.lit(" ids are empty"))))
        twice = b.groupBy("era_slug", "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").groupBy("era_slug").agg(F.count(F.lit(1)).alias("n"))
        out.append(_issues(twice, "duplicate_node_ids", F.concat_ws("/", "era_slug", F.lit(t)), F.concat(F.col("n"), F.lit(" ids repeat"))))
        out += _numbers(b, names, t, "non_finite_features", "feature_range_violation")
    for k, attributes in edge_types.items():
        names, at = [a.name for a in attributes], "/".join(k)
        if k not in links:
            out.append(_static(spark, "missing_edge_block", at, "no block"))
            continue
        e = links[k]
        if not {"era_slug", "src_idx", "dst_idx"} <= set(e.columns):
            out.append(_static(spark, "edge_index_shape", at, "era_slug, src_idx and dst_idx are needed"))
            continue
        have = [c for c in e.columns if c not in ("era_slug", "src_idx", "dst_idx")]
        if names and not have:
            out.append(_static(spark, "missing_edge_attr", at, "no attributes"))
        elif have != names:
            out.append(_static(spark, "edge_attr_column_mismatch", at, "attributes differ from the schema"))
        for end, kind in (("src", k[0]), ("dst", k[2])):
            if kind in blocks and {"era_slug", "id"} <= set(blocks[kind].columns):
                n = blocks[kind].groupBy("era_slug").agg(F.count(F.lit(1)).alias("n"))
                far = e.join(n, "era_slug", "left").where(F.col(f"{end}_idx").isNull() | (F.col(f"{end}_idx") < 0) | (F.col(f"{end}_idx") >= F.coalesce("n", F.lit(0)))).groupBy("era_slug").agg(F.count(F.lit(1)).alias("bad"))
                out.append(_issues(far, f"{end}_index_out_of_bounds", F.concat_ws("/", "era_slug", F.lit(at)), F.concat(F.col("bad"), F.lit(" edges"))))
        out += _numbers(e, names, at, "non_finite_edge_attr", "edge_attr_range_violation")
    return reduce(DataFrame.unionByName, out)


def tree_fingerprint(rows: DataFrame, group: list[str], digits: int = 6, name: str = "fingerprint") -> DataFrame:
    """Per group a hash that ignores the order of rows: rows' hashes, then buckets' sorted hashes, then the top.

    Doubles are rounded, since sums differ in their last bits between runs. Row hashes of a bucket are combined by
    counts and two sums, so no list of them is gathered.
    """
    values = [F.round(F.col(f.name).cast("double"), digits).alias(f.name) if f.dataType.simpleString() in ("float", "double") else F.col(f.name) for f in rows.schema]
    h = F.sha2(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}), 256)
    part = lambda i: F.conv(F.substring("_h", 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)")
    bucketed = rows.select(*group, h.alias("_h")).groupBy(*group, F.substring("_h", 61, 1).alias("_b")).agg(*[F.sum(part(i)).alias(f"_s{i}") for i in range(5)], F.count(F.lit(1)).alias("_n"))
    line = F.concat_ws(":", "_b", "_n", *[F.col(f"_s{i}").cast("string") for i in range(5)])
    return bucketed.groupBy(*group).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), ","), 256).alias(name))


def snapshot_fingerprints(blocks: dict[str, DataFrame], links: dict[tuple, DataFrame]) -> DataFrame:
    """era_slug, fingerprint over all blocks; one row an era."""
    parts = [tree_fingerprint(b, ["era_slug"]).select("era_slug", F.lit(t).alias("_t"), "fingerprint") for t, b in blocks.items()]
    parts += [tree_fingerprint(e, ["era_slug"]).select("era_slug", F.lit("/".join(k)).alias("_t"), "fingerprint") for k, e in links.items()]
    both = reduce(DataFrame.unionByName, parts)
    return both.groupBy("era_slug").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "_t", "fingerprint"))), ","), 256).alias("fingerprint"))


def publish(blocks: dict[str, DataFrame], links: dict[tuple, DataFrame], published: DataFrame, root: str, config_hash: str, fail_fast: bool = False) -> DataFrame:
    """Write the eras whose fingerprint is not published yet, and return their rows for the log of runs.

    published: kind, config_hash, data_fingerprint, status. Eras with errors are logged as failed and not written;
    with fail_fast they stop the job. Files: nodes by type and edges by relation, each era's in a folder named by its
    run, and a manifest, written last, which is the only way in: a run that dies on its way is seen by no reader, and
    what other runs wrote stays as it is and readable. A rerun writes nothing.
    """
    prints = snapshot_fingerprints(blocks, links).withColumn("config_hash", F.lit(config_hash))
    new = prints.join(published.where("kind = 'snapshot' and status != 'failed'").select("config_hash", F.col("data_fingerprint").alias("fingerprint")), ["config_hash", "fingerprint"], "left_anti")
    issues = validate(blocks, links).where("severity = 'error'")
    bad = issues.select(F.split("location", "/")[0].alias("era_slug")).distinct()
    whole = issues.join(prints.select("era_slug"), F.split("location", "/")[0] == F.col("era_slug"), "left_anti").limit(1).count() > 0
    status = F.when(F.lit(whole) | F.col("_bad").isNotNull(), "failed").otherwise("completed")
    runs = new.join(bad.withColumn("_bad", F.lit(1)), "era_slug", "left").select("era_slug", F.lit("snapshot").alias("kind"), "config_hash", F.col("fingerprint").alias("data_fingerprint"), status.alias("status")).withColumn("run_id", surrogate_id(F.col("kind"), F.col("config_hash"), F.col("data_fingerprint")))
    if fail_fast and (failed := runs.where("status = 'failed'").select("era_slug").head(1)):
        raise ValueError(f"era {failed[0][0]} is not sound")
    runs = written(runs.withColumn("number", F.lit(_last_number(runs.sparkSession, root) + 1).cast("long")), "runs")
    good = runs.where("status = 'completed'").select("era_slug", F.col("run_id").alias("run"))
    replace = {"partitionOverwriteMode": "dynamic"}
    for t, b in blocks.items():
        b.join(good, "era_slug").write.mode("overwrite").options(**replace).partitionBy("run").parquet(f"{root}/nodes/node_type={t}")
    for k, e in links.items():
        e.join(good, "era_slug").write.mode("overwrite").options(**replace).partitionBy("run").parquet(f"{root}/edges/relation={k[1]}")
    runs.write.mode("append").json(f"{root}/manifest")
    return runs.drop("number")


_MANIFEST = "era_slug string, kind string, config_hash string, data_fingerprint string, status string, run_id string, number long"


def manifest(spark, root: str) -> DataFrame:
    """The runs that were written whole; none where nothing was published yet."""
    try:
        return spark.read.schema(_MANIFEST).json(f"{root}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def _last_number(spark, root: str) -> int:
    return manifest(spark, root).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]


def read_block(spark, root: str, node_type: str | None = None, relation: str | None = None, config_hash: str | None = None, number: int | None = None) -> DataFrame:
    """A block as published: of each era the latest finished run, of one configuration if given, as of a publication's
    number if given. The join on the runs, a row an era, prunes the folders of other runs."""
    runs = manifest(spark, root).where("status = 'completed'")
    if config_hash is not None:
        runs = runs.where(F.col("config_hash") == config_hash)
    if number is not None:
        runs = runs.where(F.col("number") <= number)
    latest = runs.groupBy("era_slug").agg(F.max_by("run_id", F.struct("number", "run_id")).alias("run"))
    path = f"{root}/nodes/node_type={node_type}" if node_type else f"{root}/edges/relation={relation}"
    return spark.read.parquet(path).join(latest.select("run"), "run", "left_semi").drop("run")


def file_set_fingerprint(files: DataFrame, inputs: list[str] | None = None) -> DataFrame:
    """One row: a hash over the set of (label, content hash) of a binaryFile scan, whatever their order; '' for no inputs.

    label is the path below the scanned folder's parent; inputs that hold no file get a marker of their own.
    """
    hashed = files.select(F.col("path").alias("label"), F.sha2("content", 256).alias("h"))
    if inputs is not None:
        spark = files.sparkSession
        named = spark.createDataFrame([(i,) for i in inputs], "input string")
        empty = named.join(hashed, F.col("label").contains(F.col("input")), "left_anti")
        hashed = hashed.unionByName(empty.select(F.col("input").alias("label"), F.sha2(F.lit("no files").cast("binary"), 256).alias("h")))
    # Lines are hashed and their hashes added up in buckets, whose sums are few: no list of all files is gathered.
    lines = tree_fingerprint(hashed.select("label", "h"), [], name="f")
    top = hashed.agg(F.count(F.lit(1)).alias("n"))
    return lines.crossJoin(top).select(F.when(F.col("n") == 0, "").otherwise(F.col("f")).alias("fingerprint"))  # one row each


def list_runs(runs: DataFrame, kind: str | None = None, status: str | None = None) -> DataFrame:
    """Newest first, with duration_seconds (NULL while running)."""
    if kind:
        runs = runs.where(F.col("kind") == kind)
    if status:
        runs = runs.where(F.col("status") == status)
    seconds = (F.unix_micros(F.col("finished_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 1e6
    return runs.withColumn("duration_seconds", seconds).orderBy(F.desc("started_at"), "run_id")


def lookup_run(runs: DataFrame, kind: str, config_hash: str, data_fingerprint: str) -> DataFrame:
    return runs.where((F.col("kind") == kind) & (F.col("config_hash") == config_hash) & (F.col("data_fingerprint") == data_fingerprint))
