"""Data rules: row checks as violation codes, table rules as counts, and the gate on errors."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def violations(checks: dict[str, Column]) -> Column:
    """The codes of the checks that hold (each a condition of being bad; NULL is not bad), as array<string>."""
    return F.filter(F.array(*[F.when(bad, F.lit(code)) for code, bad in checks.items()]), lambda x: x.isNotNull())


def unit_range(c: str) -> Column:
    return ~F.col(c).between(0.0, 1.0)


def outside(c: str, allowed: list[str]) -> Column:
    return F.col(c).isNull() | ~F.col(c).isin(allowed)


def blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(c) == "")


def edge_checks(symmetric: tuple[str, ...] = ("teammate", "ex_teammate", "rival", "friend")) -> dict[str, Column]:
    return {
        "self_edge": F.col("src_id") == F.col("dst_id"),
        "unordered_pair": F.col("edge_type").isin(list(symmetric)) & (F.col("src_id") > F.col("dst_id")),
        "strength_range": unit_range("strength"),
        "sentiment_range": ~F.col("sentiment").between(-1.0, 1.0),
    }


def era_checks() -> dict[str, Column]:
    return {"end_before_start": F.col("end_date") <= F.col("start_date"), "magnitude_range": unit_range("meta_magnitude")}


def staging_checks() -> dict[str, Column]:
    return {"processed_without_entity": (F.col("status") == "processed") & F.col("canonical_id").isNull(), "unknown_status": outside("status", ["pending", "processed", "review", "error"])}


def unknown_keys(payload: Column, allowed: list[str]) -> Column:
    """Keys of a JSON object that its contract doesn't have."""
    return F.array_except(F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>")), F.array(*map(F.lit, allowed)))


def split_bad(rows: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine: bad rows with their codes)."""
    marked = rows.withColumn("violations", violations(checks))
    return marked.where(F.size("violations") == 0).drop("violations"), marked.where(F.size("violations") > 0)


@dataclass(frozen=True)
class Rule:
    """count(spark) gives one row with n; the rule holds if n <= most."""

    id: str
    severity: str
    count: Callable[[SparkSession], DataFrame]
    most: int = 0


def sql_rule(id: str, severity: str, query: str, most: int = 0) -> Rule:
    """query returns one count."""
    return Rule(id, severity, lambda spark: spark.sql(query).toDF("n"), most)


def count_rule(id: str, severity: str, rows: DataFrame, bad: Column, most: int = 0) -> Rule:
    return Rule(id, severity, lambda spark: rows.agg(F.count_if(bad).alias("n")), most)


def review_gates(queue: DataFrame, fail_above: int = 500, warn_above: int = 100) -> list[Rule]:
    n = lambda spark: queue.agg(F.count(F.lit(1)).alias("n"))
    return [Rule("review_queue_fail", "error", n, fail_above), Rule("review_queue_warn", "warn", n, warn_above)]


def report(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """rule_id, severity, n, passed; one aggregate a rule."""
    parts = [r.count(spark).select(F.lit(r.id).alias("rule_id"), F.lit(r.severity).alias("severity"), F.col("n").cast("long").alias("n"), (F.col("n") <= r.most).alias("passed")) for r in rules]
    return reduce(DataFrame.unionByName, parts)


def gate(found: DataFrame) -> list[str]:
    """Stop on failed errors; the ids of failed warnings otherwise. The report has one row a rule."""
    failed = found.where("not passed").collect()
    errors = [r["rule_id"] for r in failed if r["severity"] == "error"]
    if errors:
        raise ValueError(f"failed rules: {', '.join(sorted(errors))}")
    return sorted(r["rule_id"] for r in failed)


def orphans(edges: DataFrame, src: DataFrame, dst: DataFrame, src_col: str, dst_col: str, src_key: str, dst_key: str) -> DataFrame:
    """Edges of which an end does not exist, each once."""
    no_src = edges.join(src.select(F.col(src_key).alias(src_col)).distinct(), src_col, "left_anti")
    has_src = edges.join(src.select(F.col(src_key).alias(src_col)).distinct(), src_col, "left_semi")
    return no_src.select(*edges.columns).unionByName(has_src.join(dst.select(F.col(dst_key).alias(dst_col)).distinct(), dst_col, "left_anti").select(*edges.columns))


def out_of_range(values: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows of (id, attribute, value) outside the attribute's declared low..high; an unknown attribute stops the job."""
    known = values.join(ranges, "attribute", "left")
    low = F.coalesce("low", F.raise_error(F.concat(F.lit("undeclared attribute "), F.col("attribute"))).cast("double"))
    return known.where(~F.col("value").between(low, F.col("high"))).select(*values.columns)
