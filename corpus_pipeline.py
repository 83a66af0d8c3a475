"""The corpus pipeline: toxicity, near duplicates, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows and reads them back as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesgraph.llm import jaccard, packing, secrets, toxicity
from seriesgraph.llm.common import free_name, whole_if_small, written
from seriesgraph.llm.queries import vocabulary


def _own(docs: DataFrame) -> list[str]:
    """The columns of docs as names to select by, whatever characters they have."""
    return ["`" + c.replace("`", "``") + "`" for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trained classifier does not reject.

    Null and empty texts score 0 and stay; repeated rows stay or go together; an empty table gives an empty one. Other
    columns pass through, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    names = tuple(free_name(n, *docs.columns) for n in ("held_out", "score", "predicted"))
    return toxicity.score_toxicity(docs, labels, names=names).where(F.col(names[2]) == 0).select(*_own(docs))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates one row, that of the smallest id, null ids last; all rows without words.

    Rows are told apart by a key of their own, so an id may stand for several texts. Of rows with the smallest id that
    with the smallest hash of its columns stays, so that equal tables lose equal rows. An empty table gives an empty
    one. Other columns pass through, whatever their names.
    """
    row = free_name("row", *docs.columns)
    tie = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _own(docs)])
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows", "zstd")
    found = written(jaccard.jaccard_components(rows.select(F.col(row).alias("doc_id"), "text")).where("n_shingles > 0").select(F.col("doc_id").alias(row), F.col("component_id").alias("_component")), "components")
    # Only numbers are ranked and joined; the texts stay where they are.
    ranked = rows.select(row, F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), tie.alias("tie"), F.col(row).alias("row")).alias("_rank"))
    least = ranked.join(found, row).groupBy("_component").agg(F.min("_rank").alias("_first")).select(F.col("_first.row").alias(row))
    drop = written(found.select(row).join(least, row, "left_anti"), "dropped")
    return rows.join(whole_if_small(drop), row, "left_anti").select(*_own(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by a mark; n_chars follows the text where that changed.

    Null and empty texts stay as they are, repeated rows stay, an empty table gives an empty one. Other columns pass
    through, whatever their names.
    """
    names = tuple(free_name(n, *docs.columns) for n in ("blob", "spans"))
    scanned, _ = secrets.scan_versions(docs, "text", names=names)
    # Under another name, or the new text would stand in for the old one in the other columns' expressions.
    before = free_name("before", *scanned.columns)
    scanned = scanned.withColumnRenamed("text", before)
    hit = F.size(names[1]) > 0
    changed = scanned.withColumn("text", F.when(hit, secrets.redact(F.col(before), F.col(names[1]))).otherwise(F.col(before)))
    return changed.withColumn("n_chars", F.when(hit, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*_own(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document's ids, in packed sequences; a null text is an end id alone, other columns are not read."""
    return packing.pack_examples(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", keep_one_of_near_duplicates), ("secrets", redact_secrets), ("packing", pack)]

#: The classifier and the tokenizer can't be expressed in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir).drop("ids")
