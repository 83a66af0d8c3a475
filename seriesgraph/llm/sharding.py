"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

A uniform permutation cut into shards sends each input partition's rows to the shards in numbers that follow a
multivariate hypergeometric law. Those numbers are drawn first; then every partition permutes its rows and deals them
out by its line of the matrix, rows are exchanged once, and each shard permutes what it got. Shard sizes are exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import check_free, written

#: Partitions whose lines of the matrix one task draws; the driver draws one line per so many partitions.
BLOCK = 1024
#: Rows that one task of the last permutation orders.
TASK_ROWS = 50_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among n drawn of good + bad. Beyond numpy's limit of 1e9: inversion over 14 deviations around the mean."""
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n))
    total = good + bad
    mean = n * good / total
    spread = 14 * (mean * (bad / total) * ((total - n) / max(1, total - 1))) ** 0.5 + 14
    lo, hi = max(0, n - bad, int(mean - spread)), min(n, good, int(mean + spread) + 1)
    k = np.arange(lo, hi, dtype=float)
    steps = np.log(np.maximum(good - k, 1e-300)) + np.log(np.maximum(n - k, 1e-300)) - np.log(k + 1) - np.log(bad - n + k + 1)
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    weights = np.cumsum(np.exp(logs - logs.max()))
    return lo + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def draw_lines(rng: np.random.Generator, sizes: list[int], capacity: list[int]) -> list[list[int]]:
    """For each of sizes, how many of its rows go to each shard; column sums are capacity."""
    left, lines = list(capacity), []
    for size in sizes:
        line, rest, after = [], size, sum(left)
        for c in left:
            after -= c
            take = hypergeometric(rng, c, after, rest) if rest and c else 0
            line.append(take)
            rest -= take
        left = [c - t for c, t in zip(left, line)]
        lines.append(line)
    return lines


def shuffle_into_shards(rows: DataFrame, shards: int = 24, seed: int = 20240501, key_cols: list[str] | None = None, names: tuple[str, str] = ("shard", "slot")) -> DataFrame:
    """rows with shard (0 to shards - 1) and slot (gapless from 0 in each shard), under names, in uniformly random order.

    Counts of shards differ by one at most; which shards get one more is fixed (the lowest). Null or repeated values
    are dealt like any other, since a row's chance comes from its place in the written table, not from its values.
    Where a column has one of the names, others must be given; none is overwritten. An empty table gives
    an empty result.
    """
    check_free(names, rows.columns)
    # A row travels as one value, so that no working column meets one of its own.
    keys = [F.col("_row").getField(c) for c in key_cols or rows.columns]
    rows = rows.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in rows.columns]).alias("_row"))
    columns = rows.columns
    # Permute locally: no exchange, the row's number after a sort by a seeded hash is its place.
    local = rows.withColumn("_key", F.xxhash64(F.lit(seed), F.monotonically_increasing_id(), *keys)).sortWithinPartitions("_key").drop("_key")
    number = F.monotonically_increasing_id()
    placed = written(local.withColumn("_number", number).select(*columns, F.shiftright("_number", 33).cast("int").alias("_part"), F.col("_number").bitwiseAND((1 << 33) - 1).alias("_place")), "placed")

    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_block", F.floor(F.col("_part") / BLOCK).cast("int"))
    blocks = sorted((r["_block"], r["n"]) for r in sizes.groupBy("_block").agg(F.sum("_n").alias("n")).collect())
    total = sum(n for _, n in blocks)
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    rng = np.random.default_rng(seed)
    upper = dict(zip((b for b, _ in blocks), draw_lines(rng, [n for _, n in blocks], capacity)))

    def draw(pdf):
        import pandas as pd

        pdf = pdf.sort_values("_part")
        block = int(pdf["_block"].iloc[0])
        lines = draw_lines(np.random.default_rng([seed, block]), pdf["_n"].tolist(), upper[block])
        return pd.DataFrame({"_part": pdf["_part"].to_numpy(), "_bounds": [np.cumsum(line).tolist() for line in lines]})

    matrix = sizes.groupBy("_block").applyInPandas(draw, "_part int, _bounds array<long>")
    dealt = placed.join(matrix, "_part").withColumn("shard", F.size(F.filter("_bounds", lambda b: b <= F.col("_place"))))

    # Permute again within each shard, in sub-buckets of bounded size whose offsets come from their counts.
    subs = max(1, -(-total // (shards * TASK_ROWS)))
    dealt = dealt.withColumn("_key", F.xxhash64(F.lit(seed + 1), "_part", "_place")).withColumn("_sub", F.pmod("_key", F.lit(subs)).cast("int"))
    counts = dealt.groupBy("shard", "_sub").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "_sub", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("shard", "_sub").orderBy("_key", "_part", "_place"))
    ranked = dealt.withColumn("_rank", rank)
    return ranked.join(offsets, ["shard", "_sub"]).select("_row.*", F.col("shard").alias(names[0]), (F.col("_before") + F.col("_rank") - 1).cast("long").alias(names[1]))


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 20240501) -> DataFrame:
    """The digest of documents in shards by the law of equal row counts: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 8; a null text has none and the checksum of no bytes.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"))
    out = shuffle_into_shards(slim, shards, seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
