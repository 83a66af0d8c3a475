"""Graph snapshots of all eras in one job: normalised node features, dense indices, resolved and ordered edges.

Rows carry their era, so fits are groups and nothing loops over eras.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.formulas import finite, normalised
from ..sources.shared import written
from .schema import EDGES, NODES, Feature


def fit(rows: DataFrame, features: tuple[Feature, ...], group: list[str]) -> DataFrame:
    """Per group one row with lo, hi, mean and std (population) of each feature's finite values; one pass.

    Columns are named <feature>__lo and so on; for log1p_minmax lo and hi are of log1p, negatives held at 0.
    """
    aggs = []
    for f in features:
        x = F.col(f.name)
        v = F.log1p(F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))) if f.normaliser == "log1p_minmax" else x
        aggs += [F.min(v).alias(f"{f.name}__lo"), F.max(v).alias(f"{f.name}__hi"), F.avg(x).alias(f"{f.name}__mean"), F.stddev_pop(x).alias(f"{f.name}__std")]
    return rows.groupBy(*group).agg(*aggs)


def normalise(rows: DataFrame, features: tuple[Feature, ...], group: list[str]) -> DataFrame:
    """rows with each feature normalised within its group and filled where the source had no number.

    Fill: zero; mean of the group's normalised values (0.5 without any); drop_node, which removes rows where the
    column is absent. Cells of a degenerate column are 0.5, but a missing cell takes its fill even there.
    """
    if not features:
        return rows
    need = [F.col(f.name).isNotNull() & ~F.coalesce(F.isnan(F.col(f.name).try_cast("double")), F.lit(False)) for f in features if f.fill == "drop_node"]
    if need:
        rows = rows.where(reduce(lambda a, b: a & b, need))
    rows = rows.withColumns({f.name: finite(F.col(f.name)) for f in features})
    stats = fit(rows, features, group)
    joined = rows.join(stats, group)
    value = {f.name: normalised(F.col(f.name), f.normaliser, *[F.col(f"{f.name}__{s}") for s in ("lo", "hi", "mean", "std")]).cast("float") for f in features}
    keep = [c for c in rows.columns if c not in value]
    normed = joined.select(*keep, *[F.when(F.col(n).isNotNull(), v).alias(n) for n, v in value.items()])
    means = [f.name for f in features if f.fill == "mean"]
    if means:
        normed = normed.join(normed.groupBy(*group).agg(*[F.coalesce(F.avg(m), F.lit(0.5)).alias(f"{m}__fill") for m in means]), group)
    fill = {f.name: F.col(f"{f.name}__fill").cast("float") if f.fill == "mean" else F.lit(0.0).cast("float") for f in features}
    return normed.select(*keep, *[F.coalesce(n, fill[n]).alias(n) for n in value])


def dense_index(rows: DataFrame, group: list[str], order: str, name: str = "idx") -> DataFrame:
    """rows with a gapless number from 0 within each group, in the order of one column (with ties in any order).

    No window over a whole group: ranges of the sorted rows are numbered on their own, and ranges start after the
    counts of those before them, of which there are few. The sorted rows are a written table, so that both uses see
    the same ranges.
    """
    keys = [F.col(c) for c in [*group, order]]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    number = F.monotonically_increasing_id()
    marked = written(ranged.withColumn("_m", number).withColumn("_range", F.shiftright("_m", 33)), "ranged")
    ranges = marked.groupBy("_range", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first"))
    w = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).select("_range", *group, "_first", "_before")
    return marked.join(starts, ["_range", *group]).withColumn(name, (F.col("_before") + F.col("_m") - F.col("_first")).cast("long")).drop("_m", "_range", "_first", "_before")


def node_block(nodes: DataFrame, node_type: str, features: tuple[Feature, ...] | None = None) -> DataFrame:
    """era_slug, id, idx and the type's normalised features; nodes: era_slug, node_type, id, features (map of text or numbers)."""
    features = NODES[node_type] if features is None else features
    wide = nodes.where(F.col("node_type") == node_type).select("era_slug", "id", *[F.try_element_at("features", F.lit(f.name)).alias(f.name) for f in features])
    return dense_index(normalise(wide, features, ["era_slug"]), ["era_slug"], "id")


def with_patch_nodes(nodes: DataFrame, patch_meta: DataFrame) -> DataFrame:
    """nodes, with a patch node made from the metadata for each era that has none."""
    years = {f"season_year_{y}": (F.col("season_year") == y).cast("double") for y in (2024, 2025, 2026)}
    plain = ["era_ordinal", "duration_days", "matches_played", "agents_added", "maps_added", "meta_magnitude", "agg_match_acs", "agg_match_kast"]
    values = {c: F.col(c).cast("double") for c in plain} | {"is_major_shift": F.col("is_major_shift").cast("double")} | years
    features = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])
    absent = patch_meta.join(nodes.where("node_type = 'patch'").select("era_slug").distinct(), "era_slug", "left_anti")
    return nodes.unionByName(absent.select("era_slug", F.lit("patch").alias("node_type"), F.concat(F.lit("patch:"), F.col("era_slug")).alias("id"), features.alias("features")).select(*nodes.columns))


def edge_block(edges: DataFrame, key: tuple[str, str, str], src_index: DataFrame, dst_index: DataFrame, attributes: tuple[Feature, ...] | None = None) -> DataFrame:
    """era_slug, src_idx, dst_idx and normalised attributes of the edges of which both ends exist, ordered by these.

    edges: era_slug, src, relation, dst, src_id, dst_id, attributes (map); the indices: era_slug, id, idx. An edge with
    an end that does not exist is dropped. The order is one of ranges, each sorted, attributes compared as numbers.
    """
    attributes = EDGES[key] if attributes is None else attributes
    rows = edges.where((F.col("src") == key[0]) & (F.col("relation") == key[1]) & (F.col("dst") == key[2]))
    rows = rows.join(src_index.select("era_slug", F.col("id").alias("src_id"), F.col("idx").alias("src_idx")), ["era_slug", "src_id"])
    rows = rows.join(dst_index.select("era_slug", F.col("id").alias("dst_id"), F.col("idx").alias("dst_idx")), ["era_slug", "dst_id"])
    wide = rows.select("era_slug", "src_idx", "dst_idx", *[F.try_element_at("attributes", F.lit(a.name)).alias(a.name) for a in attributes])
    order = ["era_slug", "src_idx", "dst_idx", *[F.col(a.name).asc_nulls_first() for a in attributes]]
    return normalise(wide, attributes, ["era_slug"]).repartitionByRange(*order).sortWithinPartitions(*order)


def build_snapshots(nodes: DataFrame, edges: DataFrame, patch_meta: DataFrame, node_types: dict = NODES, edge_types: dict = EDGES) -> tuple[dict[str, DataFrame], dict[tuple, DataFrame]]:
    """(node blocks by type, edge blocks by key) of every era in the source."""
    nodes = with_patch_nodes(nodes, patch_meta)
    blocks = {t: node_block(nodes, t, f) for t, f in node_types.items()}
    links = {k: edge_block(edges, k, blocks[k[0]], blocks[k[2]], a) for k, a in edge_types.items()}
    return blocks, links


def summary(blocks: dict[str, DataFrame]) -> DataFrame:
    """era_slug, node_type, n."""
    return reduce(DataFrame.unionByName, [b.groupBy("era_slug").agg(F.count(F.lit(1)).alias("n")).select("era_slug", F.lit(t).alias("node_type"), "n") for t, b in blocks.items()])
