"""The library's operators bound to the given tables, each over all of its rows, and the same in SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import formulas, parse
from ..operators import derive, eras, features, merge, publish, quality, relations, resolve, similar, spend
from ..operators.schema import Feature
from ..sources import pages as page_source
from ..sources.shared import new_folder, tasks_for, whole_if_small
from ..sources.tables import read_events, since

NTZ = "timestamp_ntz"
#: Eras of the orders' years; an input of the queries, as eras are of the library.
ERAS = [("e1995", "1995-01-01", 0), ("e1996", "1996-03-01", 0), ("e1997", "1997-07-15", 1), ("e1999", "1999-01-01", 0), ("e2000", "2000-06-01", 1)]
#: USD per million tokens: an input, like the eras.
PRICES = [("m0", 15.0, 75.0), ("m1", 3.0, 15.0), ("m2", 1.0, 5.0)]
#: Disallowed prefixes by agent.
ROBOTS = [("*", "/en/1"), ("bot", "/de"), ("bot", "/fr/2"), ("bot", ""), ("bot-news", "/es/26")]


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def _eras(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(ERAS, "era_slug string, start string, major int").select("era_slug", F.col("start").cast(NTZ).alias("start_date"), (F.col("major") == 1).alias("is_major_shift"))
    return eras.ends_from_starts(rows)


def _sql_values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


SQL_ERAS = f"eras AS (SELECT era_slug, CAST(s AS TIMESTAMP) AS start_date, lead(CAST(s AS TIMESTAMP)) OVER (ORDER BY CAST(s AS TIMESTAMP)) AS end_date, major = 1 AS is_major_shift FROM (VALUES {_sql_values(ERAS)}) v(era_slug, s, major))"
SQL_IN_ERA = "o_orderdate >= start_date AND (end_date IS NULL OR o_orderdate < end_date)"

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


@query(f"WITH {SQL_ERAS} SELECT era_slug, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders LEFT JOIN eras ON {SQL_IN_ERA} GROUP BY 1")
def era_assign(spark, d):
    rows = eras.assign_era(_read(spark, d, "orders").select("o_orderdate", "o_totalprice"), _eras(spark), "o_orderdate")
    return rows.groupBy("era_slug").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


#: Eras of the events' month, with a gap and one after the other open to no end; an input as well.
EVENT_ERAS = [("g1", "2024-01-03", "2024-01-08"), ("g2", "2024-01-10", "2024-01-10 12:00:00"), ("g3", "2024-01-12", "2024-01-20"), ("g4", "2024-01-26", None)]


@query("""WITH eras AS (SELECT * FROM (VALUES ('g1', TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-08'), ('g2', TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-10 12:00:00'), ('g3', TIMESTAMP '2024-01-12', TIMESTAMP '2024-01-20'), ('g4', TIMESTAMP '2024-01-26', NULL)) v(era_slug, s, e))
    SELECT (SELECT max_by(era_slug, s) FROM eras WHERE s <= ts) AS era_slug, count(*) AS n, count((SELECT max_by(era_slug, s) FROM eras WHERE s <= ts AND (e IS NULL OR ts < e))) AS inside FROM events GROUP BY 1""")
def era_nearest_prior(spark, d):
    """Events before the first era, in gaps and in eras, by the prior policy, and how many the strict one places."""
    known = spark.createDataFrame(EVENT_ERAS, "era_slug string, s string, e string").select("era_slug", F.col("s").cast(NTZ).alias("start_date"), F.col("e").cast(NTZ).alias("end_date"))
    strict = eras.assign_era(_read(spark, d, "events").select("ts"), known, "ts").withColumnRenamed("era_slug", "_in")
    return eras.assign_era(strict, known, "ts", "nearest_prior").groupBy("era_slug").agg(F.count(F.lit(1)).alias("n"), F.count("_in").alias("inside"))


@query(f"WITH {SQL_ERAS} SELECT era_slug, start_date, strftime(coalesce(end_date, TIMESTAMP '9999-12-31 23:59:59'), '%Y-%m-%d %H:%M:%S') AS end_date, end_date IS NULL AS is_current, count(o_orderkey) AS n FROM eras LEFT JOIN orders ON {SQL_IN_ERA} GROUP BY ALL")
def era_window(spark, d):
    windows = eras.era_windows(_eras(spark)).select("era_slug", "start_date", F.date_format("end_date", "yyyy-MM-dd HH:mm:ss").alias("end_date"), "is_current")
    counted = eras.assign_era(_read(spark, d, "orders").select("o_orderdate"), _eras(spark), "o_orderdate").groupBy("era_slug").agg(F.count(F.lit(1)).alias("n"))
    return windows.join(counted, "era_slug", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query(f"WITH {SQL_ERAS}, r AS (SELECT *, sum(CASE WHEN is_major_shift THEN 1 ELSE 0 END) OVER (ORDER BY start_date) AS g FROM eras) SELECT o_custkey, CAST(min(g) AS BIGINT) AS first_regime, CAST(max(g) AS BIGINT) AS last_regime FROM orders JOIN r ON {SQL_IN_ERA} GROUP BY 1 HAVING min(g) < max(g)")
def era_bleed(spark, d):
    rows = eras.assign_era(_read(spark, d, "orders").select("o_custkey", "o_orderdate"), _eras(spark), "o_orderdate")
    return eras.bleeding_groups(rows, _eras(spark), ["o_custkey"])


@query("""WITH s AS (SELECT o_custkey, o_orderkey, o_orderdate AS start_date, lead(o_orderdate) OVER w AS nxt, lag(o_orderdate) OVER w AS prv FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
    f AS (SELECT o_custkey, CASE WHEN prv = start_date THEN 1 ELSE 0 END AS same FROM s) SELECT o_custkey, count(*) AS n, CAST(sum(same) AS BIGINT) AS same_start FROM f GROUP BY 1""")
def sequence_check(spark, d):
    """The sequence test on every customer's orders: starts that do not rise."""
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    rows = _read(spark, d, "orders").select("o_custkey", F.coalesce((F.lag("o_orderdate").over(w) == F.col("o_orderdate")).cast("int"), F.lit(0)).alias("same"))
    return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("same").alias("same_start"))


def _rosters(spark, d, orders: DataFrame | None = None):
    lines = _read(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_suppkey")
    orders = _read(spark, d, "orders").select("o_orderkey", "o_orderdate") if orders is None else orders
    rest = [c for c in orders.columns if c not in ("o_orderkey", "o_orderdate")]
    # Dealt by order in as many tasks as the lines need; the sides are gathered where the join leaves them.
    tasks = tasks_for(lines)
    lines, orders = lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_orderkey").alias("map_id"), F.col("l_returnflag").alias("side"), F.col("l_suppkey").alias("entity_id"), F.col("o_orderdate").alias("at"), *rest)


SQL_PAIRS = """rost AS (SELECT DISTINCT l_orderkey AS m, l_returnflag AS s, l_suppkey AS e, o_orderdate AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    latest AS (SELECT max(d) AS ref FROM rost),
    pairs AS (SELECT a.e AS src_id, b.e AS dst_id, count(*) AS maps, max(a.d) AS last_at FROM rost a JOIN rost b ON a.m = b.m AND a.s = b.s AND a.e < b.e GROUP BY 1, 2),
    edges AS (SELECT src_id, dst_id, maps, CASE WHEN last_at >= ref - INTERVAL 90 DAY THEN 'teammate' ELSE 'ex_teammate' END AS edge_type, least(1.0, maps / 20.0) AS strength, last_at FROM pairs, latest)"""


@query(f"WITH {SQL_PAIRS} SELECT src_id, dst_id, maps, edge_type, round(strength, 6) AS strength, last_at FROM edges")
def pairs_strength(spark, d):
    return relations.teammate_edges(_rosters(spark, d)).select("src_id", "dst_id", "maps", "edge_type", F.round("strength", 6).alias("strength"), F.col("last_updated_at").alias("last_at"))


SQL_DECAY = "least(1.0, greatest(0.0, strength * exp(-(CASE edge_type WHEN 'teammate' THEN 0.020 ELSE 0.010 END) * greatest(0.0, epoch_us(TIMESTAMP '2001-12-31') - epoch_us(last_at)) / 6.048e11)))"


@query(f"WITH {SQL_PAIRS} SELECT src_id, dst_id, edge_type, round({SQL_DECAY}, 6) AS strength, last_at < TIMESTAMP '2001-12-31' AS touched FROM edges")
def pairs_decay(spark, d):
    return relations.decay_pass(relations.teammate_edges(_rosters(spark, d)), "2001-12-31").select("src_id", "dst_id", "edge_type", F.round("strength", 6).alias("strength"), "touched")


@query(f"WITH {SQL_PAIRS} SELECT entity_id, count(*) AS degree, CAST(sum(maps) AS BIGINT) AS maps FROM (SELECT src_id AS entity_id, maps FROM edges UNION ALL SELECT dst_id, maps FROM edges) GROUP BY 1")
def neighbours(spark, d):
    return relations.neighbours(relations.teammate_edges(_rosters(spark, d))).groupBy("entity_id").agg(F.count(F.lit(1)).alias("degree"), F.sum("maps").alias("maps"))


@query(f"""WITH {SQL_ERAS}, rost AS (SELECT DISTINCT l_orderkey AS m, l_returnflag AS s, l_suppkey AS e, o_orderdate AS d, era_slug FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN eras ON {SQL_IN_ERA}),
    latest AS (SELECT max(d) AS ref FROM rost), pairs AS (SELECT a.era_slug, a.e AS src_id, b.e AS dst_id, count(*) AS maps, max(a.d) AS last_at FROM rost a JOIN rost b ON a.m = b.m AND a.s = b.s AND a.e < b.e GROUP BY 1, 2, 3)
    SELECT era_slug, src_id, dst_id, maps, round(least(1.0, maps / 20.0) * exp(-0.020 * (epoch_us(ref) - epoch_us(last_at)) / 6.048e11), 6) AS strength FROM pairs, latest""")
def teammates_by_era(spark, d):
    """The flagship: strength of pairs within each era, as of the latest game of all. Eras are looked up once an order."""
    orders = eras.assign_era(_read(spark, d, "orders").select("o_orderkey", "o_orderdate"), _eras(spark), "o_orderdate").where("era_slug is not null")
    rows = _rosters(spark, d, orders)
    weeks = formulas.weeks_between(F.col("last_at"), F.col("ref"))
    pairs = relations.shared_pairs(rows, ["era_slug"]).crossJoin(F.broadcast(relations.latest_at(rows, ["era_slug"], "ref")))  # one row
    return pairs.select("era_slug", "src_id", "dst_id", "maps", F.round(formulas.decay_strength(formulas.shared_strength(F.col("maps")), F.lit("teammate"), weeks), 6).alias("strength"))


def _events_on_edges(spark, d):
    e = _read(spark, d, "events")
    edges = e.groupBy("user_id").agg(F.min("ts").alias("at")).select(F.col("user_id").cast("string").alias("edge_id"), F.when(F.col("user_id") % 2 == 0, "rival").otherwise("friend").alias("edge_type"), F.lit(0.5).alias("strength"), F.lit(0.0).alias("sentiment"), F.col("at").alias("last_updated_at"))
    deltas = e.where("event_type in ('purchase', 'error')").select(F.col("user_id").cast("string").alias("edge_id"), F.col("event_id").cast("string").alias("event_id"), F.col("ts").alias("occurred_at"), F.when(F.col("event_type") == "purchase", 0.1).otherwise(-0.15).alias("delta_strength"), F.lit(0.01).alias("delta_sentiment"))
    return edges, deltas


@query("""WITH edges AS (SELECT user_id, CASE WHEN user_id % 2 = 0 THEN 0.015::DOUBLE ELSE 0.012::DOUBLE END AS rate, min(ts) AS since FROM events GROUP BY 1, 2),
    later AS (SELECT e.user_id, rate, epoch_us(ts) AS t, CASE WHEN event_type = 'purchase' THEN 0.1::DOUBLE ELSE -0.15::DOUBLE END AS delta, event_id::VARCHAR AS k, epoch_us(since) AS t0 FROM events e JOIN edges USING (user_id) WHERE event_type IN ('purchase', 'error') AND ts > since),
    gaps AS (SELECT *, exp(-rate * (t - lag(t, 1, t0) OVER (PARTITION BY user_id ORDER BY t, k)) / 6.048e11) AS fade FROM later),
    lists AS (SELECT user_id, list([fade, delta] ORDER BY t, k) AS steps, max(t) AS last FROM gaps GROUP BY 1)
    SELECT user_id::VARCHAR AS edge_id, CASE WHEN user_id % 2 = 0 THEN 'rival' ELSE 'friend' END AS edge_type,
        round(coalesce(list_reduce(list_prepend([0.5::DOUBLE, 0], steps), lambda x, y: [least(1, greatest(0, x[1] * y[1] + y[2])), 0])[1], 0.5), 6) AS strength,
        round(coalesce(list_reduce(list_prepend([0::DOUBLE, 0], steps), lambda x, y: [least(1, greatest(-1, x[1] + 0.01::DOUBLE)), 0])[1], 0), 6) AS sentiment,
        coalesce(make_timestamp(last), since) AS last_updated_at FROM edges LEFT JOIN lists USING (user_id)""")
def event_fold(spark, d):
    """Events in order of time, held to the ranges at each step, as maps composed over stretches of them; the SQL goes step by step."""
    edges, deltas = _events_on_edges(spark, d)
    return relations.fold_events(edges, deltas).withColumn("strength", F.round("strength", 6)).withColumn("sentiment", F.round("sentiment", 6))


@query("SELECT source, sha256(concat_ws(chr(1), source, text)) AS content_hash, count(*) AS copies FROM documents WHERE doc_id % 2 = 0 AND sha256(concat_ws(chr(1), source, text)) NOT IN (SELECT sha256(concat_ws(chr(1), source, text)) FROM documents WHERE doc_id % 2 = 1) GROUP BY ALL")
def dedup_hash(spark, d):
    """Documents with even ids arrive after those with odd ones: the new contents, and how often each came."""
    rows = _read(spark, d, "documents").select("doc_id", "source", F.sha2(F.concat_ws("\u0001", "source", "text"), 256).alias("content_hash"))
    seen, incoming = rows.where("doc_id % 2 = 1"), rows.where("doc_id % 2 = 0")
    new = merge.append_unseen(seen, incoming.select("source", "content_hash"), ["source", "content_hash"])
    return incoming.groupBy("source", "content_hash").agg(F.count(F.lit(1)).alias("copies")).join(new, ["source", "content_hash"], "left_semi")


@query("WITH i AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders WHERE o_orderkey % 2 = 0) SELECT o_custkey, o_orderkey, o_totalprice FROM i WHERE n = 1 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 1)")
def insert_absent(spark, d):
    o = _read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return merge.insert_absent(o.where("o_orderkey % 2 = 1"), o.where("o_orderkey % 2 = 0"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("""WITH t AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 5 <> 0), i AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 2 = 0),
    u AS (SELECT coalesce(t.c_acctbal, i.c_acctbal) AS x, i.c_acctbal AS y, CASE WHEN i.c_custkey IS NULL THEN 'untouched' WHEN t.c_custkey IS NULL THEN 'inserted' WHEN t.c_acctbal IS DISTINCT FROM i.c_acctbal THEN 'updated' ELSE 'unchanged' END AS outcome FROM t FULL JOIN i USING (c_custkey))
    SELECT outcome, count(*) AS n, round(sum(coalesce(y, x)), 2) AS balance FROM u GROUP BY 1""")
def upsert_outcome(spark, d):
    c = _read(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    incoming = c.where("c_custkey % 2 = 0").withColumn("c_acctbal", F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return merge.upsert(c.where("c_custkey % 5 <> 0"), incoming, ["c_custkey"]).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("SELECT conv_id, turn, text FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'user' AND turn > 2) UNION ALL SELECT conv_id, turn, 'again: ' || text FROM conversations WHERE role = 'user' AND conv_id IN (SELECT conv_id FROM conversations WHERE role = 'user' AND turn > 2)")
def replace_children(spark, d):
    """Conversations with a late user turn are replaced by their user turns; the others stay."""
    c = _read(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    chosen = c.where("role = 'user' and turn > 2").select("conv_id").distinct()
    fresh = c.where("role = 'user'").join(chosen, "conv_id", "left_semi").select("conv_id", "turn", F.concat(F.lit("again: "), "text").alias("text"))
    return merge.replace_children(c.select("conv_id", "turn", "text"), fresh, ["conv_id"], "turn")


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) ORDER BY n_chars, doc_id LIMIT 50")
def pending_docs(spark, d):
    docs = _read(spark, d, "documents").select("doc_id", "n_chars")
    return similar.pending(docs, _read(spark, d, "labels"), "doc_id", "n_chars", 50)


@query("""WITH a AS (SELECT user_id, ts AS valid_from, event_id AS alias_id FROM events WHERE event_type = 'signup'), l AS (SELECT event_id AS lookup_id, user_id, ts FROM events WHERE event_type = 'purchase')
    SELECT lookup_id, l.user_id, ts, valid_from, alias_id FROM (SELECT l.lookup_id, max((a.valid_from, a.alias_id)) AS m FROM l JOIN a ON a.user_id = l.user_id AND a.valid_from <= l.ts GROUP BY 1) b RIGHT JOIN l USING (lookup_id) LEFT JOIN a ON a.user_id = l.user_id AND (a.valid_from, a.alias_id) = b.m""")
def alias_asof(spark, d):
    e = _read(spark, d, "events")
    aliases = e.where("event_type = 'signup'").select("user_id", F.col("ts").alias("valid_from"), F.col("event_id").alias("alias_id"))
    lookups = e.where("event_type = 'purchase'").select(F.col("event_id").alias("lookup_id"), "user_id", "ts")
    return eras.alias_at(lookups, aliases, ["user_id"], "ts")


@query(r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents), c AS (SELECT doc_id, w, unnest(range(0, CAST(ceil(len(w) / 180.0) AS BIGINT))) AS i FROM w)
    SELECT doc_id, CAST(i AS INTEGER) AS chunk_idx, md5(array_to_string(w[i * 180 + 1 : i * 180 + 180], ' ')) AS chunk FROM c""")
def text_chunks(spark, d):
    return similar.text_chunks(_read(spark, d, "documents"), "doc_id", "text").select("doc_id", "chunk_idx", F.md5("chunk_text").alias("chunk"))


@query()
def knn_cells(spark, d):
    """The ten nearest of every hundredth vector by coarse cells; approximate, so no SQL (a test measures the recall)."""
    rows = _read(spark, d, "embeddings").select(F.col("vec_id").alias("entity_id"), "embedding", F.lit("v1").alias("model_version"))
    index = similar.build_cells(rows, new_folder(spark, "cells"))
    found = similar.nearest_in_cells(index, index.rows.where("id % 100 = 0"), 10, probes=12)
    return found.select("query_id", "rank", "id", F.round("distance", 6).alias("distance"))


@query("""WITH t AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0), s AS (SELECT vec_id, 1 - list_dot_product(CAST(embedding AS DOUBLE[]), v) / (sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) * sqrt(list_dot_product(v, v))) AS x FROM embeddings, t WHERE vec_id <> 0 AND label < 5)
    SELECT vec_id, round(x, 6) AS distance FROM s ORDER BY x, vec_id LIMIT 10""")
def knn_topk(spark, d):
    return similar.nearest(_read(spark, d, "embeddings"), 0, 10, F.col("label") < 5, "vec_id", "embedding", None).select("vec_id", F.round("distance", 6).alias("distance"))


def _ledger(spark, d):
    phase = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "view", "blocked").otherwise("post")
    purpose = F.element_at(F.array(*map(F.lit, ["personality", "patch_intent", "chat", "search", "other"])), (F.col("user_id") % 5 + 1).cast("int"))
    tokens = F.get_json_object("props", "$.k").try_cast("long")
    return _read(spark, d, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("timestamp"), F.concat(F.lit("m"), F.col("user_id") % 3).alias("model"), purpose.alias("purpose"), phase.alias("phase"), tokens.alias("input_tokens"), (tokens * 2).alias("output_tokens"), (tokens % 7).alias("cache_read_input_tokens"), F.coalesce(F.col("value"), F.lit(0.0)).alias("usd_cost"))


SQL_LEDGER = """led AS (SELECT event_id AS id, ts, 'm' || (user_id % 3) AS model, ['personality', 'patch_intent', 'chat', 'search', 'other'][user_id % 5 + 1] AS purpose, CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'blocked' ELSE 'post' END AS phase,
    TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS tok, coalesce(value, 0.0) AS usd FROM events)"""


@query(f"""WITH {SQL_LEDGER}, g AS (SELECT purpose, coalesce(sum(usd) FILTER (phase <> 'blocked'), 0.0) AS spend, count(*) FILTER (phase <> 'blocked') AS calls, count(*) FILTER (phase = 'blocked') AS blocked, CAST(coalesce(sum(tok) FILTER (phase <> 'blocked'), 0) AS BIGINT) AS input_tokens, CAST(coalesce(sum(tok * 2) FILTER (phase <> 'blocked'), 0) AS BIGINT) AS output_tokens, CAST(coalesce(sum(tok % 7) FILTER (phase <> 'blocked'), 0) AS BIGINT) AS cache_read_tokens FROM led WHERE ts >= TIMESTAMP '2024-01-08' GROUP BY 1)
    SELECT purpose, round(spend, 4) AS spend, calls, blocked, input_tokens, output_tokens, cache_read_tokens, round(spend / CASE purpose WHEN 'personality' THEN 15.0 WHEN 'patch_intent' THEN 3.0 END * 100, 4) AS percent_of_cap FROM g""")
def spend_digest(spark, d):
    out = spend.digest_by_purpose(_ledger(spark, d), F.lit("2024-01-08").cast(NTZ))
    return out.withColumn("spend", F.round("spend", 4)).withColumn("percent_of_cap", F.round("percent_of_cap", 4))


@query(f"WITH {SQL_LEDGER} SELECT model, round(sum(usd), 4) AS spend, count(*) AS calls FROM led WHERE ts >= TIMESTAMP '2024-01-08' AND phase <> 'blocked' GROUP BY 1")
def spend_by_model(spark, d):
    return spend.digest_by_model(_ledger(spark, d), F.lit("2024-01-08").cast(NTZ)).withColumn("spend", F.round("spend", 4))


@query(f"WITH {SQL_LEDGER} SELECT round(coalesce(sum(usd) FILTER (phase <> 'blocked'), 0.0), 4) AS total, round(coalesce(sum(usd) FILTER (phase <> 'blocked' AND ts >= TIMESTAMP '2024-01-15'), 0.0), 4) AS today, count(*) FILTER (phase = 'blocked') AS blocked, count(*) FILTER (phase = 'error') AS errors, round(coalesce(sum(usd) FILTER (phase <> 'blocked'), 0.0) / 30.0 * 100, 4) AS percent_of_cap FROM led WHERE ts >= TIMESTAMP '2024-01-08'")
def spend_totals(spark, d):
    out = spend.digest_totals(_ledger(spark, d), F.lit("2024-01-08").cast(NTZ), F.lit("2024-01-15 12:00:00").cast(NTZ))
    return out.select(*[F.round(c, 4).alias(c) if c in ("total", "today", "percent_of_cap") else F.col(c) for c in out.columns])


@query(f"""WITH {SQL_LEDGER}, t AS (SELECT id, purpose, usd, coalesce(sum(usd) OVER (PARTITION BY purpose ORDER BY epoch_us(ts) RANGE BETWEEN 604800000000 PRECEDING AND 1 PRECEDING), 0.0) AS p, coalesce(sum(usd) OVER (ORDER BY epoch_us(ts) RANGE BETWEEN 604800000000 PRECEDING AND 1 PRECEDING), 0.0) AS a FROM led)
    SELECT id, purpose, round(p, 4) AS purpose_trailing, round(a, 4) AS total_trailing, CASE WHEN p + usd > CASE purpose WHEN 'personality' THEN 15.0 WHEN 'patch_intent' THEN 3.0 END THEN 'purpose' WHEN a + usd > 30.0 THEN 'weekly' END AS breach FROM t""")
def spend_trailing(spark, d):
    return spend.audit_caps(_ledger(spark, d)).select("id", "purpose", F.round("purpose_trailing", 4).alias("purpose_trailing"), F.round("total_trailing", 4).alias("total_trailing"), "breach")


@query(f"""WITH p AS (SELECT * FROM (VALUES {_sql_values(PRICES)}) v(model, i, o)), u AS (SELECT 'm' || (l_suppkey % 3) AS model, l_quantity * 1000 AS a, l_linenumber * 500 AS b, l_quantity * 10 AS w5, l_quantity * 5 AS w1, l_quantity * 100 AS r FROM lineitem)
    SELECT model, count(*) AS n, round(sum((a * i + b * o + (w5 * 1.25 + w1 * 2.0 + r * 0.1) * i) / 1e6), 3) AS cost, round(sum((a * i * 1.25 + 8192 * o) / 1e6), 3) AS worst FROM u JOIN p USING (model) GROUP BY 1""")
def usage_cost(spark, d):
    prices = spark.createDataFrame(PRICES, "model string, input_per_mtok double, output_per_mtok double")
    q = F.col("l_quantity")
    usage = _read(spark, d, "lineitem").select(F.concat(F.lit("m"), F.col("l_suppkey") % 3).alias("model"), (q * 1000).alias("input_tokens"), (F.col("l_linenumber") * 500).alias("output_tokens"), (q * 10).alias("cache_write_5m_tokens"), (q * 5).alias("cache_write_1h_tokens"), (q * 100).alias("cache_read_tokens"))
    rows = spend.priced(usage, prices).join(whole_if_small(prices), "model").withColumn("worst", formulas.worst_case_cost(F.col("input_per_mtok"), F.col("output_per_mtok"), F.col("input_tokens"), F.lit(8192), F.lit(True)))
    return rows.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("usd_cost"), 3).alias("cost"), F.round(F.sum("worst"), 3).alias("worst"))


FEATURES = (Feature("balance", "minmax"), Feature("orders", "log1p_minmax", "mean"), Feature("spent", "zscore"))
SQL_CUSTOMERS = "c AS (SELECT c_custkey AS id, c_nationkey AS era_slug, c_acctbal AS balance, CASE WHEN n = 0 THEN NULL ELSE n END AS orders, spent FROM customer LEFT JOIN (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS n, sum(o_totalprice) AS spent FROM orders GROUP BY 1) o ON o_custkey = c_custkey)"


def _customers(spark, d):
    totals = _read(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).cast("double").alias("orders"), F.sum("o_totalprice").alias("spent"))
    return _read(spark, d, "customer").join(totals, F.col("c_custkey") == F.col("o_custkey"), "left").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("era_slug"), F.col("c_acctbal").alias("balance"), "orders", "spent")


@query(f"""WITH {SQL_CUSTOMERS}, s AS (SELECT *, min(balance) OVER w AS bl, max(balance) OVER w AS bh, min(ln(1 + orders)) OVER w AS ol, max(ln(1 + orders)) OVER w AS oh, avg(spent) OVER w AS sm, stddev_pop(spent) OVER w AS ss FROM c WINDOW w AS (PARTITION BY era_slug)),
    n AS (SELECT id, era_slug, CASE WHEN balance IS NULL THEN NULL WHEN bh <= bl THEN 0.5 ELSE (balance - bl) / (bh - bl) END AS balance, CASE WHEN orders IS NULL THEN NULL WHEN oh <= ol THEN 0.5 ELSE (ln(1 + orders) - ol) / (oh - ol) END AS orders, CASE WHEN spent IS NULL THEN NULL WHEN ss < 1e-9 THEN 0.5 ELSE 1 / (1 + exp(-(spent - sm) / ss)) END AS spent FROM s)
    SELECT id, era_slug, round(coalesce(CAST(CAST(balance AS FLOAT) AS DOUBLE), 0), 4) AS balance, round(CAST(CAST(coalesce(orders, avg(CAST(orders AS FLOAT)) OVER (PARTITION BY era_slug), 0.5) AS FLOAT) AS DOUBLE), 4) AS orders, round(coalesce(CAST(CAST(spent AS FLOAT) AS DOUBLE), 0), 4) AS spent FROM n""")
def features_norm(spark, d):
    rows = features.normalise(_customers(spark, d), FEATURES, ["era_slug"])
    return rows.select("id", "era_slug", *[F.round(F.col(f.name).cast("double"), 4).alias(f.name) for f in FEATURES])


@query("SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS idx FROM customer")
def node_index(spark, d):
    return features.dense_index(_read(spark, d, "customer").select("c_name"), [], "c_name")


@query("""WITH s AS (SELECT c_custkey, c_nationkey, row_number() OVER (ORDER BY c_custkey) - 1 AS src_idx FROM customer WHERE c_custkey % 7 <> 0), t AS (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS dst_idx FROM nation WHERE n_nationkey % 5 <> 0)
    SELECT src_idx, dst_idx FROM customer c JOIN s ON s.c_custkey = c.c_custkey JOIN t ON t.n_nationkey = c.c_nationkey""")
def edge_index(spark, d):
    c = _read(spark, d, "customer").select("c_custkey", "c_nationkey")
    one = F.lit("all").alias("era_slug")
    src = features.dense_index(c.where("c_custkey % 7 <> 0").select(one, F.col("c_custkey").alias("id")), ["era_slug"], "id")
    dst = features.dense_index(_read(spark, d, "nation").where("n_nationkey % 5 <> 0").select(one, F.col("n_nationkey").alias("id")), ["era_slug"], "id")
    edges = c.select(one, F.lit("customer").alias("src"), F.lit("lives_in").alias("relation"), F.lit("nation").alias("dst"), F.col("c_custkey").alias("src_id"), F.col("c_nationkey").alias("dst_id"), F.create_map().cast("map<string,double>").alias("attributes"))
    return features.edge_block(edges, ("customer", "lives_in", "nation"), src, dst, ()).select("src_idx", "dst_idx")


@query("""SELECT 'orphan_orders' AS rule_id, 'error' AS severity, (SELECT count(*) FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE c_custkey IS NULL) AS n, (SELECT count(*) FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE c_custkey IS NULL) = 0 AS passed
    UNION ALL SELECT 'discount_range', 'error', n, n = 0 FROM (SELECT count(*) AS n FROM lineitem WHERE l_discount < 0 OR l_discount > 1)
    UNION ALL SELECT 'negative_balance', 'warn', n, n <= 100 FROM (SELECT count(*) AS n FROM customer WHERE c_acctbal < 0)
    UNION ALL SELECT 'order_in_an_era', 'error', n, n = 0 FROM (SELECT count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-01')
    UNION ALL SELECT 'self_pairs', 'error', n, n = 0 FROM (SELECT count(*) AS n FROM lineitem WHERE l_partkey = l_suppkey)""")
def rules_report(spark, d):
    customer, orders, lines = (_read(spark, d, t) for t in ("customer", "orders", "lineitem"))
    in_era = eras.assign_era(orders.select("o_orderdate"), _eras(spark), "o_orderdate")
    rules = [
        quality.Rule("orphan_orders", "error", lambda s: quality.orphans(orders.select("o_custkey"), customer, customer, "o_custkey", "o_custkey", "c_custkey", "c_custkey").agg(F.count(F.lit(1)).alias("n"))),
        quality.count_rule("discount_range", "error", lines, quality.unit_range("l_discount")),
        quality.count_rule("negative_balance", "warn", customer, F.col("c_acctbal") < 0, 100),
        quality.count_rule("order_in_an_era", "error", in_era, F.col("era_slug").isNull()),
        quality.count_rule("self_pairs", "error", lines, F.col("l_partkey") == F.col("l_suppkey")),
    ]
    return quality.report(spark, rules)


@query("SELECT l_suppkey AS player_id, round(sum(l_quantity) / count(DISTINCT l_orderkey), 6) AS adr FROM lineitem GROUP BY 1")
def adr(spark, d):
    rows = _read(spark, d, "lineitem").select(F.col("l_suppkey").alias("player_id"), F.col("l_quantity").alias("damage"), F.col("l_orderkey").alias("round_id"))
    return derive.adr(rows).select("player_id", F.round("adr", 6).alias("adr"))


@query("""WITH k AS (SELECT CAST(ts AS DATE) AS r, min((ts, user_id, (user_id * 7) % 150)) AS f FROM events GROUP BY 1), p AS (SELECT user_id AS player_id, count(DISTINCT CAST(ts AS DATE)) AS n FROM events GROUP BY 1)
    SELECT player_id, round((SELECT count(*) FROM k WHERE f[2] = player_id) / n, 6) AS fb_rate, round((SELECT count(*) FROM k WHERE f[3] = player_id) / n, 6) AS fd_rate FROM p""")
def first_rates(spark, d):
    e = _read(spark, d, "events").select(F.to_date("ts").alias("round_id"), "ts", F.col("user_id").alias("killer_id"), ((F.col("user_id") * 7) % 150).alias("victim_id"))
    out = derive.first_rates(e, e.select(F.col("killer_id").alias("player_id"), "round_id"))
    return out.select("player_id", F.round("fb_rate", 6).alias("fb_rate"), F.round("fd_rate", 6).alias("fd_rate"))


@query("SELECT l_suppkey AS player_id, round(avg(CASE WHEN l_returnflag = 'R' OR l_linestatus = 'F' OR l_quantity > 40 OR l_discount = 0 THEN 1.0 ELSE 0.0 END), 6) AS kast FROM lineitem GROUP BY 1")
def kast_share(spark, d):
    rows = _read(spark, d, "lineitem").select(F.col("l_suppkey").alias("player_id"), (F.col("l_returnflag") == "R").alias("kill"), (F.col("l_linestatus") == "F").alias("assist"), (F.col("l_quantity") > 40).alias("survived"), (F.col("l_discount") == 0).alias("traded"))
    return derive.kast(rows).select("player_id", F.round("kast", 6).alias("kast"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS credit_efficiency, CASE WHEN l_returnflag = 'R' THEN l_tax ELSE 0.0 END AS save_value_lost FROM lineitem")
def economy(spark, d):
    rows = _read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("damage_dealt"), F.col("l_quantity").alias("credits_spent"), (F.col("l_returnflag") == "R").alias("round_lost"), F.col("l_tax").alias("saved_loadout_value"))
    return derive.economy(rows).select("l_orderkey", "l_linenumber", "credit_efficiency", "save_value_lost")


@query("""WITH e AS (SELECT 'in_region' AS kind, 'nation' AS src_type, CAST(n_nationkey AS VARCHAR) AS src_id, 'region' AS dst_type, CAST(n_regionkey AS VARCHAR) AS dst_id FROM nation UNION ALL SELECT 'lives_in', 'customer', CAST(c_custkey AS VARCHAR), 'nation', CAST(c_nationkey AS VARCHAR) FROM customer UNION ALL SELECT 'supplies', 'supplier', CAST(l_suppkey AS VARCHAR), 'part', CAST(l_partkey AS VARCHAR) FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem))
    SELECT kind, src_type, dst_type, src_id, count(*) AS n, max(dst_id) AS last_dst FROM e GROUP BY ALL""")
def edges_long(spark, d):
    lines = _read(spark, d, "lineitem").select("l_suppkey", "l_partkey", F.pmod(F.xxhash64("l_partkey"), F.lit(16)).alias("part"))
    # A supplier's parts lie in up to 16 tasks, of as many as the lines need.
    pairs = lines.repartition(tasks_for(lines), "l_suppkey", "part").distinct()
    parts = {"in_region": (_read(spark, d, "nation"), "nation", "n_nationkey", "region", "n_regionkey"), "lives_in": (_read(spark, d, "customer"), "customer", "c_custkey", "nation", "c_nationkey"), "supplies": (pairs, "supplier", "l_suppkey", "part", "l_partkey")}
    return derive.long_edges(parts, {"lives_in": {"segment": F.col("c_mktsegment")}}).groupBy("kind", "src_type", "dst_type", "src_id").agg(F.count(F.lit(1)).alias("n"), F.max("dst_id").alias("last_dst"))


@query("SELECT n_name, r_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def history_tables(spark, d):
    nation, region = _read(spark, d, "nation"), _read(spark, d, "region")
    edges = derive.long_edges({"in_region": (nation, "nation", "n_nationkey", "region", "n_regionkey")})
    names = nation.select(F.lit("nation").alias("type"), F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")).unionByName(region.select(F.lit("region").alias("type"), F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("name")))
    table = derive.history(edges, "in_region", names, "n_name", "r_name")
    lives = _read(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("src_id"))
    return lives.join(table, "src_id").groupBy("n_name", "r_name").agg(F.count(F.lit(1)).alias("customers"))


@query("""WITH n AS (SELECT DISTINCT lower(p_name) AS x FROM part), s AS (SELECT a.x AS left_id, b.x AS right_id, CASE WHEN a.x = b.x THEN 1.0 ELSE jaro_winkler_similarity(a.x, b.x) END AS score FROM n a JOIN n b ON a.x[1:2] = b.x[1:2])
    SELECT left_id, right_id, round(score, 6) AS score, CASE WHEN score >= 0.92 THEN 'match' ELSE 'review' END AS verdict FROM s WHERE score >= 0.78""")
def name_match(spark, d):
    names = _read(spark, d, "part").select(F.lower("p_name").alias("id"), F.lower("p_name").alias("name")).distinct()
    return resolve.blocked_matches(names, names).withColumn("score", F.round("score", 6))


@query("""WITH v AS (SELECT c_custkey, 'segment' AS field, s AS source, CASE s WHEN 'a' THEN c_mktsegment WHEN 'b' THEN CASE WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END ELSE c_name END AS value, CASE s WHEN 'a' THEN 2 WHEN 'b' THEN 1 ELSE 3 END AS r FROM customer, (VALUES ('a'), ('b'), ('c')) t(s) WHERE NOT (s = 'b' AND c_custkey % 4 = 0)),
    w AS (SELECT c_custkey, field, min((r, source, value)) AS m FROM v GROUP BY 1, 2)
    SELECT c_custkey, field, m[3] AS value, m[2] AS source, (SELECT count(*) FROM v WHERE v.c_custkey = w.c_custkey AND v.value <> m[3]) AS conflicts FROM w""")
def priority_merge(spark, d):
    c = _read(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    b = F.when(F.col("c_custkey") % 3 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    sides = F.array(*[F.struct(F.lit(s).alias("source"), v.alias("value"), F.lit(i).alias("arrival")) for i, (s, v) in enumerate({"a": F.col("c_mktsegment"), "b": b, "c": F.col("c_name")}.items())])
    values = c.select("c_custkey", F.lit("segment").alias("field"), F.explode(sides).alias("s")).select("c_custkey", "field", "s.*").where("not (source = 'b' and c_custkey % 4 = 0)")
    merged, conflicts = merge.merge_sources(values, ["c_custkey"], {"a": 2, "b": 1, "c": 3})
    n = conflicts.groupBy("c_custkey", "field").agg(F.count(F.lit(1)).alias("conflicts"))
    return merged.join(n, ["c_custkey", "field"], "left").withColumn("conflicts", F.coalesce("conflicts", F.lit(0)))


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1")
def source_mix(spark, d):
    return similar.source_mix(_read(spark, d, "documents"))


@query("SELECT doc_id FROM documents WHERE text ILIKE '%password%' OR text ILIKE '%token =%'")
def text_search(spark, d):
    return similar.search_text(_read(spark, d, "documents").select("doc_id", "text"), "text", "%password%", "%token =%").select("doc_id")


@query("SELECT conv_id, turn, md5(concat_ws(chr(10), '# ' || trim(role), '## Notes', trim(text), CASE WHEN turn % 2 = 0 THEN '## Blog' END, CASE WHEN turn % 2 = 0 THEN 'turn ' || turn END)) AS request FROM conversations")
def request_text(spark, d):
    blog = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("turn "), F.col("turn").cast("string")))
    return _read(spark, d, "conversations").select("conv_id", "turn", F.md5(parse.request_text(F.col("role"), F.col("text"), blog)).alias("request"))


@query(r"""SELECT page_id FROM (SELECT page_id, CASE WHEN p = '' THEN '/' ELSE p END AS p FROM (SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS p FROM pages WHERE url IS NOT NULL)) WHERE NOT (starts_with(p, '/de') OR starts_with(p, '/fr/2'))""")
def url_filter(spark, d):
    rules = spark.createDataFrame(ROBOTS, "agent string, prefix string")
    return page_source.allowed_urls(_read(spark, d, "pages"), rules, "OurBot/1.0").select("page_id")


@query("SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1, 2")
def props_json(spark, d):
    """Events as lines of a typed log, each kind read with its own fields."""
    e = _read(spark, d, "events")
    line = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("kind"), F.col("ts").cast("string").alias("ts"), F.get_json_object("props", "$.k").try_cast("int").alias("k")))
    kinds = {r[0]: "k int" for r in e.select("event_type").distinct().collect()}  # the kinds of a log are few
    typed, _ = read_events(e.select(line.alias("value")), kinds)
    return reduce(DataFrame.unionByName, typed.values()).groupBy(F.col("kind").alias("event_type"), "k").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def ids_union(spark, d):
    return _read(spark, d, "customer").select(F.col("c_nationkey").alias("nation")).unionByName(_read(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"))).distinct()


@query("SELECT l_returnflag, round(sum(l_extendedprice) / nullif(sum(CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_quantity END), 0), 6) AS ratio FROM lineitem GROUP BY 1")
def throughput(spark, d):
    work = F.when(F.col("l_returnflag") == "N", 0.0).otherwise(F.col("l_quantity"))
    rows = _read(spark, d, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("duration_seconds"), work.alias("wallclock_seconds"), F.col("l_linestatus").alias("language"))
    return similar.throughput(rows, "l_returnflag").select("l_returnflag", F.round("ratio", 6).alias("ratio"))


@query("SELECT event_id, ts FROM events WHERE ts IS NULL OR ts > greatest(TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-05')")
def since_floor(spark, d):
    floor = F.greatest(F.lit("2024-01-10").cast(NTZ), F.lit("2024-01-05").cast(NTZ))
    return since(_read(spark, d, "events").select("event_id", "ts"), "ts", floor)


@query("SELECT CASE WHEN s_name LIKE '%-%' THEN s_name ELSE 'supplier-' || s_name END AS new_key, 'nation-' || s_nationkey AS nation_key FROM supplier")
def key_rewrite(spark, d):
    return _read(spark, d, "supplier").select(parse.rekeyed(F.lit("supplier"), F.col("s_name")).alias("new_key"), parse.namespaced(F.lit("nation"), F.col("s_nationkey").cast("string")).alias("nation_key"))


@query("WITH x AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) SELECT o_custkey, o_orderkey, o_orderdate FROM x WHERE n = 1")
def latest_per_key(spark, d):
    return merge.latest_per_key(_read(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], "o_orderdate")


@query("SELECT CAST(CAST(CAST(o_orderdate AS DATE) - CAST((epoch(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) // 86400) % 7 AS INTEGER) AS DATE) AS VARCHAR) AS chunk_start, count(*) AS n FROM orders GROUP BY 1")
def backfill_chunks(spark, d):
    return merge.chunked_overwrite(_read(spark, d, "orders").select("o_orderdate"), "o_orderdate").groupBy(F.col("chunk_start").cast("string").alias("chunk_start")).agg(F.count(F.lit(1)).alias("n"))


#: The pages' links are plain: an address, a text without elements in it, and few kinds of character references.
SQL_PLAIN = "replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


@query(f"""WITH a AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]+)"[^>]*>([^<]*)</a>', 1) AS h, regexp_extract_all(html, '<a href="([^"]+)"[^>]*>([^<]*)</a>', 2) AS t FROM pages WHERE html IS NOT NULL)
    SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, {SQL_PLAIN.format("h[i]")} AS href, trim({SQL_PLAIN.format("t[i]")}) AS text, CAST(NULL AS VARCHAR) AS match_id, CAST(NULL AS VARCHAR) AS utc_ts FROM a, unnest(range(1, len(h) + 1)) u(i)""")
def page_links(spark, d):
    return page_source.anchors(_read(spark, d, "pages"))


@query()
def article_text(spark, d):
    return page_source.articles(_read(spark, d, "pages"))


@query()
def entity_resolution(spark, d):
    """Part names as handles of a batch against the aliases of every third part; in their order, so no SQL (tests hold it to a loop)."""
    parts = _read(spark, d, "part").select("p_partkey", "p_name").groupBy("p_name").agg(F.min("p_partkey").alias("key"))
    t = F.lit("2024-01-01").cast("timestamp")
    known = parts.where("key % 3 = 0")
    aliases = known.select(F.col("key").cast("string").alias("canonical_id"), F.lit("a").alias("platform"), F.concat(F.lit("a"), F.col("key")).alias("platform_id"), F.col("p_name").alias("platform_name"), F.lit(1.0).alias("confidence"), t.alias("valid_from"))
    entities = known.select(F.col("key").cast("string").alias("canonical_id"), F.lit("part").alias("entity_type"), F.lit(True).alias("is_active"), t.alias("created_at"))
    handles = parts.select(F.lit("a").alias("platform"), F.concat(F.lit("a"), F.col("key")).alias("platform_id"), F.col("p_name").alias("platform_name"), F.lit("part").alias("entity_type"), t.alias("created_at"), F.lpad(F.col("key").cast("string"), 12, "0").alias("id"))
    return resolve.resolve(handles, aliases, entities)["resolved"].select("platform_id", "status", "canonical_id", F.round("confidence", 6).alias("confidence"))


@query()
def snapshot_fingerprint(spark, d):
    """One hash a nation over its customers' features, whatever the order of rows."""
    return publish.tree_fingerprint(features.normalise(_customers(spark, d), FEATURES, ["era_slug"]), ["era_slug"])
