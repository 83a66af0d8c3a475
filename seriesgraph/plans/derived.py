"""Queries whose inputs are texts that Spark derives from the given tables: pages, titles, payloads, replies.

What a parser should find in them is known from the columns they were made of, which is what the SQL computes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse
from ..operators import eras, merge, resolve
from ..sources import pages as page_source
from . import ingest
from .queries import NTZ, _read, query

#: Dirty numbers, in words that both engines have.
NUMBER_TEXT = "CASE l_linenumber % 6 WHEN 0 THEN ' ' || CAST(l_quantity AS STRING) || ' ' WHEN 1 THEN CAST(l_partkey AS STRING) || 'd' WHEN 2 THEN '' WHEN 3 THEN CAST(l_partkey % 101 AS STRING) || '%' WHEN 4 THEN '-' ELSE '+' || CAST(l_partkey AS STRING) END"
NUMBER = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"


@query(rf"""WITH x AS (SELECT l_linenumber % 6 AS k, trim({NUMBER_TEXT}) AS x FROM lineitem), y AS (SELECT k, x, regexp_replace(regexp_replace(x, '%$', ''), '^\+', '') AS p FROM x),
    v AS (SELECT k, CASE WHEN regexp_full_match(x, '{NUMBER}') THEN TRY_CAST(x AS DOUBLE) END AS d, CASE WHEN regexp_full_match(p, '{NUMBER}') THEN TRY_CAST(p AS DOUBLE) END AS p FROM y)
    SELECT k, count(d) AS numbers, round(sum(d), 2) AS total, count(CASE WHEN d = floor(d) THEN 1 END) AS whole, round(sum(p), 2) AS percents FROM v GROUP BY 1""")
def dirty_numbers(spark, d):
    x = F.col("x")
    rows = _read(spark, d, "lineitem").select((F.col("l_linenumber") % 6).alias("k"), F.expr(NUMBER_TEXT).alias("x"))
    rows = rows.select("k", parse.permissive_double(x).alias("d"), parse.whole_int(x).alias("w"), parse.percent(x).alias("p"))
    return rows.groupBy("k").agg(F.count("d").alias("numbers"), F.round(F.sum("d"), 2).alias("total"), F.count("w").alias("whole"), F.round(F.sum("p"), 2).alias("percents"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN epoch_us(o_orderdate) WHEN 1 THEN epoch_us(o_orderdate) - 7200000000 END AS micros,
    CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' END AS day FROM orders""")
def dirty_moments(spark, d):
    """Times with Z, an offset or none, and days that some years do not have."""
    key = F.col("o_orderkey")
    moment = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.when(key % 3 == 0, "Z").when(key % 3 == 1, "+02:00").otherwise(""))
    day = F.when(key % 5 == 0, "1996-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return _read(spark, d, "orders").select("o_orderkey", F.unix_micros(parse.iso_timestamp(moment, naive="null")).alias("micros"), F.date_format(parse.iso_date(day), "yyyy-MM-dd HH:mm:ss").alias("day"))


@query("""WITH p AS (SELECT p_partkey, p_partkey % 13 || '.' || lpad(CAST(p_size AS VARCHAR), 2, '0') || CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'b' ELSE '.' || p_size % 4 END AS v, p_size FROM part)
    SELECT p_partkey, v AS version, CAST(p_partkey AS VARCHAR) AS profile, CASE WHEN p_partkey % 2 = 0 THEN 'slug-' || p_size END AS slug FROM p""")
def titles_and_links(spark, d):
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    tail = F.when(key % 3 == 0, "").when(key % 3 == 1, "b are here").otherwise(F.concat(F.lit("."), (F.col("p_size") % 4).cast("string"), F.lit(" now")))
    title = F.concat(F.lit("The Patch Notes "), (key % 13).cast("string"), F.lit("."), F.lpad(size, 2, "0"), tail)
    href = F.concat(F.lit("/player/"), key.cast("string"), F.when(key % 2 == 0, F.concat(F.lit("/slug-"), size, F.lit("?x=1"))).otherwise("/"))
    slug = F.nullif(parse.profile_slug(href, "player"), F.lit(""))
    return _read(spark, d, "part").select("p_partkey", parse.patch_version(title).alias("version"), parse.profile_id(href, "player").alias("profile"), slug.alias("slug"))


@query("SELECT conv_id, md5(coalesce(string_agg(CASE WHEN trim(text) <> '' THEN trim(text) END, ' ' ORDER BY turn, text), '')) AS body, round(CAST(sum(turn * 1.5) AS DOUBLE), 3) AS seconds FROM conversations GROUP BY 1")
def segments_joined(spark, d):
    rows = _read(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("turns"))
    segments = F.transform("turns", lambda t: F.struct(F.lit(0.0).alias("start"), (t["turn"] * 1.5).cast("double").alias("end"), t["text"].alias("text")))
    return rows.select("conv_id", F.md5(parse.segment_text(segments)).alias("body"), F.round(parse.segment_seconds(segments), 3).alias("seconds"))


@query("SELECT event_id, CASE WHEN event_id % 4 IN (0, 2) THEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k FROM events")
def fenced_replies(spark, d):
    """Objects in replies, some of them fenced, some no objects."""
    key, props = F.col("event_id"), F.col("props")
    reply = F.when(key % 4 == 0, F.concat(F.lit("```json\n"), props, F.lit("\n```"))).when(key % 4 == 1, "[1]").when(key % 4 == 2, props).otherwise("no object")
    return _read(spark, d, "events").select("event_id", parse.json_object(reply, "k int")["k"].alias("k"))


@query("""SELECT c_custkey AS id, CASE c_nationkey % 3 WHEN 0 THEN 'vlr' WHEN 1 THEN 'riot_api' END AS platform, CASE c_custkey % 4 WHEN 0 THEN 'p' || c_custkey WHEN 1 THEN 's' || c_custkey WHEN 2 THEN 'old' || c_custkey END AS platform_id,
    CASE WHEN c_custkey % 4 < 3 THEN c_name END AS platform_name, CASE WHEN c_custkey % 4 = 2 THEN 's' || c_custkey END AS new_platform_id, c_custkey % 4 = 3 OR c_nationkey % 3 = 2 AS miss FROM customer""")
def handles_extracted(spark, d):
    key = F.col("c_custkey").cast("string")
    text = lambda **kv: F.to_json(F.struct(*[F.concat(F.lit(p), c).alias(k) for k, (p, c) in kv.items()]))
    payload = (
        F.when(F.col("c_custkey") % 4 == 0, text(platform_id=("p", key), platform_name=("", F.col("c_name"))))
        .when(F.col("c_custkey") % 4 == 1, text(slug=("s", key), name=("", F.col("c_name"))))
        .when(F.col("c_custkey") % 4 == 2, text(slug=("s", key), previous_slug=("old", key), display_name=("", F.col("c_name"))))
        .otherwise('{"odd": 1}')
    )
    source = F.when(F.col("c_nationkey") % 3 == 0, "vlr").when(F.col("c_nationkey") % 3 == 1, "riot").otherwise("nowhere")
    staging = _read(spark, d, "customer").select(F.col("c_custkey").alias("id"), source.alias("source"), payload.alias("payload"))
    return resolve.extract_handles(staging, now="2024-01-01").select("id", "platform", "platform_id", "platform_name", "new_platform_id", "miss")


@query("""WITH a AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey % 3 <> 0), m AS (SELECT c.c_custkey, o.c_nationkey AS before, n.c_nationkey AS after FROM customer c LEFT JOIN a o ON o.c_custkey = c.c_custkey LEFT JOIN a n ON n.c_custkey = c.c_custkey + 1)
    SELECT CASE WHEN before IS NULL THEN 'unknown' WHEN after IS NULL THEN 'added' WHEN after = before THEN 'same' ELSE 'conflict' END AS outcome, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM m GROUP BY 1""")
def rebrand_outcomes(spark, d):
    c = _read(spark, d, "customer").select("c_custkey", "c_nationkey", "c_name")
    aliases = c.where("c_custkey % 3 <> 0").select(F.lit("x").alias("platform"), F.col("c_custkey").cast("string").alias("platform_id"), F.col("c_nationkey").alias("canonical_id"))
    moves = c.select("c_custkey", F.lit("x").alias("platform"), F.col("c_custkey").cast("string").alias("platform_id"), (F.col("c_custkey") + 1).cast("string").alias("new_platform_id"))
    return resolve.rebrands(moves, aliases).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))


@query("""SELECT 'm' || l_orderkey AS map_result_id, 'c' || l_linenumber AS entity_id, CASE WHEN l_linenumber % 2 = 0 THEN 'team1' ELSE 'team2' END AS team_side, lower(l_returnflag) AS agent, CAST(l_discount AS DOUBLE) AS rating, CAST(l_quantity AS DOUBLE) AS acs,
    CAST(l_partkey % 40 AS INTEGER) AS kills, CAST(l_suppkey % 30 AS INTEGER) AS deaths, CAST(l_linenumber AS INTEGER) AS assists, CAST(l_partkey % 100 AS DOUBLE) AS kast_pct, CAST(l_tax AS DOUBLE) AS adr, CAST(l_suppkey % 100 AS DOUBLE) AS hs_pct,
    CAST(l_partkey % 9 AS INTEGER) AS first_kills, CASE WHEN l_linenumber <> 3 THEN CAST(l_suppkey % 7 AS INTEGER) END AS first_deaths FROM lineitem WHERE l_linenumber <> 6 AND l_orderkey % 4 <> 0
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_returnflag, l_discount, l_tax) = 1""")
def match_stats(spark, d):
    """Match pages made of orders: a row a line; a player whom no alias has, and maps that are not known, give none."""
    text = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    cell = lambda c: F.concat(F.lit("<td>"), text(c), F.lit("</td>"))
    n = F.col("l_linenumber")
    numbers = ["l_discount", "l_quantity", F.col("l_partkey") % 40, F.col("l_suppkey") % 30, n, F.lit("+3"), F.concat(text(F.col("l_partkey") % 100), F.lit("%")), "l_tax", F.concat(text(F.col("l_suppkey") % 100), F.lit("%")), F.col("l_partkey") % 9, F.when(n == 3, "").otherwise(text(F.col("l_suppkey") % 7)), F.lit("-1")]
    row = F.concat(F.lit('<tr class="mod-t'), F.when(n % 2 == 0, "1").otherwise("2"), F.lit('"><td><a href="/player/'), text(n), F.lit('/x">N</a></td><td><img alt="odd" title="'), F.col("l_returnflag"), F.lit('"></td>'), *map(cell, numbers), F.lit("</tr>"))
    rest = ["l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_discount", "l_tax"]
    lines = _read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct(*rest)).alias("first")).select("l_orderkey", "l_linenumber", "first.*")
    rows = lines.select("l_orderkey", "l_linenumber", row.alias("row")).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "row"))).alias("rows"))
    html = F.concat(F.lit('<html><body><div data-game-id="g'), text("l_orderkey"), F.lit('"><table>'), F.array_join(F.transform("rows", lambda r: r["row"]), ""), F.lit("</table></div></body></html>"))
    found = rows.select(F.col("l_orderkey").alias("page_id"), html.alias("html"))
    maps = rows.where("l_orderkey % 4 <> 0").select(F.concat(F.lit("g"), text("l_orderkey")).alias("site_game_id"), F.concat(F.lit("m"), text("l_orderkey")).alias("map_result_id"))
    players = lines.select("l_linenumber").distinct().where("l_linenumber <> 6")
    aliases = players.select(F.concat(F.lit("c"), text("l_linenumber")).alias("canonical_id"), F.lit("vlr").alias("platform"), F.concat(F.lit("player-"), text("l_linenumber")).alias("platform_id"))
    stored = spark.createDataFrame([], "map_result_id string, entity_id string")
    return ingest.backfill_stats(found, maps, aliases, stored)["stats"]


@query("""SELECT o_orderkey AS page_id, 'Patch Notes ' || o_orderkey % 9 || '.0' || o_orderkey % 7 || '.1' AS title, o_orderkey % 9 || '.0' || o_orderkey % 7 || '.1' AS patch_version, epoch_us(o_orderdate) AS micros,
    'Patch Notes ' || o_orderkey % 9 || '.0' || o_orderkey % 7 || '.1' || chr(10) || 'Customer & ' || o_custkey || chr(10) || 'last words' AS body_text FROM orders""")
def article_parts(spark, d):
    """Articles made of orders, with chrome around and in them."""
    key = F.col("o_orderkey")
    title = F.concat(F.lit("Patch Notes "), (key % 9).cast("string"), F.lit(".0"), (key % 7).cast("string"), F.lit(".1"))
    html = F.concat(
        F.lit("<html><head><title>x</title></head><body><nav>menu</nav><article><h1>"), title, F.lit('</h1><time datetime="'), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit('Z"></time><script>var a = "<p>";</script><p>Customer &amp;  '), F.col("o_custkey").cast("string"), F.lit("</p><aside>ad</aside>\n\n<div>  last\t words </div></article><footer>end</footer></body></html>"),
    )
    found = page_source.articles(_read(spark, d, "orders").select(key.alias("page_id"), html.alias("html")))
    return found.where("not drift").select("page_id", "title", "patch_version", F.unix_micros("published_at").alias("micros"), "body_text")


SQL_PAYLOAD = """'{"payload":{"props":{"k":' || coalesce(json_extract_string(props, '$.k'), '0') || '},"type":"' || event_type || '","user":' || user_id || '},"source":"app"}'"""


@query(f"WITH h AS (SELECT event_id % 2 AS odd, sha256({SQL_PAYLOAD}) AS content_hash FROM events) SELECT content_hash, count(*) AS copies FROM h WHERE odd = 0 AND content_hash NOT IN (SELECT content_hash FROM h WHERE odd = 1) GROUP BY 1")
def payload_dedup(spark, d):
    """Payloads with even ids arrive after those with odd ones, with their keys in another order: the new contents."""
    e, user = _read(spark, d, "events"), F.col("user_id").cast("string")
    props = F.coalesce("props", F.lit('{"k": 0}'))
    one = F.concat(F.lit('{"user": '), user, F.lit(', "type": "'), F.col("event_type"), F.lit('", "props": '), props, F.lit("}"))
    other = F.concat(F.lit('{"props":'), props, F.lit(',"user":'), user, F.lit(',  "type":"'), F.col("event_type"), F.lit('"}'))
    rows = e.select((F.col("event_id") % 2).alias("odd"), F.lit("app").alias("source"), F.when(F.col("event_id") % 2 == 1, one).otherwise(other).alias("payload"))
    rows = rows.withColumn("content_hash", parse.content_hash(F.col("source"), F.col("payload"))).drop("payload")
    incoming = rows.where("odd = 0").select("source", "content_hash")
    new = merge.append_unseen(rows.where("odd = 1"), incoming, ["source", "content_hash"])
    return incoming.join(new, ["source", "content_hash"], "left_semi").groupBy("content_hash").agg(F.count(F.lit(1)).alias("copies"))


@query("""WITH s AS (SELECT o_custkey, o_orderkey, o_orderdate AS s, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate + INTERVAL 60 DAY END AS e FROM orders), w AS (SELECT *, lag(e) OVER x AS pe, lag(s) OVER x AS ps, lead(s) OVER x AS ns FROM s WINDOW x AS (PARTITION BY o_custkey ORDER BY s, o_orderkey)),
    f AS (SELECT CASE WHEN e IS NULL AND ns IS NOT NULL THEN 'open_not_last' WHEN ps IS NOT NULL AND pe > s THEN 'overlap' WHEN ps IS NOT NULL AND pe < s THEN 'gap' END AS fault FROM w) SELECT fault, count(*) AS n FROM f WHERE fault IS NOT NULL GROUP BY 1""")
def sequence_faults(spark, d):
    """Each customer's orders as windows of 60 days, some of them open: what breaks their sequence."""
    start = F.col("o_orderdate").cast(NTZ)
    end = F.when(F.col("o_orderkey") % 10 != 0, start + F.expr("INTERVAL 60 DAYS"))
    rows = _read(spark, d, "orders").select("o_custkey", F.col("o_orderkey").alias("era_slug"), start.alias("start_date"), end.alias("end_date"))
    return eras.sequence_faults(rows, ["o_custkey"]).groupBy("fault").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH r AS (SELECT CAST(o_custkey % 7 AS VARCHAR) AS ev, CAST(o_custkey % 20 AS VARCHAR) AS t1, CAST((o_custkey + 1) % 20 AS VARCHAR) AS t2, o_orderkey % 13 = 0 AS undated, o_orderkey % 17 = 0 AS odd, o_orderkey % 5 = 0 AS known FROM orders WHERE o_orderkey % 11 <> 0)
    SELECT 'team' AS kind, count(*) AS n FROM (SELECT t1 FROM r WHERE t1 <> '0' UNION SELECT t2 FROM r WHERE t2 <> '0') UNION ALL SELECT 'tournament', count(DISTINCT ev) FROM r WHERE ev <> '0'
    UNION ALL SELECT 'match', count(*) FROM r WHERE NOT odd AND NOT undated AND NOT known UNION ALL SELECT 'map', count(*) FROM r WHERE NOT odd AND (known OR NOT undated) UNION ALL SELECT 'quarantine', count(*) FROM r WHERE odd OR undated AND NOT known""")
def seed_counts(spark, d):
    """A map-level CSV made of orders, with sentinel dates, ids that name nothing, malformed rows and known matches."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda c: c.cast("string")
    date = F.when(key % 11 == 0, "1970-01-01").when(key % 13 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    own = {"MatchID": text(key), "GameID": F.concat(F.lit("g"), text(key)), "EventID": text(cust % 7), "Date": date, "Team1ID": text(cust % 20), "Team2ID": text((cust + 1) % 20), "Team1 Name": F.concat(F.lit("T"), text(cust % 20)), "Team2 Name": F.concat(F.lit("T"), text((cust + 1) % 20)), "Event Name": F.concat(F.lit("E"), text(cust % 7)), "Map": F.when(key % 17 == 0, "x").otherwise("1")}
    orders = _read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rows = orders.select(*[own.get(c, F.lit("1")).alias(c) for c in ingest.CSV_COLUMNS])
    matches = orders.where("o_orderkey % 5 = 0").select(text(key).alias("site_match_id"))
    out = ingest.seed_maps(rows, matches, spark.createDataFrame([], "site_game_id string"))
    counted = lambda kind, rows: rows.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"))
    parts = [out["entities"].groupBy(F.col("entity_type").alias("kind")).agg(F.count(F.lit(1)).alias("n")), counted("match", out["matches"]), counted("map", out["maps"]), counted("quarantine", out["quarantine"])]
    return reduce(DataFrame.unionByName, parts)
