"""Operators on hand-built rows: the cases that the table queries can't show."""

import json
import math
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from seriesgraph.functions import formulas, names, parse
from seriesgraph.operators import derive, eras, features, merge, publish, quality, relations, resolve, scans, similar, spend
from seriesgraph.operators.schema import EDGES, NODES, Feature
from seriesgraph.plans import ingest
from seriesgraph.sources import pages, tables
from seriesgraph.streaming import incremental, passes

T = datetime(2024, 1, 1)


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(("text", "value"), [(" 1.5 ", 1.5), ("", None), (None, None), ("12d", None), ("NaN", None), ("1_000", None), ("1e3", 1000.0), ("-2", -2.0)])
def test_permissive_double(spark, text, value):
    assert one(spark, text, parse.permissive_double) == value


@pytest.mark.parametrize(("text", "value"), [("13.0", 13), ("13.5", None), ("x", None), ("7", 7)])
def test_whole_int(spark, text, value):
    assert one(spark, text, parse.whole_int) == value


def test_dates_and_versions(spark):
    assert one(spark, "75%", parse.percent) == 75.0 and one(spark, "-", parse.percent) is None
    assert one(spark, "2024", parse.iso_date) is None and one(spark, "2024-02-30", parse.iso_date) is None
    assert one(spark, "2024-02-03", lambda c: parse.iso_date(c).cast("string")) == "2024-02-03 00:00:00"
    text = lambda naive: (lambda c: parse.iso_timestamp(c, naive).cast("string"))
    assert one(spark, "2024-01-01T10:00:00Z", text("utc")) == "2024-01-01 10:00:00"
    assert one(spark, "2024-01-01T10:00:00+02:00", text("null")) == "2024-01-01 08:00:00"
    assert one(spark, "2024-01-01T10:00:00", text("utc")) == "2024-01-01 10:00:00" and one(spark, "2024-01-01T10:00:00", text("null")) is None
    assert one(spark, "Patch Notes 8.05b are here", parse.patch_version) == "8.05b" and one(spark, "News", parse.patch_version) is None
    assert one(spark, "/player/9/tenz", lambda c: parse.profile_id(c, "player")) == "9" and one(spark, "/players/9", lambda c: parse.profile_id(c, "player")) is None


def test_content_hash_ignores_key_order(spark):
    h = lambda s: one(spark, s, lambda c: parse.content_hash(F.lit("s"), c))
    assert h('{"a":1,"b":{"x":[1,2],"y":null}}') == h('{"b":{"y":null,"x":[1,2]},"a":1}')
    assert h('{"l":[{"a":1,"b":{"c":{"d":{"e":1,"f":2}}}}]}') == h('{"l":[{"b":{"c":{"d":{"f":2,"e":1}}},"a":1}]}')
    apart = ['{"a":"1,b=2"}', '{"a":"1","b":"2"}', '{"a":1,"b":2}', '{"x":null}', '{"x":"null"}', "null", None, "", '"plain"', "plain", "[" * 100_000]
    assert len({h(x) for x in apart}) == len(apart)
    import hashlib

    assert h('{"b": [1, 2.5], "a": "é"}') == hashlib.sha256(b'{"payload":{"a":"\\u00e9","b":[1,2.5]},"source":"s"}').hexdigest()
    assert h('{"a":1}') != h('{"a":2}') and h('{"a":[1,2]}') != h('{"a":[2,1]}') and h("plain") != h("other")


def test_json_object(spark):
    f = lambda s: one(spark, s, lambda c: F.to_json(parse.json_object(c, "a int")))
    assert json.loads(f('```json\n{"a": 3}\n```'))["a"] == 3 and f("[1]") is None and f("{bad") is None


def test_chunks(spark):
    f = lambda s, n: one(spark, s, lambda c: F.to_json(parse.word_chunks(c, n)))
    assert f("a b  c\nd e", 2) == '["a b","c d","e"]' and f("  ", 2) == "[]" and f(None, 2) == "[]"


def test_segments(spark):
    s = spark.range(1).select(F.expr("array(named_struct('start',0.0D,'end',1.5D,'text',' a '), named_struct('start',2.0D,'end',3.0D,'text','  '), named_struct('start',3.0D,'end',4.0D,'text','b'))").alias("s"))
    assert tuple(s.select(parse.segment_text(F.col("s")), parse.segment_seconds(F.col("s"))).first()) == ("a b", 3.5)


def test_decay_pinned_and_composed(spark):
    d = lambda w: spark.range(1).select(formulas.decay_strength(F.lit(1.0), F.lit("teammate"), F.lit(float(w)))).first()[0]
    assert abs(d(20) - 0.6703200460356393) < 1e-12 and abs(d(8) * d(12) - d(20)) < 1e-12
    with pytest.raises(Exception, match="no decay"):
        spark.range(1).select(formulas.decay_strength(F.lit(1.0), F.lit("foe"), F.lit(1.0))).collect()


def test_weighted_ratio_pins():
    norm = lambda s: "".join(c if c.isalnum() else " " for c in s.lower()).strip()
    r = lambda a, b: names.weighted_ratio(norm(a), norm(b))
    assert round(r("Less 2024", "Aspas 2024"), 4) == 0.7368 and r("TenZ", "tenz") >= 0.90
    assert 0.70 <= r("Sentinal", "Sentinel") < 0.90 and abs(r("Sentinal", "Sentinel") - 0.875) < 1e-9 and r("", "x") == 0.0


def test_jaro_winkler_against_duckdb():
    import duckdb

    rng = random.Random(0)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    for a, b in zip(words, words[1:]):
        assert abs(names.jaro_winkler(a, b) - duckdb.execute("select jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]) < 1e-9


ERAS = "era_slug string, start_date timestamp_ntz, end_date timestamp_ntz, is_major_shift boolean"


def era_rows(spark):
    return spark.createDataFrame([("a", T, T + timedelta(10), False), ("b", T + timedelta(10), T + timedelta(20), True), ("c", T + timedelta(25), None, False)], ERAS)


def test_assign_era(spark):
    rows = spark.createDataFrame([(i, T + timedelta(d)) for i, d in enumerate([-1, 0, 9.99, 10, 22, 30])], "i int, ts timestamp_ntz")
    got = lambda mode: [r.era_slug for r in eras.assign_era(rows, era_rows(spark), "ts", mode).orderBy("i").collect()]
    assert got("null") == [None, "a", "a", "b", None, "c"] and got("nearest_prior") == [None, "a", "a", "b", "b", "c"]
    with pytest.raises(Exception, match="no era"):
        got("error")


def test_era_sequence_and_roll(spark):
    e = era_rows(spark)
    assert [tuple(r) for r in eras.sequence_faults(e).collect()] == [("c", "gap")]
    rolled = eras.roll_era(e, "2024-03-01", "d", is_major_shift=True)
    assert {r.era_slug: r.end_date for r in rolled.collect()}["c"] == datetime(2024, 3, 1) and eras.current_era(rolled).first().era_slug == "d"
    with pytest.raises(Exception, match="one open era"):
        eras.roll_era(e, "2024-01-05", "d").collect()


def test_bleed_guard_matches_a_plain_model(spark):
    rng = random.Random(3)
    e = spark.createDataFrame([(f"e{i}", T + timedelta(i), T + timedelta(i + 1), rng.random() < 0.3) for i in range(8)], ERAS)
    rows = e.orderBy("start_date").collect()
    for _ in range(8):
        chosen = rng.sample(range(8), rng.randint(1, 3))
        bad = any(rows[i].is_major_shift for i in range(min(chosen) + 1, max(chosen) + 1))
        groups = spark.createDataFrame([("g", f"e{i}") for i in chosen], "g string, era_slug string")
        assert bool(eras.bleeding_groups(groups, e, ["g"]).count()) == bad
        if bad:
            with pytest.raises(ValueError, match="major shift"):
                eras.assert_no_bleed(e, [f"e{i}" for i in chosen])
        else:
            eras.assert_no_bleed(e, [f"e{i}" for i in chosen])


def test_upsert_outcomes_and_kept(spark):
    old = spark.createDataFrame([(1, "a", 1, 10), (2, "b", 1, 20), (3, "c", 1, 30)], "k int, v string, seen int, made int")
    new = spark.createDataFrame([(1, "a", 2, 99), (2, "x", 2, 99), (4, "d", 2, 99)], "k int, v string, seen int, made int")
    got = {tuple(r) for r in merge.upsert(old, new, ["k"], touched=["seen"], kept=["made"]).collect()}
    assert got == {(1, "a", 2, 10, "unchanged"), (2, "x", 2, 20, "updated"), (3, "c", 1, 30, "untouched"), (4, "d", 2, 99, "inserted")}


def test_replace_children_deletes_the_tail_and_keeps_ids(spark):
    old = spark.createDataFrame([("m", 0, "a", "r0"), ("m", 1, "b", "r1"), ("n", 0, "c", "r2")], "media_id string, chunk_idx int, chunk_text string, row_id string")
    new = spark.createDataFrame([("m", 0, "z")], "media_id string, chunk_idx int, chunk_text string")
    assert {tuple(r) for r in merge.replace_children(old, new, ["media_id"], "chunk_idx").collect()} == {("m", 0, "z", "r0"), ("n", 0, "c", "r2")}
    assert merge.replace_children(old, new.where("false"), ["media_id"], "chunk_idx").count() == 3


def test_merge_sources_logs_conflicts(spark):
    rows = [("e", "name", "x", "A", 0), ("e", "name", "y", "B", 1), ("e", "only", "y", "C", 1), ("e", "same", "x", "D", 0), ("e", "same", "y", "D", 1)]
    merged, conflicts = merge.merge_sources(spark.createDataFrame(rows, "id string, field string, source string, value string, arrival int"), ["id"], {"x": 2, "y": 1})
    assert {(r.field, r.value) for r in merged.collect()} == {("name", "B"), ("only", "C"), ("same", "D")}
    assert [(r.field, r.rejected, r.after, r.losing_source, r.winning_source) for r in conflicts.collect()] == [("name", "A", "B", "x", "y")]


EDGE = "edge_id string, src_id string, dst_id string, edge_type string, strength double, sentiment double, last_updated_at timestamp_ntz, maps long"


def test_rerun_flips_kind_and_moves_events(spark):
    old = spark.createDataFrame([("1", "a", "b", "teammate", 0.9, 0.3, T, 5), ("2", "c", "d", "teammate", 0.5, 0.5, T, 5), ("3", "c", "d", "ex_teammate", 0.4, 0.1, T, 5), ("4", "e", "f", "teammate", 0.8, 1.0, T + timedelta(400), 1), ("5", "a", "b", "rival", 0.2, 0.0, T, 0)], EDGE)
    fresh = spark.createDataFrame([(None, s, d, "ex_teammate", 0.6, 1.0, T + timedelta(9), 12) for s, d in (("a", "b"), ("c", "d"), ("e", "f"), ("g", "h"))], EDGE).withColumn("edge_id", F.concat(F.lit("new-"), "src_id"))
    events = spark.createDataFrame([("x", "2"), ("y", "3"), ("z", "1")], "event_id string, edge_id string")
    edges, moved = relations.rerun_edges(old, fresh, events)
    got = {r.edge_id: (r.edge_type, r.strength, r.sentiment, r.maps) for r in edges.collect()}
    assert got == {"1": ("ex_teammate", 0.6, 0.3, 12), "3": ("ex_teammate", 0.6, 0.1, 12), "4": ("ex_teammate", 0.8, 1.0, 12), "new-g": ("ex_teammate", 0.6, 1.0, 12), "5": ("rival", 0.2, 0.0, 0)}
    assert {r.event_id: r.edge_id for r in moved.collect()} == {"x": "3", "y": "3", "z": "1"}
    again, _ = relations.rerun_edges(edges.select(*old.columns), fresh, moved)
    assert {r.edge_id: (r.edge_type, r.strength, r.sentiment, r.maps) for r in again.collect()} == got


def test_decay_pass_is_idempotent(spark):
    old = spark.createDataFrame([("1", "a", "b", "teammate", 0.9, 0.3, T, 5)], EDGE)
    first = relations.decay_pass(old, T + timedelta(14))
    second = relations.decay_pass(first.drop("touched"), T + timedelta(14))
    assert first.first().touched and not second.first().touched and second.first().strength == first.first().strength == pytest.approx(0.9 * math.exp(-0.04))


def folded(strength, mood, at, kind, events):
    since = at
    for t, _, ds, dm in sorted(events):
        if t > since:
            strength = min(1, max(0, strength * math.exp(-formulas.DECAY_RATES[kind] * (t - at).total_seconds() / 604800) + ds))
            mood, at = min(1, max(-1, mood + dm)), t
    return strength, mood, at


@pytest.mark.parametrize("rows_at_once", [500_000, 3])
def test_fold_events_matches_a_loop(spark, monkeypatch, rows_at_once):
    """Events before the edge's time, at one instant, without deltas, of one edge over many tasks, and of no edge."""
    monkeypatch.setattr(relations, "FOLD_ROWS", rows_at_once)
    rng = random.Random(1)
    events = [(f"x{i}", rng.choice("12222299"), T + timedelta(days=rng.randint(-5, 60), seconds=i // 3), rng.choice([None, rng.uniform(-0.6, 0.6)]), rng.choice([None, rng.uniform(-0.9, 0.9)])) for i in range(300)]
    events += [(f"t{i}", "1", T + timedelta(days=3), d, 0.1) for i, d in enumerate((0.1, 0.3, 0.4, -0.9, 0.2))]
    old = spark.createDataFrame([("1", "a", "b", "rival", 0.2, 0.0, T, 5), ("2", "a", "c", "friend", 0.9, 0.9, T, 5), ("3", "a", "d", "friend", 0.9, 0.9, T, 5)], EDGE)
    frame = spark.createDataFrame(events, "event_id string, edge_id string, occurred_at timestamp_ntz, delta_strength double, delta_sentiment double").repartition(5)
    got = relations.fold_events(old, frame).collect()
    assert len(got) == 3
    for r in got:
        start = old.where(F.col("edge_id") == r.edge_id).first()
        s, m, at = folded(start.strength, start.sentiment, start.last_updated_at, r.edge_type, [(e[2], e[0], e[3] or 0, e[4] or 0) for e in events if e[1] == r.edge_id])
        assert r.strength == pytest.approx(s) and r.sentiment == pytest.approx(m) and r.last_updated_at == at


def test_events_of_one_instant_all_count(spark):
    old = spark.createDataFrame([("1", "a", "b", "rival", 0.2, 0.0, T, 5)], EDGE)
    at = T + timedelta(minutes=1)
    events = spark.createDataFrame([("x", "1", at, 0.1, 0.0), ("y", "1", at, 0.3, 0.0)], "event_id string, edge_id string, occurred_at timestamp_ntz, delta_strength double, delta_sentiment double")
    assert relations.fold_events(old, events).first().strength == pytest.approx(0.6, abs=1e-5)


def test_events_of_one_edge_are_split_over_tasks(spark):
    """A million events of one edge and few of others: no task has them all, and the loop agrees."""
    n = 1_000_000
    day = F.lit(T).cast("timestamp_ntz")
    micros = (F.col("id") * 7_000_000 + F.unix_micros(day.cast("timestamp"))).cast("long")
    wave = F.sin(F.col("id").cast("double"))
    events = spark.range(1, n + 1).select(F.format_string("%08d", "id").alias("event_id"), F.when(F.col("id") % 1000 == 0, F.lit("2")).otherwise("1").alias("edge_id"), F.timestamp_micros(micros).cast("timestamp_ntz").alias("occurred_at"), (wave * 0.3).alias("delta_strength"), (wave * 0.2).alias("delta_sentiment"))
    old = spark.createDataFrame([("1", "a", "b", "rival", 0.2, 0.0, T, 5), ("2", "a", "c", "friend", 0.5, 0.5, T, 5)], EDGE)
    rate = formulas.DECAY_RATES["rival"]
    strength, mood, before = 0.2, 0.0, 0
    for i in range(1, n + 1):
        if i % 1000:
            strength = min(1.0, max(0.0, strength * math.exp(-rate * (i - before) * 7 / 604800) + math.sin(i) * 0.3))
            mood, before = min(1.0, max(-1.0, mood + math.sin(i) * 0.2)), i
    got = {r.edge_id: r for r in relations.fold_events(old, events).collect()}
    assert got["1"].strength == pytest.approx(strength, abs=1e-6) and got["1"].sentiment == pytest.approx(mood, abs=1e-6)
    ordered = events.select("edge_id", "occurred_at").repartitionByRange("edge_id", "occurred_at").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in ordered) < 0.6 * n


def test_rosters_of_any_size(spark):
    """2,000 on one side beside small ones: every pair once, the pairs of large sides over many tasks."""
    big = spark.range(2000).select(F.lit("m").alias("map_id"), F.lit("x").alias("side"), F.col("id").cast("int").alias("entity_id"), F.lit(T).cast("timestamp_ntz").alias("at"))
    small = spark.createDataFrame([("n", "x", 3, T + timedelta(1)), ("n", "x", 1, T), ("n", "x", 3, T), ("n", "y", 7, T), ("n", "x", None, T)], "map_id string, side string, entity_id int, at timestamp_ntz")
    pairs = relations.shared_pairs(big.unionByName(small))
    row = pairs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("src_id", "dst_id").alias("d"), F.sum("maps").alias("maps"), F.min(F.col("dst_id") - F.col("src_id")).alias("least")).first()
    assert (row.n, row.d, row.maps, row.least) == (1_999_000, 1_999_000, 1_999_001, 1)
    assert pairs.where("src_id = 1 and dst_id = 3").first()[2:] == (2, T + timedelta(1))


@pytest.mark.parametrize("n", [1, 4, 13])
def test_scans_split_a_key_or_a_day(spark, n):
    """One key has most rows, all in one day: the same aliases and trailing sums as a loop, over ranges that share it."""
    rng = random.Random(n)
    key = lambda: rng.choice(["hot", "hot", "hot", "a", "b", None])
    aliases = [(key(), T + timedelta(minutes=rng.randrange(900)) if rng.random() < 0.95 else None, f"a{i}") for i in range(150)]
    lookups = [(i, key(), T + timedelta(minutes=rng.randrange(900)) if rng.random() < 0.95 else None) for i in range(400)]
    calls = [(f"{i}", T + timedelta(minutes=rng.choice([rng.randrange(900), rng.randrange(30_000)])), rng.choice(["p", "p", "p", "q", None]), rng.choice([None, round(rng.uniform(0, 3), 3)])) for i in range(300)]
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left = spark.createDataFrame(lookups, "id int, key string, at timestamp_ntz")
        right = spark.createDataFrame(aliases, "key string, valid_from timestamp_ntz, name string")
        got = {r.id: r.name for r in eras.alias_at(left, right, ["key"], "at").collect()}
        ledger = spark.createDataFrame(calls, "id string, timestamp timestamp_ntz, purpose string, usd_cost double")
        spent = {r.id: (r.purpose_trailing, r.total_trailing) for r in spend.trailing_total(spend.trailing_spend(ledger)).collect()}
        placed = scans.ranged(left, ["key"], "at")
        parts = placed.where("key = 'hot'").select("_part").distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for i, k, at in lookups:
        fits = [(t, name) for own, t, name in aliases if k is not None and own == k and t is not None and at is not None and t <= at]
        assert got[i] == (max(fits)[1] if fits else None)
    for i, at, p, _ in calls:
        before = [(q, c or 0) for _, t, q, c in calls if at - timedelta(7) <= t < at]
        assert spent[i] == (pytest.approx(sum(c for q, c in before if q == p), abs=1e-6), pytest.approx(sum(c for _, c in before), abs=1e-6))
    assert n == 1 or parts > 1


@pytest.mark.parametrize("on_missing", ["null", "nearest_prior"])
def test_eras_of_any_number(spark, monkeypatch, on_missing):
    """Eras with gaps, overlaps and an open end, met by stretches of time: the same answers as from one array."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        start = T + timedelta(days=i * 3 + rng.randrange(2), hours=rng.randrange(9))
        rows.append((f"e{i:02}", start, rng.choice([start + timedelta(days=rng.choice([1, 2, 3, 9])), start + timedelta(days=2)])))
    rows += [("open", T + timedelta(days=185), None), ("none", T + timedelta(days=5), T + timedelta(days=5))]
    table = spark.createDataFrame(rows, "era_slug string, start_date timestamp_ntz, end_date timestamp_ntz")
    stamps = [(i, T + timedelta(days=rng.uniform(-3, 220))) for i in range(300)] + [(900 + i, t) for i, (_, a, b) in enumerate(rows) for t in (a, b) if t] + [(2000, None)]
    asked = spark.createDataFrame(stamps, "id int, ts timestamp_ntz")
    small = sorted(map(tuple, eras.assign_era(asked, table, "ts", on_missing).collect()), key=str)
    monkeypatch.setattr(eras, "ARRAY_ERAS", 3)
    assert sorted(map(tuple, eras.assign_era(asked, table, "ts", on_missing).collect()), key=str) == small
    for i, ts, slug in small:
        fits = [(a, b is not None, b, s) for s, a, b in rows if ts is not None and a <= ts and (on_missing == "nearest_prior" or b is None or ts < b)]
        assert slug == (max(fits, key=lambda f: (f[0], f[2] or datetime.max, f[3]))[3] if fits else None) or len({f[0] for f in fits}) < len(fits)


def test_fifty_thousand_eras(spark):
    table = spark.range(50_000).select(F.format_string("e%05d", "id").alias("era_slug"), (F.lit(T).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("start_date"))
    table = table.withColumn("end_date", F.col("start_date") + F.expr("interval 1 hour"))
    asked = spark.range(2000).select("id", (F.lit(T).cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("id") * 30 % 60_000).cast("int"), mins=F.lit(5))).alias("ts"))
    got = {r.id: r.era_slug for r in eras.assign_era(asked, table, "ts").collect()}
    assert got == {i: f"e{i * 30 % 60_000:05}" if i * 30 % 60_000 < 50_000 else None for i in range(2000)}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_are_utc_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([("2024-05-01",), ("2024-05-01T10:00:00",), ("2024-05-01 10:00:00.5",), ("2024-05-01T10:00:00+02:00",), ("2024-05-01T10:00:00Z",), ("nope",), ("2024-13-01",)], "t string")
        got = rows.select(F.unix_micros(parse.iso_date(F.col("t"))), F.unix_micros(parse.iso_timestamp(F.col("t"))), F.unix_micros(parse.iso_timestamp(F.col("t"), naive="null"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    day = 1714521600000000
    ten = day + 36_000_000_000
    assert [tuple(r) for r in got] == [(day, day, None), (None, ten, None), (None, ten + 500_000, None), (None, ten - 7_200_000_000, ten - 7_200_000_000), (None, ten, ten), (None, None, None), (None, None, None)]


def article_page(body):
    return f"<html><head><title>Patch Notes 8.05</title></head><body><time datetime='2024-05-01T00:00:00Z'></time>{body}</body></html>"


def test_article_containers(spark):
    """The first article alone; else the exact test id; a container without a text has no body."""
    bodies = [
        "<article><p>one</p></article><article><p>two</p></article><main>three</main>",
        "<div data-testid='article-list'>teaser</div><div data-testid='article-body'>  the\t body <p>more</p></div><main>three</main>",
        "<div data-testid='my-article'>x</div><main>three<script>no</script></main> outside",
        "<article></article><main>three</main>",
        "<p>alone</p>\n\n<p>b</p>",
    ]
    found = pages.articles(spark.createDataFrame([(i, article_page(b)) for i, b in enumerate(bodies)], "page_id int, html string"))
    assert {r.page_id: r.body_text for r in found.collect()} == {0: "one", 1: "the body\nmore", 2: "three", 3: None, 4: "Patch Notes 8.05\nalone\nb"}
    assert {r.page_id for r in found.where("drift").collect()} == {3}


def test_tidy_lines():
    for text in ["a  b\t c", " a\n b ", "a \n\n \n  b", "\n\na\n\n\nb\nc", "a\n \t\nb", "", " \n "]:
        want = re.sub(r"\n\s*\n\s*", "\n\n", re.sub("[ \t]+", " ", text)).strip()
        assert pages.tidy(text) == want, text


def test_article_addresses(spark):
    hrefs = ["/en-us/news/game-updates/valorant-patch-notes-8-05/", "/news/game-updates/VALORANT_Patch_Notes-9?x=1", "https://h/news/game-updates/valorant-patch-notes-8-05", "/news/game-updates/", "/news/game-updates/trailer", "/news/dev/valorant-patch-notes-1", "/en-us/news/game-updates/valorant-patch-notes-8-05/"]
    links = spark.createDataFrame([(1, i, h) for i, h in enumerate(hrefs)], "page_id int, pos int, href string")
    assert [(r.pos, r.url) for r in pages.article_links(links, base="https://h").orderBy("pos").collect()] == [(0, "https://h" + hrefs[0]), (1, "https://h" + hrefs[1]), (2, hrefs[2])]


def test_crawl_rules_of_any_number(spark):
    urls = spark.createDataFrame([(1, "https://h/a/b"), (2, "https://h/c"), (3, "https://h"), (4, None), (5, "https://h/p77/x")], "page_id int, url string")
    rules = spark.range(20_000).select(F.lit("*").alias("agent"), F.concat(F.lit("/p"), "id").alias("prefix")).unionByName(spark.createDataFrame([("*", "/a"), ("*", "")], "agent string, prefix string"))
    assert sorted(r.page_id for r in pages.allowed_urls(urls, rules, "bot").collect()) == [2, 3]


def test_documents_of_a_language_survive_a_write(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(x, "media_id string, language string, text string")
    root = str(tmp_path / "docs")
    tables.write_json_documents(rows(("1", "en", "old"), ("2", "en", "kept"), ("3", "de", "drei")), root, 1)
    for _ in range(2):  # a write that is repeated changes nothing
        tables.write_json_documents(rows(("1", "en", "new"), ("4", "en", "four")), root, 2)
    assert sorted((r.media_id, r.language, r.text) for r in tables.read_json_documents(spark, root, "media_id string, text string, language string", "media_id").collect()) == [("1", "en", "new"), ("2", "en", "kept"), ("3", "de", "drei"), ("4", "en", "four")]


def alias_tables(spark, rows):
    aliases = spark.createDataFrame([(c, "vlr", p, n, 1.0, T) for c, p, n in rows], "canonical_id string, platform string, platform_id string, platform_name string, confidence double, valid_from timestamp_ntz")
    entities = spark.createDataFrame([(c, "player", True, T) for c, _, _ in rows], "canonical_id string, entity_type string, is_active boolean, created_at timestamp_ntz")
    return aliases, entities


def handles(spark, rows):
    return spark.createDataFrame([("vlr", p, n, "player", T + timedelta(seconds=i), f"{i:04d}") for i, (p, n) in enumerate(rows)], "platform string, platform_id string, platform_name string, entity_type string, created_at timestamp_ntz, id string")


def test_resolution_bands(spark):
    aliases, entities = alias_tables(spark, [("c1", "p1", "TenZ"), ("c2", "p2", "Sentinel")])
    out = resolve.resolve(handles(spark, [("p1", "whatever"), ("q1", "tenz"), ("q2", "Sentinal"), ("q3", "QuasarBlaze"), ("q3", "QuasarBlaze")]), aliases, entities)
    got = {(r.platform_id, r.status, r.canonical_id) for r in out["resolved"].collect()}
    created = next(c for p, s, c in got if p == "q3")
    # The second row of a new handle matches.
    assert got == {("p1", "matched", "c1"), ("q1", "auto_merged", "c1"), ("q2", "pending", None), ("q3", "created", created), ("q3", "matched", created)} and out["resolved"].count() == 5
    review = out["review_queue"].collect()
    assert len(review) == 1 and review[0].candidates[0].canonical_id == "c2" and review[0].candidates[0].score == 0.875 and len(review[0].candidates) == 2
    assert out["new_entities"].count() == 1 and {r.platform_id for r in out["new_aliases"].collect()} == {"q1", "q3"}
    again = resolve.resolve(handles(spark, [("q2", "Sentinal")]), aliases, entities, out["review_queue"])
    assert again["review_queue"].count() == 0


def test_resolution_follows_batch_order(spark):
    aliases, entities = alias_tables(spark, [("c1", "p1", "zzzzzz")])
    out = resolve.resolve(handles(spark, [("a", "Northwind"), ("b", "northwind"), ("c", "NORTHWIND!"), ("d", "Completely Other")]), aliases, entities)
    got = {r.platform_id: (r.status, r.canonical_id) for r in out["resolved"].collect()}
    assert got["a"][0] == "created" and got["b"] == ("auto_merged", got["a"][1]) == got["c"] and got["d"][0] == "created" != got["d"][1]
    with pytest.raises(Exception, match="needs an id"):
        resolve.resolve(handles(spark, [("", "x")]), aliases, entities)["resolved"].collect()


NO_ALIASES = "canonical_id string, platform string, platform_id string, platform_name string, confidence double, valid_from timestamp_ntz"
NO_ENTITIES = "canonical_id string, entity_type string, is_active boolean, created_at timestamp_ntz"
STAGING = "id string, source string, entity_type string, canonical_id string, payload string, status string, created_at timestamp_ntz"


def plain_resolve(rows, aliases, kinds):
    """rows: (platform, id, name, type, new id) in order; aliases: (canonical, platform, id, name); kinds: active entities.

    One row after the other: (status, canonical, score, outcome of the rename, candidates of pending rows).
    """
    normal = lambda n: re.sub(r"[\W_]", " ", n.lower()).strip()
    owners = {(p, i): (c, 1.0) for c, p, i, _ in aliases}
    stands = [(c, n) for c, _, _, n in aliases]
    kinds, out = dict(kinds), []
    for platform, i, name, kind, to in rows:
        candidates, outcome = [], None
        if (platform, i) in owners:
            status, (canonical, score) = "matched", owners[platform, i]
        else:
            best = {}
            for c, n in stands:
                if kinds.get(c) == kind:
                    best[c] = min(best.get(c, (0, "")), (-names.weighted_ratio(normal(name), normal(n)), n))
            ranked = sorted((s, c, n) for c, (s, n) in best.items())
            score, canonical = (-ranked[0][0], ranked[0][1]) if ranked else (0.0, None)
            status = "auto_merged" if score >= 0.9 else "pending" if score >= 0.7 else "created"
            if status == "pending":
                canonical, candidates = None, [(c, n, round(-s, 4)) for s, c, n in ranked[:5]]
            if status == "created":
                score, canonical = 1.0, merge.entity_id(kind, platform, i)
                kinds[canonical] = kind
            if canonical:
                owners[platform, i] = (canonical, score)
                stands.append((canonical, name))
        if to is not None:
            has = owners.get((platform, to), (None,))[0]
            outcome = "unknown" if canonical is None else "added" if has is None else "same" if has == canonical else "conflict"
            if outcome == "added":
                owners[platform, to] = (canonical, 1.0)
                stands.append((canonical, name))
        out.append((status, canonical, round(score, 9), outcome, candidates))
    return out


def resolved_as_a_loop_does(spark, rows, aliases, entities, known, kinds):
    frame = spark.createDataFrame([(*r[:4], T + timedelta(seconds=i), f"{i:05d}", r[4], T) for i, r in enumerate(rows)], "platform string, platform_id string, platform_name string, entity_type string, created_at timestamp_ntz, id string, new_platform_id string, renamed_at timestamp_ntz").repartition(3)
    out = resolve.resolve(frame, aliases, entities)
    want = plain_resolve(rows, known, kinds)
    got = {r.id: (r.status, r.canonical_id, round(r.confidence, 9)) for r in out["resolved"].collect()}
    assert [got[f"{i:05d}"] for i in range(len(rows))] == [w[:3] for w in want]
    moves = sorted((r.platform_id, r.new_platform_id, r.outcome) for r in out["rebrands"].collect())
    assert moves == sorted((r[1], r[4], w[3]) for r, w in zip(rows, want) if r[4] is not None)
    first = {}
    for r, w in zip(rows, want):
        if w[0] == "pending":
            first.setdefault(r[:2], w[4])
    assert {(r.platform, r.platform_id): [(c.canonical_id, c.name, c.score) for c in r.candidates] for r in out["review_queue"].collect()} == first
    return out


@pytest.mark.parametrize("block, tile", [(4096, 4096), (17, 5)])
def test_resolution_equals_a_plain_loop(spark, monkeypatch, block, tile):
    """Look-alikes, renames, repeats, several types and inactive entities, in one block of rows and in many."""
    monkeypatch.setattr(resolve, "BLOCK_ROWS", block)
    monkeypatch.setattr(resolve, "TILE_NAMES", tile)
    rng = random.Random(7)
    known = [(f"c{i}", "vlr", f"k{i}", n) for i, n in enumerate(["TenZ", "Sentinel", "Team Liquid", "liquid", "Zekken Zero", "Old Guard", "Sentinels"])]
    aliases = spark.createDataFrame([(*a, 1.0, T) for a in known], NO_ALIASES)
    kind = {"c0": "player", "c1": "player", "c2": "team", "c3": "team", "c4": "player", "c6": "player"}
    entities = spark.createDataFrame([(c, k, True, T) for c, k in kind.items()] + [("c5", "player", False, T)], NO_ENTITIES)
    base = ["Sentinal", "tenz", "TEAM-LIQUID", "Player One", "player two", "Zekken", "zero zekken", "Quasar Blaze", "old guard", "Sentinel S", "éclair", "Éclair!"]
    rows = []
    for i in range(70):
        name = rng.choice(base) + rng.choice(["", "", " x", "7", f" {rng.randrange(4)}"])
        own = rng.choice([f"k{rng.randrange(9)}", f"h{rng.randrange(40)}", f"h{i}"])
        rows.append(("vlr", own, name, rng.choice(["player", "player", "team"]), rng.choice([None, None, None, f"h{rng.randrange(40)}", f"k{rng.randrange(9)}"])))
    resolved_as_a_loop_does(spark, rows, aliases, entities, known, kind)


def test_renames_count_from_the_next_row_on(spark):
    """A row with the new id alone, under another name, is the renamed entity."""
    known = [("c1", "vlr", "old", "TenZ")]
    aliases, entities = alias_tables(spark, [("c1", "old", "TenZ")])
    rows = [("vlr", "old", "TenZ", "player", "new"), ("vlr", "new", "Somebody Else", "player", None), ("vlr", "late", "Nobody", "player", "new"), ("vlr", "old", "TenZ", "player", "new")]
    out = resolved_as_a_loop_does(spark, rows, aliases, entities, known, {"c1": "player"})
    assert {(r.id, r.status, r.canonical_id) for r in out["resolved"].collect()} >= {("00001", "matched", "c1")}
    assert sorted(r.outcome for r in out["rebrands"].collect()) == ["added", "conflict", "same"]


def test_part_names_resolve_as_a_loop_does(spark):
    """The query entity_resolution on the part table."""
    from seriesgraph.plans.queries import entity_resolution

    d = "/root/testdata/sf0.001"
    parts = sorted((r.key, r.p_name) for r in spark.read.parquet(f"{d}/part.parquet").groupBy("p_name").agg(F.min("p_partkey").alias("key")).collect())
    known = [(str(k), "a", f"a{k}", n) for k, n in parts if k % 3 == 0]
    want = plain_resolve([("a", f"a{k}", n, "part", None) for k, n in parts], known, {c: "part" for c, *_ in known})
    got = {r.platform_id: (r.status, r.canonical_id, r.confidence) for r in entity_resolution(spark, d).collect()}
    assert got == {f"a{k}": (w[0], w[1], round(w[2], 6)) for (k, _), w in zip(parts, want)}


def test_a_batch_of_look_alikes_is_drained_in_time(spark):
    """100 names that nearly all look alike: within the reference's five seconds, and as a plain loop decides them."""
    import time

    entities, aliases = spark.createDataFrame([], NO_ENTITIES), spark.createDataFrame([], NO_ALIASES)
    rows = [(f"{i:03d}", "vlr", "player", None, json.dumps({"slug": f"player_{i:03d}", "name": f"Player {i:03d}"}), "pending", T + timedelta(seconds=i)) for i in range(100)]
    staging = spark.createDataFrame(rows, STAGING)
    resolve.drain(staging.limit(3), aliases, entities)["staging"].collect()  # code is compiled
    start = time.time()
    got = {r.platform_id: (r.status, r.canonical_id) for r in resolve.drain(staging, aliases, entities)["resolved"].collect()}
    took = time.time() - start
    want = plain_resolve([("vlr", f"player_{i:03d}", f"Player {i:03d}", "player", None) for i in range(100)], [], {})
    assert got == {f"player_{i:03d}": w[:2] for i, w in enumerate(want)}
    print(f"100 rows in {took:.1f} s")
    assert took < 5


def test_thousands_of_look_alikes(spark):
    """Pairs scored grow about with the names, and blocks go on where the one before ended."""
    rows = [("vlr", f"p{i}", f"Player {i:04d}", "player", T + timedelta(seconds=i), f"{i:05d}") for i in range(5000)]
    out = resolve.resolve(spark.createDataFrame(rows, "platform string, platform_id string, platform_name string, entity_type string, created_at timestamp_ntz, id string"), spark.createDataFrame([], NO_ALIASES), spark.createDataFrame([], NO_ENTITIES))
    assert {(r.status, r.n, r.ids) for r in out["resolved"].groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("canonical_id").alias("ids")).collect()} == {("created", 1, 1), ("auto_merged", 4999, 1)}


def test_few_pairs_of_names_are_scored(spark):
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet").select("p_partkey", "p_name").distinct()
    asked = part.where("p_partkey % 3 <> 0").select(F.lit("part").alias("entity_type"), F.col("p_name").alias("query"))
    known = part.where("p_partkey % 3 = 0").select(F.lit("part").alias("entity_type"), F.col("p_partkey").cast("string").alias("canonical_id"), F.col("p_name").alias("name"))
    row = resolve.pairs_scored(asked, known).first()
    assert row.pairs == asked.distinct().count() * known.count() and 0 < row.scored < 0.2 * row.pairs


@pytest.mark.parametrize("tile", [4096, 7])
def test_blocked_matches_in_tiles(spark, monkeypatch, tile):
    """A block of any size, the same rows as every pair of it scored."""
    monkeypatch.setattr(resolve, "TILE_NAMES", tile)
    rng = random.Random(2)
    rows = [(i, rng.choice(["ab", "ab", "ab", "cd"]) + "".join(rng.choice("xyz") for _ in range(rng.randrange(6))), rng.choice(["SE", "NO", None])) for i in range(60)] + [(60, None, "SE"), (61, "", "SE")]
    frame = spark.createDataFrame(rows, "id int, name string, country string")
    for country in (None, "country"):
        want = set()
        for i, a, x in rows:
            for j, b, y in rows:
                if a is not None and b is not None and a[:2] == b[:2]:
                    score = max(names.jaro_winkler(a, b), 0.85 if a == b else 0)
                    score = min(1, score + 0.05) if country and x == y and x else score
                    if score >= 0.78:
                        want.add((i, j, round(score, 6), "match" if score >= 0.92 else "review"))
        got = {(r.left_id, r.right_id, round(r.score, 6), r.verdict) for r in resolve.blocked_matches(frame, frame, country=country).collect()}
        assert got == want


def test_misses_do_not_hold_up_the_queue(spark):
    aliases, entities = alias_tables(spark, [("c1", "p1", "TenZ")])
    rows = [("m1", "vlr", {"name": "no id"}), ("m2", "nowhere", {"slug": "s", "name": "n"}), ("r1", "vlr", {"slug": "p1", "name": "TenZ"}), ("r2", "vlr", {"slug": "p2", "name": "Other"})]
    staging = spark.createDataFrame([(i, s, "player", None, json.dumps(p), "pending", T + timedelta(seconds=n)) for n, (i, s, p) in enumerate(rows)], STAGING)
    out = resolve.drain(staging, aliases, entities, limit=1)
    assert {r.id: r.status for r in out["staging"].collect()} == {"m1": "pending", "m2": "pending", "r1": "processed", "r2": "pending"}


def test_review_rows_name_the_batch_candidate(spark):
    """A candidate that came with the batch is listed under its own name."""
    aliases, entities = spark.createDataFrame([], NO_ALIASES), spark.createDataFrame([], NO_ENTITIES)
    out = resolve.resolve(handles(spark, [("s", "Sentinel"), ("t", "Sentinal")]), aliases, entities)
    (row,) = out["review_queue"].collect()
    assert [(c.canonical_id, c.name, c.score) for c in row.candidates] == [(merge.entity_id("player", "vlr", "s"), "Sentinel", 0.875)]


def test_ingest_keeps_arrival_order(spark):
    """The earlier fetched of two look-alikes is the new entity, whatever their hashes; within a payload the first."""
    page = lambda *names: json.dumps({"page_type": "stats", "url": "u", "rows": [{"entity_type": "player", "site_id": str(i), "name": n} for i, n in names]})
    empty = spark.createDataFrame([], "source string, content_hash string")
    aliases = spark.createDataFrame([], "canonical_id string, platform string, platform_id string, platform_name string, confidence double, valid_from timestamp_ntz")
    entities = spark.createDataFrame([], "canonical_id string, entity_type string, is_active boolean, created_at timestamp_ntz")
    for first, second in ((1, 2), (2, 1)):
        raw = spark.createDataFrame([("vlr", T, page((first, "Northwind"), (5, "Other Thing"), (6, "other thing"))), ("vlr", T + timedelta(1), page((second, "northwind")))], "source string, fetched_at timestamp_ntz, payload string")
        out = ingest.ingest(raw, tables.page_payload_spec(), empty, aliases, entities)
        got = {r.platform_id: r.status for r in out["resolved"].collect()}
        assert got == {f"player-{first}": "created", f"player-{second}": "auto_merged", "player-5": "created", "player-6": "auto_merged"}
        assert all(":" not in r.id for r in out["staging"].collect())


def test_drain_with_rebrands_and_misses(spark):
    aliases, entities = alias_tables(spark, [("c1", "old-slug", "TenZ")])
    payloads = [("r1", "vlr", {"slug": "new-slug", "previous_slug": "old-slug", "name": "TenZ", "renamed_at": "2024-05-01T00:00:00Z"}), ("r2", "vlr", {"name": "x"}), ("r3", "nowhere", {"slug": "s", "name": "n"}), ("r4", "vlr", {"platform_id": "k", "platform_name": "Fresh Face"})]
    staging = spark.createDataFrame([(i, s, "player", None, json.dumps(p), "pending", T) for i, s, p in payloads], "id string, source string, entity_type string, canonical_id string, payload string, status string, created_at timestamp_ntz")
    out = resolve.drain(staging, aliases, entities)
    assert {r.id: r.status for r in out["staging"].collect()} == {"r1": "processed", "r2": "pending", "r3": "pending", "r4": "processed"}
    assert [(r.platform_id, r.new_platform_id, r.outcome) for r in out["rebrands"].collect()] == [("old-slug", "new-slug", "added")]
    assert [(r.canonical_id, r.platform_id) for r in out["rebrand_aliases"].collect()] == [("c1", "new-slug")]


def small_features():
    return {"player": (Feature("acs", "minmax"), Feature("kast", "minmax", "mean"), Feature("skill", "zscore")), "patch": NODES["patch"], "team": (Feature("w", "minmax"),)}, {("player", "plays_for", "team"): EDGES["player", "plays_for", "team"]}


def graph(spark, shuffle=False):
    nodes = [("e1", "player", f"p{i}", {"acs": float(i), "kast": None if i == 0 else i / 10, "skill": i * 2.0}) for i in range(5)] + [("e2", "player", "p9", {"acs": 3.0})] + [("e1", "team", f"t{i}", {"w": float(i)}) for i in range(2)]
    edges = [("e1", "player", "plays_for", "team", f"p{i}", f"t{i % 3}", {"tenure_days": float(i), "role_slot": 1.0}) for i in range(5)]
    if shuffle:
        random.Random(1).shuffle(nodes)
        random.Random(2).shuffle(edges)
    meta = [("e1", 2024, 1.0, 30.0, 10.0, 1.0, 0.0, 0.4, True, 200.0, 70.0), ("e2", 2025, 2.0, 30.0, 10.0, 1.0, 0.0, 0.4, False, 200.0, 70.0)]
    n = spark.createDataFrame(nodes, "era_slug string, node_type string, id string, features map<string,double>")
    e = spark.createDataFrame(edges, "era_slug string, src string, relation string, dst string, src_id string, dst_id string, attributes map<string,double>")
    m = spark.createDataFrame(meta, "era_slug string, season_year int, era_ordinal double, duration_days double, matches_played double, agents_added double, maps_added double, meta_magnitude double, is_major_shift boolean, agg_match_acs double, agg_match_kast double")
    return features.build_snapshots(n, e, m, *small_features())


def test_snapshots(spark, tmp_path):
    blocks, links = graph(spark)
    p = {r.id: r for r in blocks["player"].collect()}
    assert p["p4"].acs == 1.0 and p["p0"].acs == 0.0 and p["p9"].acs == 0.5 and p["p9"].skill == 0.0
    assert p["p0"].kast == pytest.approx((0 + 1 / 3 + 2 / 3 + 1) / 4, abs=1e-6) and [p[f"p{i}"].idx for i in range(5)] == [0, 1, 2, 3, 4] and p["p9"].idx == 0
    assert {r.era_slug: (r.season_year_2024, r.agents_added) for r in blocks["patch"].collect()} == {"e1": (1.0, 0.5), "e2": (0.0, 0.5)}
    e = [(r.src_idx, r.dst_idx) for r in links["player", "plays_for", "team"].collect()]
    assert sorted(e) == [(0, 0), (1, 1), (3, 0), (4, 1)]
    a, b = ({r.era_slug: r.fingerprint for r in publish.snapshot_fingerprints(*graph(spark, s)).collect()} for s in (False, True))
    assert a == b and len(a) == 2
    schema = small_features()
    assert publish.validate(blocks, links, node_types=schema[0], edge_types=schema[1]).count() == 0


def test_validator_finds_each_fault(spark):
    types, kinds = {"n": (Feature("x", "minmax"),), "m": (Feature("x", "minmax"),), "gone": (Feature("x", "minmax"),), "w": (Feature("z", "minmax"),)}, {("n", "r", "n"): (Feature("a", "minmax"),), ("n", "s", "n"): (Feature("a", "minmax"),), ("n", "t", "n"): (Feature("a", "minmax"),), ("n", "u", "n"): (), ("n", "v", "n"): (Feature("a", "minmax"),)}
    n = spark.createDataFrame([("e", "i", 0, 2.0), ("e", "i", 1, float("nan")), ("e", " ", 7, 0.5)], "era_slug string, id string, idx long, x double")
    edge = spark.createDataFrame([("e", 5, -1, 3.0), ("e", 0, 0, float("inf"))], "era_slug string, src_idx long, dst_idx long, a double")
    blocks = {"n": n, "m": n.drop("idx"), "w": n, "odd": n}
    links = {("n", "r", "n"): edge, ("n", "s", "n"): edge.drop("a"), ("n", "t", "n"): edge.drop("src_idx"), ("x", "y", "z"): edge, ("n", "v", "n"): edge.withColumnRenamed("a", "b")}
    codes = {r.code for r in publish.validate(blocks, links, "0.9", types, kinds).collect()}
    assert codes == {"schema_version_mismatch", "missing_node_block", "column_mismatch", "shape_mismatch", "non_finite_features", "feature_range_violation", "duplicate_node_ids", "empty_node_ids", "unknown_node_type", "missing_edge_block", "edge_index_shape", "src_index_out_of_bounds", "dst_index_out_of_bounds", "missing_edge_attr", "edge_attr_column_mismatch", "non_finite_edge_attr", "edge_attr_range_violation", "unknown_edge_type"}


def test_publish_is_idempotent(spark, tmp_path, monkeypatch):
    types, kinds = small_features()
    monkeypatch.setattr(publish.validate, "__defaults__", ("1.0.0", types, kinds))
    blocks, links = graph(spark)
    log = spark.createDataFrame([], "kind string, config_hash string, data_fingerprint string, status string")
    runs = publish.publish(blocks, links, log, str(tmp_path), "cfg")
    rows = runs.select("kind", "config_hash", "data_fingerprint", "status").collect()
    assert len(rows) == 2 and {r.status for r in rows} == {"completed"}
    assert publish.publish(blocks, links, spark.createDataFrame(rows), str(tmp_path), "cfg").count() == 0
    assert publish.read_block(spark, str(tmp_path), "player").count() == 6 and publish.read_block(spark, str(tmp_path), relation="plays_for").count() == 4


def test_readers_see_finished_publications_only(spark, tmp_path, monkeypatch):
    """A run that dies before its manifest is seen by no reader; run again it doubles nothing, and the older run stays."""
    from pyspark.sql.readwriter import DataFrameWriter

    types, kinds = small_features()
    monkeypatch.setattr(publish.validate, "__defaults__", ("1.0.0", types, kinds))
    blocks, links = graph(spark)
    log = spark.createDataFrame([], "kind string, config_hash string, data_fingerprint string, status string")
    root = str(tmp_path)
    publish.publish(blocks, links, log, root, "cfg")
    before = sorted(map(str, publish.read_block(spark, root, "player").collect()))
    name = next(c for c in blocks["player"].columns if c not in ("era_slug", "id", "idx"))
    changed = blocks | {"player": blocks["player"].withColumn(name, F.lit(0.25).cast("float"))}
    write = DataFrameWriter.json

    def dies(self, path, *args, **kwargs):
        if "manifest" in path:
            raise RuntimeError("the run dies")
        return write(self, path, *args, **kwargs)

    for _ in range(2):
        monkeypatch.setattr(DataFrameWriter, "json", dies)
        with pytest.raises(RuntimeError):
            publish.publish(changed, links, log, root, "cfg")
        assert sorted(map(str, publish.read_block(spark, root, "player").collect())) == before
        monkeypatch.setattr(DataFrameWriter, "json", write)
    publish.publish(changed, links, log, root, "cfg")
    now = publish.read_block(spark, root, "player")
    assert {r[name] for r in now.collect()} == {0.25} and now.count() == len(before)
    assert publish.read_block(spark, root, relation="plays_for").count() == 4
    assert sorted(map(str, publish.read_block(spark, root, "player", number=1).collect())) == before
    assert publish.read_block(spark, root, "player", config_hash="other").count() == 0


def test_trailing_spend_matches_a_loop(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("ab"), T + timedelta(hours=rng.choice(range(0, 600, 7))), round(rng.uniform(0, 3), 2)) for i in range(150)]
    frame = spark.createDataFrame(rows, "id int, purpose string, timestamp timestamp_ntz, usd_cost double")
    before = lambda r, own: sum(x[3] for x in rows if r[2] - timedelta(7) <= x[2] < r[2] and (not own or x[1] == r[1]))
    for own, found, column in ((True, spend.trailing_spend(frame), "purpose_trailing"), (False, spend.trailing_total(frame), "total_trailing")):
        got = {r.id: r[column] for r in found.collect()}
        assert got == {r[0]: pytest.approx(before(r, own)) for r in rows}


def test_file_fingerprint(spark, tmp_path):
    def print_of():
        return publish.file_set_fingerprint(tables.file_tree(spark, str(tmp_path))).first()[0]

    (tmp_path / "a").mkdir()
    (tmp_path / "a/x").write_text("1")
    (tmp_path / "y").write_text("2")
    first = print_of()
    assert first == print_of()
    (tmp_path / "y").write_text("3")
    assert print_of() != first


def test_digest_and_audit(spark):
    rows = [(1, T, "m", "personality", "post", 10, 20, 1, 14.0), (2, T + timedelta(1), "m", "personality", "post", 10, 20, 1, 2.0), (3, T + timedelta(2), "m", "chat", "error", 1, 1, 0, 1.0), (4, T + timedelta(3), "m", "patch_intent", "blocked", 1, 1, 0, 9.0), (5, T + timedelta(8), "m", "personality", "post", 1, 1, 0, 13.5)]
    led = spark.createDataFrame(rows, "id int, timestamp timestamp_ntz, model string, purpose string, phase string, input_tokens int, output_tokens int, cache_read_input_tokens int, usd_cost double")
    d = {r.purpose: (r.spend, r.calls, r.blocked, r.percent_of_cap) for r in spend.digest_by_purpose(led, F.lit(T)).collect()}
    assert d == {"personality": (29.5, 3, 0, pytest.approx(29.5 / 15 * 100)), "chat": (1.0, 1, 0, None), "patch_intent": (0.0, 0, 1, 0.0)}
    assert {r.id: r.breach for r in spend.audit_caps(led).collect()} == {1: None, 2: "purpose", 3: None, 4: "purpose", 5: "purpose"}
    assert spend.spend_since(led, F.lit(T + timedelta(99))).first()[0] == 0.0


def test_rules_gate(spark):
    edges = spark.createDataFrame([("a", "a", "teammate", 0.5, 0.0), ("b", "a", "teammate", 1.5, 0.0), ("a", "b", "mentor", 0.5, None)], "src_id string, dst_id string, edge_type string, strength double, sentiment double")
    good, bad = quality.split_bad(edges, quality.edge_checks())
    assert good.count() == 1 and {r.src_id: r.violations for r in bad.collect()} == {"a": ["self_edge"], "b": ["unordered_pair", "strength_range"]}
    found = quality.report(spark, [*quality.review_gates(edges, 2, 1), quality.sql_rule("none", "error", "select count(*) from range(0)")])
    with pytest.raises(ValueError, match="review_queue_fail"):
        quality.gate(found)
    assert quality.gate(found.where("severity = 'warn'")) == ["review_queue_warn"]
    values, ranges = spark.createDataFrame([("p", "aim", 120.0), ("p", "aim", 50.0)], "id string, attribute string, value double"), spark.createDataFrame([("aim", 0.0, 100.0)], "attribute string, low double, high double")
    assert quality.out_of_range(values, ranges).count() == 1


def csv_row(**over):
    row = {c: "1" for c in ingest.CSV_COLUMNS} | {"MatchID": "m1", "GameID": "g1", "EventID": "e1", "Date": "2024-01-05", "Team1ID": "10", "Team2ID": "20", "Team1 Name": "Ten", "Team2 Name": "Twenty", "Event Name": "Cup"}
    return row | over


def test_seed(spark, tmp_path):
    import csv

    rows = [csv_row(), csv_row(GameID="g2", **{"Team1 Name": "Ten!"}), csv_row(GameID="g2"), csv_row(MatchID="m2", GameID="g3", Team2ID="0"), csv_row(MatchID="m3", GameID="g4", Date="1970-01-01"), csv_row(MatchID="m4", GameID="g5", Map="x"), csv_row(MatchID="m5", GameID="g6", Date="bad"), csv_row(MatchID="m1", GameID="g7", Date="zz")]
    with (tmp_path / "maps.csv").open("w", encoding="utf-8-sig", newline="") as f:
        w = csv.DictWriter(f, ingest.CSV_COLUMNS)
        w.writeheader()
        w.writerows(rows)
    raw = tables.read_csv(spark, str(tmp_path / "maps.csv"), ingest.CSV_COLUMNS)
    none = lambda s: spark.createDataFrame([], s)
    out = ingest.seed_maps(raw, none("site_match_id string"), none("site_game_id string"))
    assert {(r.entity_type, r.site_id, r.name) for r in out["entities"].collect()} == {("team", "10", "Ten"), ("team", "20", "Twenty"), ("tournament", "e1", "Cup")} or {r.name for r in out["entities"].collect()} >= {"Twenty", "Cup"}
    m = {r.site_match_id: r for r in out["matches"].collect()}
    assert set(m) == {"m1", "m2"} and m["m2"].team2 is None and m["m1"].team2 is not None
    assert {r.site_game_id for r in out["maps"].collect()} == {"g1", "g2", "g3", "g7"} and len(out["maps"].first().team1_stats) == 18
    assert {r.GameID: r.violations for r in out["quarantine"].collect()} == {"g5": ["not_whole:Map"], "g6": ["bad_date"]}
    again = ingest.seed_maps(raw, out["matches"].select("site_match_id"), out["maps"].select("site_game_id"))
    assert again["matches"].count() == 0 and again["maps"].count() == 0


HTML = """<html><head><title>t</title><meta property="article:published_time" content="2024-04-30T13:00:00Z"></head><body><nav><a href="/team/1/nav">nav</a></nav>
<div class="match" data-match-id="77" data-utc-ts="2024-01-01T00:00:00Z"><a href="/team/5/alpha"> Alpha <b>X</b></a><br><a href="/team/6/beta"></a></div>
<a href="/player/9/tenz">TenZ</a><a>no link</a><article><h1>Patch Notes 8.05b</h1><script>x</script><p>Some</p><p>body</p></article></body></html>"""


def test_pages(spark):
    frame = spark.createDataFrame([(1, "u", HTML), (2, "u", None)], "page_id long, url string, html string")
    found = pages.anchors(frame)
    assert [(r.href, r.text, r.match_id) for r in found.orderBy("pos").collect()] == [("/team/1/nav", "nav", None), ("/team/5/alpha", "Alpha X", "77"), ("/team/6/beta", "", "77"), ("/player/9/tenz", "TenZ", None)]
    kinds = lambda t: {(r.entity_type, r.site_id, r.name) for r in pages.profile_rows(found, spark.createDataFrame([(1, t)], "page_id long, page_type string")).collect()}
    assert kinds("matches") == {("team", "5", "Alpha X"), ("team", "6", "beta")} and kinds("stats") == {("player", "9", "TenZ")} and ("team", "1", "nav") in kinds("rankings")
    a = {r.page_id: r for r in pages.articles(frame).collect()}
    assert a[1].title == "Patch Notes 8.05b" and a[1].patch_version == "8.05b" and a[1].body_text == "Patch Notes 8.05b\nSome\nbody" and not a[1].drift and a[2].drift
    stored = spark.createDataFrame([], "source string, patch_version string, published_at timestamp, raw_html string, body_text string, url string, fetched_at timestamp")
    notes, drift = ingest.ingest_articles(frame, stored, "site", "2024-05-01 00:00:00")
    assert [r.outcome for r in notes.collect()] == ["inserted"] and drift.count() == 1
    again, _ = ingest.ingest_articles(frame, notes.drop("outcome"), "site", "2024-05-02 00:00:00")
    assert [(r.outcome, r.fetched_at.day) for r in again.collect()] == [("unchanged", 2)]


def test_stat_backfill(spark):
    """A row is player, agent, twelve numbers; sides are mod-t1 and mod-t2, on the row or on a cell."""
    cells = lambda n: "".join(f"<td>{c}</td>" for c in ["1.25", "240", "21", "12", "5", "+9", "75%", "155.4", "30%", "3", "1", "+2"][:n])
    row = lambda who, n, side="", cell="": f'<tr class="{side}"><td class="mod-player {cell}"><a href="/player/{who}/slug{who}"> P{who} </a></td><td><img title="Jett" alt="other"></td>{cells(n)}</tr>'
    html = f'<a href="/player/7/out">outside</a><div data-game-id="g1"><table><tr><th>head</th></tr>{row(9, 12, "mod-t1")}{row(5, 12, "", "mod-t2")}{row(8, 4)}</table></div><div data-game-id="g9"><table>{row(9, 12)}</table></div>'
    frame = spark.createDataFrame([(1, html)], "page_id long, html string")
    maps = spark.createDataFrame([("g1", "map1")], "site_game_id string, map_result_id string")
    aliases = spark.createDataFrame([("c9", "vlr", "player-9"), ("c5", "vlr", "player-5")], "canonical_id string, platform string, platform_id string")
    out = ingest.backfill_stats(frame, maps, aliases, spark.createDataFrame([], "map_result_id string, entity_id string"))
    numbers = {"agent": "jett", "rating": 1.25, "acs": 240.0, "kills": 21, "deaths": 12, "assists": 5, "kast_pct": 75.0, "adr": 155.4, "hs_pct": 30.0, "first_kills": 3, "first_deaths": 1}
    got = {r.entity_id: r.asDict() for r in out["stats"].collect()}
    assert got == {e: {"map_result_id": "map1", "entity_id": e, "team_side": side, **numbers} for e, side in (("c9", "team1"), ("c5", "team2"))}
    assert [r.name for r in out["drift"].collect()] == ["P8"] and out["unknown_maps"].count() == 1


def test_ingest_pass(spark):
    payload = lambda rows: json.dumps({"page_type": "stats", "url": "u", "rows": rows})
    player = [{"entity_type": "player", "site_id": "9", "name": "TenZ"}]
    raw = spark.createDataFrame([("vlr", T, payload(player)), ("vlr", T, payload(player)), ("vlr", T, '{"page_type": "odd"}'), ("vlr", T, "not json")], "source string, fetched_at timestamp_ntz, payload string")
    seen = spark.createDataFrame([], "source string, content_hash string")
    aliases, entities = alias_tables(spark, [("c1", "player-9", "TenZ")])
    out = ingest.ingest(raw, tables.page_payload_spec(), seen, aliases, entities)
    s = out["stats"].first()
    assert (s.fetched, s.new, s.drift, s.records, s.duplicate) == (4, 3, 2, 1, 1)
    assert [(r.status, r.canonical_id) for r in out["staging"].collect()] == [("processed", "c1")] and out["raw_records"].count() == 3
    again = ingest.ingest(raw, tables.page_payload_spec(), out["raw_records"].select("source", "content_hash"), aliases, entities)
    assert again["stats"].first().new == 0


def test_match_json(spark):
    doc = {"matchInfo": {"matchId": "m"}, "players": [{"puuid": "a", "gameName": "A", "tagLine": "1", "teamId": "t"}, {"puuid": "b", "gameName": "", "tagLine": "1"}], "roundResults": [{"roundNum": 1, "playerStats": [{"puuid": "a", "score": 5}, {"puuid": "b", "score": 6}]}]}
    good, drift = tables.match_spec().validate(spark.createDataFrame([("riot", json.dumps(doc)), ("riot", "{}")], "source string, payload string"))
    rows = tables.match_players(good).collect()
    assert len(rows) == 1 and rows[0].platform_name == "A#1" and rows[0].rounds[0].own.score == 5 and rows[0].rounds[0].others == ["b"]
    assert drift.count() == 1 and tables.incomplete_players(good).first()[0] == 1


def test_event_log(spark):
    lines = spark.createDataFrame([('{"id":"1","kind":"match_played","ts":"2024-01-01T00:00:00Z","match_id":"m"}',), ('{"id":"2","kind":"odd"}',), ("junk",)], "value string")
    typed, bad = tables.read_events(lines)
    assert typed["match_played"].first().match_id == "m" and bad.count() == 2


def test_nearest_keeps_versions_apart(spark):
    rows = spark.createDataFrame([("a", [1.0, 0.0], "v1"), ("b", [1.0, 0.1], "v1"), ("c", [1.0, 0.0], "v2"), ("d", [0.0, 0.0], "v1"), ("e", [0.0, 1.0], "v1")], "entity_id string, embedding array<float>, model_version string")
    assert [r.entity_id for r in similar.nearest(rows, "a", 10).collect()] == ["b", "e", "d"]
    with pytest.raises(ValueError):
        similar.nearest(rows, "zz")
    with pytest.raises(ValueError):
        similar.nearest(rows, "a", 0)
    near = similar.all_neighbours(rows.where("model_version = 'v1'"), 2, threshold=0.5)
    assert ("a", "b") in {(r.entity_id, r.neighbour_id) for r in near.collect()}


def test_cells_find_nearest(spark, tmp_path):
    """Recall of at least 0.9 over the given vectors with a part of the cells, all of it with every cell; versions and
    zero vectors stay apart."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").alias("entity_id"), "embedding", F.when(F.col("vec_id") % 2 == 0, "a").otherwise("b").alias("model_version"))
    rows = rows.unionByName(spark.createDataFrame([(99_998, [0.0] * 64, "a"), (99_999, None, "a")], rows.schema))
    index = similar.build_cells(rows, str(tmp_path), cells=20)
    asked = index.rows.where("id % 100 in (0, 1)").select("id", "vector", "model_version")
    pairs = asked.collect()
    import numpy as np

    exact = []
    for version in "ab":
        own = [(r.id, r.vector) for r in index.rows.where((F.col("model_version") == version) & (F.col("cell") >= 0)).collect()]
        x = np.array([v for _, v in own])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        ids = np.array([i for i, _ in own])
        for r in pairs:
            if r.model_version == version:
                d = 1 - x @ (np.array(r.vector) / np.linalg.norm(r.vector))
                exact += [(r.id, int(ids[j])) for j in [j for j in np.lexsort((ids, d)) if ids[j] != r.id][:10]]
    truth = spark.createDataFrame(exact, "query_id long, id long")
    some = similar.recall(similar.nearest_in_cells(index, asked, 10, probes=10), truth).first()
    every = similar.recall(similar.nearest_in_cells(index, asked, 10, probes=20), truth).first()
    print(f"recall {some.found / some.pairs:.3f} with half of the cells")
    assert some.found >= 0.9 * some.pairs and every.found == every.pairs == len(exact)
    assert {r.cell for r in index.rows.where("id = 99998").collect()} == {-1} and index.rows.where("id = 99999").isEmpty()
    # The plan of one query reads the folders of its cells alone.
    one = similar.nearest_in_cells(similar.open_cells(spark, str(tmp_path)), asked.limit(1), 5, probes=2)
    assert one.count() == 5 and "dynamicpruning" in one._jdf.queryExecution().toString()


def test_chunk_job(spark):
    stored = spark.createDataFrame([("m", 0, "old", [0.0], "v"), ("m", 1, "old", [0.0], "v"), ("n", 0, "keep", [0.0], "v")], "media_id string, chunk_idx int, chunk_text string, embedding array<float>, model_version string")
    texts = spark.createDataFrame([("m", "a b c")], "media_id string, text string")
    out = similar.chunk_job(stored, texts, lambda t: [[len(x)] for x in t], 1, "v", 180)
    assert {(r.media_id, r.chunk_idx, r.chunk_text, tuple(r.embedding)) for r in out.collect()} == {("m", 0, "a b c", (5.0,)), ("n", 0, "keep", (0.0,))}


def test_intents(spark):
    good = {"agents_affected": ["jett"], "maps_affected": [], "shifts": [{"subject": "jett", "direction": "nerf", "magnitude": 0.5, "rationale": "r"}], "pro_play_score": 0.5, "community_score": 0.1, "confidence": 0.9}
    bad = good | {"confidence": 2.0}
    replies = spark.createDataFrame([("n1", "v1", f"```json\n{json.dumps(good)}\n```"), ("n2", "v1", json.dumps(bad)), ("n3", "v1", "nope")], "patch_note_id string, prompt_version string, reply string")
    intents, quarantine = derive.load_intents(replies)
    assert [r.patch_note_id for r in intents.collect()] == ["n1"] and {r.patch_note_id: r.violations for r in quarantine.collect()} == {"n2": ["confidence_range"], "n3": ["not_an_object"]}
    assert derive.affecting(intents, "jett").count() == 1
    notes = spark.createDataFrame([("n1", "s", T, "t", "b"), ("n2", "s", T, "t", " b ")], "id string, source string, published_at timestamp_ntz, title string, body_text string")
    todo = derive.pending_intents(notes, intents, "v1").collect()
    assert [(r.id, r.request) for r in todo] == [("n2", "# t\n## Notes\nb")]


def test_stream_replay_is_a_no_op(spark, tmp_path):
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    landing.mkdir()
    line = lambda p: json.dumps({"source": "s", "fetched_at": "2024-01-01T00:00:00", "payload": p}) + "\n"
    (landing / "1.json").write_text(line('{"a":1}') + line('{"a":1}') + line('{"a":2}'))
    run = lambda check: incremental.run_available(incremental.read_landing_stream(spark, str(landing), "source string, fetched_at timestamp, payload string"), incremental.append_raw(raw), str(tmp_path / check))
    run("c1")
    assert spark.read.parquet(raw).count() == 2
    (landing / "2.json").write_text(line('{"a":2}') + line('{"a":3}'))
    run("c1")
    assert spark.read.parquet(raw).count() == 3
    batch = spark.read.schema("source string, fetched_at timestamp, payload string").json(str(landing / "2.json"))
    incremental.append_raw(raw)(batch, 1)
    assert spark.read.parquet(raw).count() == 3


PAGE_STREAM = "source string, fetched_at timestamp, payload string"


def page_lines(*pages):
    """Lines of a landing: (fetched minute, records as (site id, name))."""
    return "".join(json.dumps({"source": "vlr", "fetched_at": f"2024-01-01T00:{m:02}:00", "payload": json.dumps({"page_type": "stats", "url": "u", "rows": [{"entity_type": "player", "site_id": i, "name": n} for i, n in rows]})}) + "\n" for m, rows in pages)


def run_pass(spark, landing, store, checkpoint):
    stream = passes.unseen(incremental.read_landing_stream(spark, str(landing), PAGE_STREAM, files_per_batch=1))
    incremental.run_available(stream, passes.staging_pass(store, tables.page_payload_spec()), str(checkpoint))


def pass_rows(store):
    return {name: sorted(map(str, store.read(name, schema).collect())) for name, schema in passes.PASS_TABLES.items()}


def test_a_streamed_pass_resolves_and_survives_a_cut(spark, tmp_path):
    """Batches are resolved against what earlier ones left; a batch cut off between two tables is seen in none, and the
    next run ends as one that was never cut."""
    landing = tmp_path / "landing"
    landing.mkdir()
    pages_of = [page_lines((0, [("1", "Northwind"), ("2", "Quasar Blaze")]), (0, [("1", "Northwind"), ("2", "Quasar Blaze")])), page_lines((1, [("3", "northwind"), ("4", "Northwine X")]), (2, [("1", "Northwind"), ("2", "Quasar Blaze")])), page_lines((3, [("5", "Someone New")]), (4, [("9", None)]))]
    for i, text in enumerate(pages_of):
        (landing / f"{i}.json").write_text(text)
    whole = passes.BatchTables(spark, str(tmp_path / "whole"))
    run_pass(spark, landing, whole, tmp_path / "c0")
    assert whole.last() == 2

    class Cut(passes.BatchTables):
        left = 12  # tables until the power goes: within the second batch

        def put(self, name, *args):
            Cut.left -= 1
            if Cut.left == 0:
                raise RuntimeError("cut off")
            return super().put(name, *args)

    cut = Cut(spark, str(tmp_path / "cut"))
    with pytest.raises(Exception, match="cut off"):
        run_pass(spark, landing, cut, tmp_path / "c1")
    assert cut.last() == 0 and (tmp_path / "cut/landed/batch=1").exists()
    first = pass_rows(cut)
    assert len(first["raw"]) == 1 and len(first["entities"]) == 2 and all("northwind" not in r for r in first["aliases"])
    run_pass(spark, landing, cut, tmp_path / "c1")
    assert pass_rows(cut) == pass_rows(whole)
    got = {r.platform_id: r.canonical_id for r in cut.read("staging", passes.PASS_TABLES["staging"]).collect()}
    assert got["player-1"] == got["player-3"] and len(set(got.values())) >= 3
    assert [r.violations for r in cut.read("drift", passes.PASS_TABLES["drift"]).collect()] == [["row_keys"]]
    # A batch that was finished is left alone when it is run again.
    passes.staging_pass(cut, tables.page_payload_spec())(spark.createDataFrame([("vlr", T, "{}")], PAGE_STREAM), 1)
    assert pass_rows(cut) == pass_rows(whole)


def test_unseen_reads_no_history(spark, tmp_path):
    """What was seen is keyed state: the plan of a late batch scans its own file alone, and no copy passes twice."""
    landing = tmp_path / "landing"
    landing.mkdir()
    for i in range(4):
        (landing / f"{i}.json").write_text(page_lines(*[(m, [(str(k), "n")]) for m in range(2) for k in range(i * 3, i * 3 + 5)]))
    seen = []

    def each(batch, number):
        seen.append(sorted(r.content_hash for r in batch.collect()))

    incremental.run_available(passes.unseen(incremental.read_landing_stream(spark, str(landing), PAGE_STREAM, files_per_batch=1)), each, str(tmp_path / "c"))
    assert [len(x) for x in seen] == [5, 3, 3, 3] and len({h for x in seen for h in x}) == 14


def test_streamed_trailing_spend_is_exact(spark, tmp_path):
    rng = random.Random(4)
    calls = [(f"{i:03}", T + timedelta(hours=i * 5 + rng.randrange(4)), rng.choice(["personality", "chat"]), "post", round(rng.uniform(0, 4), 2)) for i in range(90)]
    src = tmp_path / "calls"
    for k in range(3):
        spark.createDataFrame(calls[k * 30 : k * 30 + 30], passes.LEDGER).coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(passes.LEDGER).option("maxFilesPerTrigger", 1).parquet(str(src))
    store = passes.BatchTables(spark, str(tmp_path / "store"))
    incremental.run_available(stream, passes.trailing_pass(store), str(tmp_path / "c"))
    got = {r.id: (r.purpose_trailing, r.total_trailing, r.breach) for r in store.read("audit", "id string, timestamp timestamp_ntz, purpose string, purpose_trailing double, total_trailing double, breach string").collect()}
    want = {r.id: (r.purpose_trailing, r.total_trailing, r.breach) for r in spend.audit_caps(spark.createDataFrame(calls, passes.LEDGER)).collect()}
    assert got == want and store.last() == 2


def test_the_first_fetched_of_equal_payloads_stays(spark):
    rows = spark.createDataFrame([("s", "h", T + timedelta(2), "late"), ("s", "h", T, "first"), ("s", "h", None, "never"), ("s", "g", T, "x"), ("s", "old", T, "x")], "source string, content_hash string, fetched_at timestamp_ntz, payload string").repartition(3)
    seen = spark.createDataFrame([("s", "old")], "source string, content_hash string")
    assert {(r.content_hash, r.payload) for r in merge.append_unseen(seen, rows, ["source", "content_hash"], "fetched_at").collect()} == {("h", "first"), ("g", "x")}


def test_streamed_edges_match_the_loop(spark, tmp_path):
    src = tmp_path / "ev"
    rows = [(f"x{i:02}", "1" if i % 2 else "2", "rival", T + timedelta(days=i // 4), 0.4 if i % 3 else -0.5, 0.2) for i in range(12)]
    spark.createDataFrame(rows, "event_id string, edge_id string, edge_type string, occurred_at timestamp_ntz, delta_strength double, delta_sentiment double").coalesce(1).write.parquet(str(src))
    stream = spark.readStream.schema(spark.read.parquet(str(src)).schema).parquet(str(src))
    q = incremental.evolve_edges(stream).writeStream.format("memory").queryName("edges").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.edge_id: r for r in spark.sql("select * from edges").collect()}
    for k in "12":
        mine = sorted((r[3], r[0], r[4], r[5]) for r in rows if r[1] == k)
        s, m, _ = folded(0.0, 0.0, mine[0][0] - timedelta(1), "rival", mine)
        assert got[k].strength == pytest.approx(s) and got[k].sentiment == pytest.approx(m) and got[k].events == 6


def test_windowed_spend(spark):
    rows = spark.createDataFrame([(T + timedelta(i), "p", 1.0) for i in range(10)], "timestamp timestamp_ntz, purpose string, usd_cost double")
    assert max(r.spend for r in incremental.windowed_spend(rows).collect()) == 7.0


@pytest.mark.parametrize("n", [1, 4, 32])
def test_partitions_change_nothing(spark, n):
    from seriesgraph.plans import queries

    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        rows = sorted(tuple(r) for r in queries.pairs_decay(spark, "/root/testdata/sf0.001").collect())
        index = sorted(tuple(r) for r in queries.node_index(spark, "/root/testdata/sf0.001").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert hash(tuple(rows)) == test_partitions_change_nothing.__dict__.setdefault("first", hash(tuple(rows)))
    assert [i for _, i in index] == list(range(len(index)))




def test_small_surfaces(spark, tmp_path):
    media = spark.createDataFrame([("1", "en", "a"), ("2", "de", "b")], "id string, language string, text string")
    tables.write_json_documents(media, str(tmp_path / "json"), 1)
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    links = spark.createDataFrame([(1, 0, "/en-us/news/game-updates/valorant-patch-notes-8-05"), (1, 1, "/en-us/news/game-updates/valorant-patch-notes-8-05"), (1, 2, "/en-us/news/tags/patch-notes/"), (2, 0, "/news/other/x")], "page_id int, pos int, href string")
    assert [(r.page_id, r.pos) for r in pages.article_links(links).collect()] == [(1, 0)]
    aliases, entities = alias_tables(spark, [("c1", "p1", "TenZ"), ("c2", "p2", "Dup"), ("c3", "p3", "dup")])
    assert similar.resolve_target(aliases, entities, "tenz") == "c1"
    for bad in ("dup", "nobody"):
        with pytest.raises(ValueError):
            similar.resolve_target(aliases, entities, bad)
    blocks, _ = graph(spark)
    assert {(r.era_slug, r.node_type): r.n for r in features.summary(blocks).collect()} == {("e1", "player"): 5, ("e2", "player"): 1, ("e1", "team"): 2, ("e1", "patch"): 1, ("e2", "patch"): 1}
    queue = spark.createDataFrame([("v", "1", "pending", T + timedelta(1)), ("v", "1", "pending", T), ("v", "2", "done", T)], "platform string, platform_id string, status string, created_at timestamp_ntz")
    assert [(r.platform_id, r.created_at) for r in resolve.oldest_pending_review(queue).collect()] == [("1", T)]
    stored = spark.createDataFrame([("a", [1.0, 2.0])], "entity_id string, embedding array<float>")
    assert similar.upsert_vectors(stored, spark.createDataFrame([("a", [3.0, 4.0]), ("b", [5.0, 6.0])], stored.schema), "entity_id", 2).count() == 2
    with pytest.raises(Exception, match="vectors need"):
        similar.upsert_vectors(stored, spark.createDataFrame([("a", [3.0])], stored.schema), "entity_id", 2).collect()
    edges = spark.createDataFrame([("p1", "t1"), ("p9", "t1"), ("p1", "t9"), ("p9", "t9")], "src string, dst string")
    ends = lambda *x: spark.createDataFrame([(v,) for v in x], "id string")
    assert quality.orphans(edges, ends("p1"), ends("t1"), "src", "dst", "id", "id").count() == 3
    assert merge.replace_rows(media, media.where("id = '1'").withColumn("text", F.lit("z")), ["id"]).where("text = 'z'").count() == 1
    runs = spark.createDataFrame([("r1", "snapshot", "done", "c", "f", T, T + timedelta(seconds=5)), ("r2", "snapshot", "running", "c", "g", T + timedelta(1), None)], "run_id string, kind string, status string, config_hash string, data_fingerprint string, started_at timestamp_ntz, finished_at timestamp_ntz")
    assert [(r.run_id, r.duration_seconds) for r in publish.list_runs(runs, "snapshot").collect()] == [("r2", None), ("r1", 5.0)] and publish.lookup_run(runs, "snapshot", "c", "f").count() == 1
    bad = spark.createDataFrame([("pending", None, '{"a": 1, "odd": 2}')], "status string, canonical_id string, payload string")
    assert bad.select(quality.unknown_keys(F.col("payload"), ["a"])).first()[0] == ["odd"]
    assert merge.outcome_counts(bad, "status").first().n == 1 and tables.keyed(bad, status=["pending"]).count() == 1
