"""What must not grow with the input: rows of a task, and work that a hot key would bring to one."""

from pyspark.sql import functions as F

from seriesgraph.operators import spend


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prices_go_to_the_usage(spark):
    """Usage of few models is not exchanged by model, where one task would get all of a model's rows."""
    prices = spark.createDataFrame([("m0", 2.0, 4.0), ("m1", 1.0, 1.0)], "model string, input_per_mtok double, output_per_mtok double")
    usage = spark.range(10).select(F.concat(F.lit("m"), F.col("id") % 1).alias("model"), F.lit(1_000_000).alias("input_tokens"), *[F.lit(None).cast("long").alias(c) for c in ("output_tokens", "cache_write_5m_tokens", "cache_write_1h_tokens", "cache_read_tokens")])
    rows = spend.priced(usage, prices)
    assert "BroadcastHashJoin" in plan(rows) and "hashpartitioning(model" not in plan(rows)
    assert [r.usd_cost for r in rows.collect()] == [2.0] * 10


def test_rosters_are_dealt_by_their_rows(spark, monkeypatch):
    """The lines of orders lie in as many tasks as their number needs, and sides are gathered without another exchange."""
    from seriesgraph.operators import relations
    from seriesgraph.plans import queries
    from seriesgraph.sources.shared import tasks_for

    assert tasks_for(spark.range(25), 2) == 13 and tasks_for(spark.range(25), 100) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(queries, "tasks_for", lambda df: 13)
    rows = queries._rosters(spark, "/root/testdata/sf0.001")
    sides = plan(relations._sides(rows))
    assert sides.count("Exchange hashpartitioning(l_orderkey") == 1 and ", 13), REPARTITION_BY_NUM" in sides and "hashpartitioning(map_id" not in sides
    assert rows.rdd.getNumPartitions() == 13


def test_edges_are_dealt_by_their_rows(spark, monkeypatch):
    """Pairs are made distinct where the counted rows were dealt to, a supplier's in several tasks."""
    from seriesgraph.plans import queries

    monkeypatch.setattr(queries, "tasks_for", lambda df: 13)
    shown = plan(queries.edges_long(spark, "/root/testdata/sf0.001"))
    assert "Exchange hashpartitioning(l_suppkey" in shown and ", 13), REPARTITION_BY_NUM" in shown and shown.count("hashpartitioning(l_suppkey") == 1


def test_plain_pages_need_no_parser(monkeypatch):
    """Plain markup is read by one expression, to what the parser makes of it; other pages still go to the parser."""
    from seriesgraph.sources import pages

    row = '<tr class="mod-t2"><td><a href="/player/7/me">Me</a></td><td class="x"><img alt="odd" title="Sova"></td>' + "".join(f"<td>{i}</td>" for i in range(11)) + "<td>a &amp; b</td></tr>"
    stats = f'<html><body><div data-game-id="g1"><table>{row * 2}</table></div></body></html>'
    article = '<html><head><title>t</title></head><body><nav>m</nav><article><h1>Notes &lt;1</h1><time datetime="2024-01-02T00:00:00Z"></time><script>var a = "<p>";</script><p>x<br>y</p></article></body></html>'
    rows = lambda h: [pages._player_row(r) for r in pages._fed(pages._Tables(), h).rows]
    slow = [(rows(f"<!-- -->{stats}"), pages._article(f"<!-- -->{article}"))]
    assert slow[0][0][0]["side"] == "team2" and slow[0][0][1]["cells"][-1] == "a & b" and slow[0][1] == ("Notes <1", "2024-01-02T00:00:00Z", "Notes <1\nx\ny")

    def feed(self, data):
        raise AssertionError("parsed")

    monkeypatch.setattr(pages._Tree, "feed", feed)
    assert (rows(stats), pages._article(article)) == slow[0]


def test_cells_are_met_in_parts(spark, tmp_path, monkeypatch):
    """Vectors and queries of a cell meet as blocks, a large cell in parts; with all cells asked the answer is exact, ties go to the smaller id."""
    from seriesgraph.operators import similar

    monkeypatch.setattr(similar, "CELL_ROWS", 16)
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").where("vec_id < 200").select(F.explode(F.array(F.col("vec_id"), F.col("vec_id") + 1000)).alias("entity_id"), "embedding", F.lit("v").alias("model_version"))
    index = similar.build_cells(rows, str(tmp_path), cells=4)
    asked = index.rows.where("id in (7, 1100)").select("id", "vector", "model_version")
    found = similar.nearest_in_cells(index, asked, 5, probes=4)
    assert "FlatMapCoGroupsInArrow" in plan(found) and "dynamicpruning" in found._jdf.queryExecution().toString()
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, round(r.distance, 9)))
    assert got == {q: [(r.entity_id, round(r.distance, 9)) for r in similar.nearest(rows, q, 5).collect()] for q in (7, 1100)}
