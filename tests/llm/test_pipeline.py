"""The pipeline against its stages done by hand on a small table."""

import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from seriesgraph.llm import toxicity
from seriesgraph.llm.common import written

from .test_operators import brute_components, texts, toxic_rows, whole_ids


def tables(spark, folder):
    rows, labels = toxic_rows()
    more = [(1000 + i, t) for i, t in enumerate(texts(9)[:90])]
    more += [(2000, "a letter with password=abcdef123 in it and deadbeefdeadbeefdeadbeef12 too"), (2001, None), (2002, ""), (None, "no id here"), (1000, more[0][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows + more], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages(spark, tmp_path):
    tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    net_texts, target = toxicity.training_sample(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    net = toxicity.train(net_texts, target)

    kept = written(corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path)))
    assert kept.columns == columns
    all_rows = [(r.doc_id, r.text) for r in docs.collect()]
    scores = toxicity.text_scores(net, 0.0, [t for _, t in all_rows])
    expect = [r for r, s in zip(all_rows, scores) if s < 0.3]
    assert sorted(map(str, expect)) == sorted(str((r.doc_id, r.text)) for r in kept.collect())

    one = written(corpus_pipeline.STAGES[1][1](spark, kept, str(tmp_path)))
    assert one.columns == columns
    stay = {str(d) for d, _, c in brute_components(expect) if d == c}
    assert sorted(str(r.doc_id) for r in one.collect()) == sorted(stay)

    clean = written(corpus_pipeline.STAGES[2][1](spark, one, str(tmp_path)))
    assert clean.columns == columns and clean.count() == one.count()
    got = {r.doc_id: r for r in clean.collect()}
    assert got[2000].text == "a letter with [SECRET] in it and [SECRET] too" and got[2000].n_chars == len(got[2000].text)
    same = {r.doc_id: r.text for r in one.where("doc_id != 2000").collect()}
    assert all(got[k].text == v for k, v in same.items())

    pieces = corpus_pipeline.STAGES[3][1](spark, clean, str(tmp_path)).collect()
    by = {}
    for p in sorted(pieces, key=lambda p: p.start):
        by[p.doc_id] = by.get(p.doc_id, b"") + bytes(p.ids)
    assert by == {r.doc_id: np.array(whole_ids(r.text, "word_bpe_49k.json"), "<u4").tobytes() for r in clean.collect()}


def test_near_duplicates_are_decided_by_row(spark):
    """Null ids, rows without words and an id that stands for two texts."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(200)) for x in "abc")
    rows = [(None, ""), (None, ""), (None, None), (None, None), (5, ""), (5, ""), (1, a), (2, b), (2, a.replace("a0 ", "z ")), (None, b), (None, c), (None, c), (7, c)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, "").collect()
    assert sorted(str((r.doc_id, r.text)) for r in got) == sorted(map(str, rows[:8] + rows[-1:]))


def test_other_columns_pass_through(spark, tmp_path):
    """Every stage that filters or changes documents, with columns of the names that it works with itself."""
    names = ["score", "held_out", "predicted", "blob", "spans", "before", "row", "_row", "_rank", "component_id", "key"]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(1, "one two three four five six password=abcdef1"), (2, "one two three four five six password=abcdef1"), (3, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.col("doc_id").cast("string")))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = written(stage(spark, docs, str(tmp_path)))
        assert out.columns == docs.columns
        got = sorted(out.drop("text", "n_chars").collect())
        assert got == [r for r in sorted(docs.drop("text", "n_chars").collect()) if k != 1 or r.doc_id != 2]


def test_run_equals_its_stages(spark, tmp_path):
    tables(spark, str(tmp_path))
    out = corpus_pipeline.run(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, str(tmp_path)))
    sums = lambda df: sorted((str(r.doc_id), r.n) for r in df.groupBy("doc_id").agg(F.sum("length").alias("n")).collect())
    assert sums(out) == sums(docs)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_no_import_errors_are_swallowed():
    source = open(corpus_pipeline.__file__).read()
    assert not re.search(r"except\s*(ImportError|ModuleNotFoundError|Exception)", source)


def test_stages_take_any_column_names(spark, tmp_path):
    """Columns with dots and backticks in their names pass through every stage."""
    tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").where("doc_id >= 1000").limit(40).withColumn("a.b", F.lit(1)).withColumn("c`d", F.col("text"))
    before = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, str(tmp_path)))
        assert docs.columns == before and docs.where("`a.b` = 1").count() == docs.count() > 0
