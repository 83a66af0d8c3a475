"""The queries of this subpackage, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import additive, brown, codes, divergence, frames, jaccard, packing, pieces, secrets, sharding, topk, toxicity, warc


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file; never copied into the repository."""
    return importlib.import_module("public_tokenizers").path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_examples(_read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")).drop("ids")


def op3_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.token_digest(_read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_read(spark, sf_dir, "documents"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digest(_read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digest(_read(spark, sf_dir, "pages"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(_read(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents"))


def op10_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive.approximate_top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress_vectors(_read(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(_read(spark, sf_dir, "documents"))


def op13_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_texts(_read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_toxicity, op2_packing, op3_token_frames, op4_jaccard, op5_pieces, op6_top_k, op7_warc, op8_secrets, op9_sharding, op10_additive, op11_vector_codes, op12_source_divergence, op13_brown_classes)
}


def _sql_vector_codes() -> str:
    """Rounds of assignment and means over 16 parts and 64 entries, each a pair of CTEs."""
    near = "SELECT vec_id, p, x, min(({d}, e)) AS m FROM parts JOIN book{r} USING (p) GROUP BY ALL"
    distance = "CAST(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS BIGINT)"
    steps = []
    for r in (0, 1):
        steps.append(f"near{r} AS MATERIALIZED ({near.format(d=distance, r=r)})")
        steps.append(
            f"""book{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.c, b.c) AS c FROM book{r} b LEFT JOIN (
                SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
                    SELECT p, m[2] AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM near{r}, range(1, 1 + (SELECT max(len(x)) FROM parts)) t(i) GROUP BY ALL) GROUP BY ALL) n USING (p, e))"""
        )
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, range(16) t(p)),
        seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY row_number() OVER (ORDER BY vec_id) <= 64),
        book0 AS MATERIALIZED (SELECT p, e, x AS c FROM parts JOIN seeds USING (vec_id)),
        {", ".join(steps)}, final AS MATERIALIZED ({near.format(d=distance, r=2)}),
        coded AS (SELECT vec_id, string_agg(printf('%02x', m[2]), '' ORDER BY p) AS code, CAST(sum(m[1]) AS BIGINT) AS error FROM final GROUP BY 1),
        books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM book2)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM coded JOIN kept USING (vec_id), books
    """


ORACLE_SQL = {
    "op4_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words
        ), tokens AS (SELECT doc_id, unnest(s) AS t FROM sets),
        shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM tokens x JOIN tokens y ON x.t = y.t AND x.doc_id < y.doc_id GROUP BY ALL),
        sizes AS (SELECT doc_id, len(s) AS n FROM sets),
        links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * common >= 75 * (p.n + q.n - common)),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT doc_id AS node, doc_id AS seen FROM sizes UNION SELECT node, b FROM reach JOIN both_ways ON a = seen)
        SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, (SELECT min(seen) FROM reach WHERE node = doc_id) AS component_id FROM sizes
    """,
    "op6_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
    """,
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM m
    """,
}
ORACLE_SQL["op11_vector_codes"] = _sql_vector_codes()
ORACLE_SQL["op12_source_divergence"] = r"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    w AS MATERIALIZED (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    kept AS MATERIALIZED (SELECT lang, term, count(*) AS c FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10),
    v AS (SELECT lang, count(*) AS kinds, sum(c) AS n FROM kept GROUP BY 1),
    found AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    g AS (SELECT o.lang, o.source, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) o LEFT JOIN found f ON f.lang = o.lang AND f.source = o.source GROUP BY ALL),
    p AS MATERIALIZED (
        SELECT g.lang, g.source, k.term, coalesce(f.c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(f.c, 0) + 2) // (g.n + 2 * kinds) AS p, 1 + 1000000000::HUGEINT * (k.c + 2) // (v.n + 2 * kinds) AS q
        FROM g JOIN v ON v.lang = g.lang JOIN kept k ON k.lang = g.lang LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term
    ),
    pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    every AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(pair.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
        UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p WHERE c > 0 AND p > q
    )
    SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every
    QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 10
"""
