"""The queries over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import alignment, chat, context_tree, decontamination, exact_dedup, html_text, minhash, packing, sharding, simhash, toxicity, vafile, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxic_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learnt from the labels that are not held out."""
    return toxicity.train(docs, labels.where(~toxicity.held_out("doc_id", 4, 2)), "toxic")


@_query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxic_model(docs, _table(spark, sf_dir, "labels")))
    return found.select("doc_id", toxicity.held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")


@_query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


ORACLE["op3_exact_dedup"] = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
           FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM t JOIN g USING (body)
"""


@_query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


@_query
def op8_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = toxicity.held_out("doc_id", 10, 0)
    found = context_tree.score(docs, docs.where(~out))
    return found.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@_query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(_table(spark, sf_dir, "documents"))


@_query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages"))


ORACLE["op4_warc"] = """
WITH t AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
g AS (SELECT body, min(page_id) AS first_id FROM t GROUP BY body)
SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha256(body) AS payload_digest,
       CASE WHEN octet_length(encode(body)) >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(encode(body)) >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM t JOIN g USING (body)
"""


@_query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.train(pages))


@_query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.of_conversations(_table(spark, sf_dir, "conversations"))


ORACLE["op6_chat_format"] = """
WITH c AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE role = 'user' AND conv_id IS NOT NULL AND turn IS NOT NULL),
i AS (SELECT *, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island FROM c),
d AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) - 1 AS depth FROM i),
a AS (SELECT DISTINCT conv_id, turn - 1 AS turn, 1 AS has FROM conversations WHERE role = 'assistant')
SELECT t.conv_id, t.turn, 'call' AS role, 'c' || t.conv_id || '-' || t.turn AS call_id,
       CASE WHEN a.has = 1 THEN 'linked' ELSE 'unanswered' END AS status, 2 * d.depth AS step,
       CASE WHEN t.text IS NULL THEN 'missing prompt' ELSE '' END AS errors,
       json_object('arguments', json_object('prompt', t.text, 'turn', t.turn), 'id', 'c' || t.conv_id || '-' || t.turn,
                   'name', 'respond', 'role', 'call')::VARCHAR AS message
FROM conversations t JOIN d USING (conv_id, turn) LEFT JOIN a USING (conv_id, turn) WHERE t.role = 'user'
UNION ALL
SELECT t.conv_id, t.turn, 'result', 'c' || t.conv_id || '-' || (t.turn - 1), CASE WHEN d.depth IS NULL THEN 'orphan' ELSE 'linked' END,
       2 * d.depth + 1, '', json_object('content', t.text, 'id', 'c' || t.conv_id || '-' || (t.turn - 1), 'role', 'result')::VARCHAR
FROM conversations t LEFT JOIN d ON d.conv_id = t.conv_id AND d.turn = t.turn - 1 WHERE t.role = 'assistant'
UNION ALL
SELECT conv_id, turn, role, NULL, 'plain', -1, '', json_object('content', text, 'role', role)::VARCHAR
FROM conversations WHERE role NOT IN ('user', 'assistant')
"""


@_query
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op12_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.clusters(_table(spark, sf_dir, "embeddings")).drop("looked_at")


def _lloyd_sql(k: int, dims: int, rounds: int, scale: int, seed: str) -> str:
    """The same clustering with every distance worked out."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS MATERIALIZED (SELECT row, k, sum((x - c) * (x - c)) AS distance FROM v JOIN c{r} USING (i) GROUP BY row, k),
a{r} AS MATERIALIZED (SELECT row, k, distance FROM d{r} QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, k) = 1)""")
        if r < rounds:
            steps.append(f"""m{r} AS MATERIALIZED (SELECT k, i, sum(x)::BIGINT AS s, count(*) AS n FROM v JOIN a{r} USING (row) GROUP BY k, i),
c{r + 1} AS MATERIALIZED (SELECT k, i, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c FROM c{r} LEFT JOIN m{r} USING (k, i))""")
    return f"""
WITH g AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT row, i, e[i] AS x FROM g, range(1, {dims + 1}) AS r(i)),
s AS (SELECT e, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), e) - 1 AS k FROM g WHERE vec_id IS NOT NULL QUALIFY k < {k}),
c0 AS MATERIALIZED (SELECT k, i, e[i] AS c FROM s, range(1, {dims + 1}) AS r(i)),
{','.join(steps)},
h AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k),
w AS (SELECT vec_id, k::INTEGER AS cluster, distance::BIGINT AS distance, centroid_sha256 FROM a{rounds} JOIN h USING (k) JOIN g USING (row))
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
       centroid_sha256 FROM w
"""


ORACLE["op12_vafile"] = _lloyd_sql(40, 64, 5, 256, "2")


@_query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"))
