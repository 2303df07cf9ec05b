"""Registered queries of the training-data operators, with SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.durable import Steps
from corpusgauge.llm import (
    bound_batches,
    bpe_stream,
    exact_dedup,
    fim,
    fingerprints,
    language_id,
    lm,
    near_dedup,
    packing,
    pieces,
    secrets,
    token_counts,
    vector_codes,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


OP6_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), r AS (
  SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, max(page_id) OVER (PARTITION BY body) AS keep_id,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((CAST('0x' || substr(hex, CAST(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT) >> CAST(5 * (7 - i % 8) AS BIGINT)) & 31 AS BIGINT) + 1,
           1)), '') AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = keep_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep_id THEN keep_id END AS refers_to
FROM r
"""


@query("op6_warc", OP6_SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages into a content-addressed archive, and the archive read back."""
    steps = Steps(spark)
    archive = warc.write_archive(table(spark, sf_dir, "pages"), steps)
    records = warc.read_archive(archive, steps)
    return records.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), k AS (
  SELECT doc_id, text_sha256, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""


@query("op7_exact_dedup", OP7_SQL)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents through the digest index."""
    return exact_dedup.deduplicate_once(table(spark, sf_dir, "documents"))


@query("op4_bpe_stream")
def op4_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the streaming transducer and decoded again."""
    return bpe_stream.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document with the whole-token shortcut."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_secrets")
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents")))


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by frozen context trees."""
    return language_id.identify(table(spark, sf_dir, "documents"))


@query("op9_fingerprints")
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrase fingerprints of every document, its edited text and its successor."""
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words
), sizes AS MATERIALIZED (
  SELECT doc_id, COUNT(s) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), edges AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges
), reach(id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.id, e.b FROM reach r JOIN both_ways e ON r.other = e.a
), least AS (SELECT id, MIN(other) AS component_id FROM reach GROUP BY id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN least ON id = doc_id
"""


@query("op3_near_dedup", OP3_SQL)
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near duplicates among all documents: three-word shingles, likeness 0.85."""
    grouped = near_dedup.group(table(spark, sf_dir, "documents"), words=3, percent=85)
    return grouped.select("doc_id", "n_shingles", "component_id", "kept")


@query("op5_lm_scores")
def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents under a model of the training documents."""
    return lm.score_documents(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), k AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d
), c AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS lo, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS hi,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM k
), p AS (
  SELECT *, array_to_string(u[1:lo], '') AS a, array_to_string(u[lo + 1:hi], '') AS b, array_to_string(u[hi + 1:n], '') AS e FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(b) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || e || '<P>' || a || '<M>' || b
              ELSE '<P>' || a || '<S>' || e || '<M>' || b END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


@query("op13_fill_in_middle", OP13_SQL)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two tokens and put in another order, and the text restored from that."""
    return fim.report(fim.fill_in_middle(table(spark, sf_dir, "documents")))


def _op12_sql() -> str:
    """Four rounds and the last assignment, one table each."""
    distance = "list_dot_product(q, q) - 2 * list_dot_product(q, b) + list_dot_product(b, b)"
    text = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS q FROM kept, (SELECT unnest(range(4)) AS p)
), book0 AS MATERIALIZED (SELECT p, r - 1 AS e, q AS b FROM parts WHERE r <= 256)"""
    for at in range(5):
        text += f""", nearest{at} AS MATERIALIZED (
  SELECT r, p, any_value(q) AS q, arg_min(e, d * 256 + e) AS e, min(d) AS d
  FROM (SELECT r, p, q, e, {distance} AS d FROM parts JOIN book{at} USING (p)) GROUP BY r, p
)"""
        if at < 4:
            text += f""", mean{at} AS (
  SELECT p, e, list(m ORDER BY i) AS b FROM (
    SELECT p, e, i, floor(sum(x) / count(*)) AS m
    FROM (SELECT p, e, unnest(q) AS x, unnest(range(len(q))) AS i FROM nearest{at}) GROUP BY p, e, i
  ) GROUP BY p, e
), book{at + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(n.b, o.b) AS b FROM book{at} o LEFT JOIN mean{at} n USING (p, e)
)"""
    return text + """, coded AS (
  SELECT r, string_agg(printf('%02x', CAST(e AS BIGINT)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM nearest4 GROUP BY r
), digest AS (
  SELECT sha256(string_agg(array_to_string(list_transform(b, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, e))
    AS codebooks_sha256 FROM book4
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""


@query("op12_vector_codes", _op12_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings coded in four parts of 256 entries, after four rounds of fitting."""
    steps = Steps(spark)
    return vector_codes.report(vector_codes.compress(table(spark, sf_dir, "embeddings"), steps=steps), steps)


@query("op11_piece_spans")
def op11_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to pieces with their byte spans, and decoded again."""
    return pieces.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
