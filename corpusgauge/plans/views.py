"""The three views the queries run on, for Spark and as SQL text.

* ``src``: the documents with their language as label;
* ``dirty``: ``src`` with faults of every kind planted by row number;
* ``preds``: a stop-word vote as a classifier that needs no training.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.sources.tables import read_parquet

# Label order and the voting words of the four languages.
LABELS = ["en", "fr", "de", "es"]
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "with"],
    "fr": ["le", "la", "les", "des", "une"],
    "de": ["der", "die", "und", "das", "ist"],
    "es": ["el", "los", "que", "una", "por"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def src(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("question_id"),
        F.col("text").alias("question"),
        F.col("lang").alias("category"),
        F.col("source").alias("src"),
    )


SRC_SQL = """src AS (
  SELECT doc_id AS question_id, text AS question, lang AS category, source AS src FROM documents
)"""


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        doc.alias("row_key"),
        F.when(doc % 47 == 0, doc - 1).otherwise(doc).alias("question_id"),
        F.when(doc % 86 == 0, F.lit("   ")).when(doc % 43 == 0, F.lit(" \t ")).otherwise(F.col("text")).alias("question"),
        F.when(doc % 37 == 0, F.lit("xx")).otherwise(F.col("lang")).alias("category"),
        F.when(doc % 41 == 0, F.lit("  ")).otherwise(F.col("source")).alias("src"),
    )


DIRTY_SQL = """dirty AS (
  SELECT doc_id AS row_key,
         CASE WHEN doc_id % 47 = 0 THEN doc_id - 1 ELSE doc_id END AS question_id,
         CASE WHEN doc_id % 86 = 0 THEN '   ' WHEN doc_id % 43 = 0 THEN ' \t ' ELSE text END AS question,
         CASE WHEN doc_id % 37 = 0 THEN 'xx' ELSE lang END AS category,
         CASE WHEN doc_id % 41 = 0 THEN '  ' ELSE source END AS src
  FROM documents
)"""


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A controlled table whose groups are the exact copies, split by the group number."""
    documents = table(spark, sf_dir, "documents")
    first = documents.groupBy(F.sha2("text", 256).alias("_key")).agg(
        F.min("doc_id").alias("duplicate_group_id")
    )
    return (
        documents.withColumn("_key", F.sha2("text", 256))
        .join(first, "_key")
        .select(
            F.col("doc_id").alias("question_id"),
            F.col("text").alias("question_text"),
            F.col("lang").alias("category"),
            F.col("source").alias("src"),
            F.length("text").cast("bigint").alias("text_length"),
            "duplicate_group_id",
            F.when(F.col("duplicate_group_id") % 7 == 0, "test").otherwise("development").alias("split_name"),
        )
    )


QUESTIONS_SQL = """questions AS (
  SELECT doc_id AS question_id, text AS question_text, lang AS category, source AS src,
         CAST(length(text) AS BIGINT) AS text_length,
         MIN(doc_id) OVER (PARTITION BY text) AS duplicate_group_id,
         CASE WHEN MIN(doc_id) OVER (PARTITION BY text) % 7 = 0 THEN 'test' ELSE 'development' END AS split_name
  FROM documents
)"""


def _votes(label: str) -> Column:
    return F.size(F.filter("hits", lambda word: word.isin(STOP_WORDS[label]))).cast("bigint")


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = [word for label in LABELS for word in STOP_WORDS[label]]
    hits = F.filter(F.split(F.lower("text"), "[ \t\r\n]+"), lambda w: w.isin(every))
    voted = table(spark, sf_dir, "documents").select("*", hits.alias("hits"))
    voted = voted.withColumns({f"v_{label}": _votes(label) for label in LABELS})
    votes = [F.col(f"v_{label}") for label in LABELS]
    best = F.greatest(*votes)
    predicted = F.lit("es")
    for label in reversed(LABELS[:-1]):
        predicted = F.when(F.col(f"v_{label}") == best, label).otherwise(predicted)
    second = F.element_at(F.sort_array(F.array(*votes)), -2)
    total = F.size("hits").cast("bigint")
    return voted.select(
        F.col("doc_id").alias("question_id"),
        F.col("doc_id").alias("source_question_id"),
        F.col("lang").alias("true_label"),
        predicted.alias("predicted_label"),
        F.try_divide(best.cast("double"), total.cast("double")).alias("confidence"),
        (best - second).cast("double").alias("decision_score"),
        (F.col("lang") == predicted).cast("bigint").alias("is_correct"),
        F.col("source").alias("source_name"),
        F.length("text").cast("bigint").alias("text_length"),
        F.col("text").alias("question_text"),
    )


def _words(label: str) -> str:
    return ", ".join(f"'{word}'" for word in STOP_WORDS[label])


PREDS_SQL = f"""split_words AS (
  SELECT *, string_split_regex(lower(text), '[ \\t\\r\\n]+') AS w FROM documents
), votes AS (
  SELECT *, {", ".join(
      f"CAST(len(list_filter(w, lambda x: x IN ({_words(label)}))) AS BIGINT) AS v_{label}" for label in LABELS)}
  FROM split_words
), tallied AS (
  SELECT *, greatest(v_en, v_fr, v_de, v_es) AS best, v_en + v_fr + v_de + v_es AS total,
         list_sort([v_en, v_fr, v_de, v_es])[3] AS runner_up
  FROM votes
), preds AS (
  SELECT doc_id AS question_id, doc_id AS source_question_id, lang AS true_label,
         CASE WHEN v_en = best THEN 'en' WHEN v_fr = best THEN 'fr' WHEN v_de = best THEN 'de' ELSE 'es' END
           AS predicted_label,
         CASE WHEN total > 0 THEN CAST(best AS DOUBLE) / CAST(total AS DOUBLE) END AS confidence,
         CAST(best - runner_up AS DOUBLE) AS decision_score,
         CAST(lang = CASE WHEN v_en = best THEN 'en' WHEN v_fr = best THEN 'fr' WHEN v_de = best THEN 'de'
              ELSE 'es' END AS BIGINT) AS is_correct,
         source AS source_name, CAST(length(text) AS BIGINT) AS text_length, text AS question_text
  FROM tallied
)"""
