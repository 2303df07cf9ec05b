"""Queries on annotations: three readers label every document's language with a confidence.

``reader`` gives the true language, ``voter`` the stop-word vote, and ``careful`` the vote where it
is clear and else 'en'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.operators import agreement, metrics
from corpusgauge.plans import views
from corpusgauge.plans.registry import query
from corpusgauge.plans.views import LABELS, PREDS_SQL

NOTES_SQL = f"""{PREDS_SQL}, notes AS (
  SELECT question_id, 'reader' AS annotator_id, true_label AS intent_label, 3 AS confidence FROM preds
  UNION ALL SELECT question_id, 'voter', predicted_label,
    CASE WHEN confidence >= 0.9 THEN 3 WHEN confidence >= 0.5 THEN 2 ELSE 1 END FROM preds
  UNION ALL SELECT question_id, 'careful', CASE WHEN confidence >= 0.8 THEN predicted_label ELSE 'en' END, 2 FROM preds
)"""


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sure = F.col("confidence")
    level = F.when(sure >= 0.9, 3).when(sure >= 0.5, 2).otherwise(1)
    names = ["annotator_id", "intent_label", "level"]

    def note(*cells) -> F.Column:
        return F.struct(*[cell.alias(name) for cell, name in zip(cells, names)])

    careful = F.when(sure >= 0.8, F.col("predicted_label")).otherwise("en")
    own = F.array(
        note(F.lit("reader"), F.col("true_label"), F.lit(3)),
        note(F.lit("voter"), F.col("predicted_label"), level),
        note(F.lit("careful"), careful, F.lit(2)),
    )
    return views.preds(spark, sf_dir).select("question_id", F.inline(own)).withColumnRenamed("level", "confidence")


@query(
    "annotator_agreement",
    f"""WITH {NOTES_SQL}, cells AS (
      SELECT x.annotator_id AS a, y.annotator_id AS b, x.intent_label AS l, y.intent_label AS r, COUNT(*) AS n
      FROM notes x JOIN notes y ON x.question_id = y.question_id AND x.annotator_id < y.annotator_id GROUP BY ALL
    ), totals AS (
      SELECT a, b, CAST(SUM(n) AS BIGINT) AS items, SUM(CASE WHEN l = r THEN n ELSE 0 END) / CAST(SUM(n) AS DOUBLE) AS po
      FROM cells GROUP BY a, b
    ), chance AS (
      SELECT a, b, SUM(x.n * y.n) AS products
      FROM (SELECT a, b, l AS label, SUM(n) AS n FROM cells GROUP BY ALL) x
      JOIN (SELECT a, b, r AS label, SUM(n) AS n FROM cells GROUP BY ALL) y USING (a, b, label) GROUP BY a, b
    ), both_shares AS (
      SELECT a, b, items, po, coalesce(products, 0) / (CAST(items AS DOUBLE) * items) AS pe FROM totals LEFT JOIN chance USING (a, b))
    SELECT a AS first_annotator, b AS second_annotator, items, ROUND(po, 6) AS raw_agreement,
           CASE WHEN pe < 1 THEN ROUND((po - pe) / (1 - pe), 6) END AS kappa FROM both_shares""",
)
def annotator_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = agreement.agreement(notes(spark, sf_dir))
    return found.withColumns({name: F.round(name, 6) for name in ("raw_agreement", "kappa")})


@query(
    "intents_by_subject",
    f"""WITH {NOTES_SQL} SELECT true_label AS subject, intent_label, COUNT(*) AS n,
      ROUND(COUNT(*) / CAST(SUM(COUNT(*)) OVER (PARTITION BY true_label) AS DOUBLE), 6) AS share
    FROM notes JOIN preds USING (question_id) GROUP BY true_label, intent_label""",
)
def intents_by_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = views.preds(spark, sf_dir).select("question_id", F.col("true_label").alias("category"))
    return agreement.intents_by_subject(notes(spark, sf_dir), questions).withColumn("share", F.round("share", 6))


@query(
    "disputed_annotations",
    f"""WITH {NOTES_SQL}, held AS (
      SELECT question_id, COUNT(DISTINCT intent_label) AS labels, CAST(MIN(confidence) AS INTEGER) AS least_confidence
      FROM notes GROUP BY question_id)
    SELECT *, CASE WHEN labels > 1 AND least_confidence <= 1 THEN 'both' WHEN labels > 1 THEN 'disagreement'
      ELSE 'low_confidence' END AS reason FROM held WHERE labels > 1 OR least_confidence <= 1""",
)
def disputed_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agreement.disputed(notes(spark, sf_dir))


@query(
    "routing_gate",
    f"""WITH {NOTES_SQL}, judged AS (
      SELECT annotator_id, true_label, intent_label AS p FROM notes JOIN preds USING (question_id)
    ), sides AS (
      SELECT annotator_id, true_label AS l, 1 AS weight, 1 AS support, CASE WHEN true_label = p THEN 1 ELSE 0 END AS hits FROM judged
      UNION ALL SELECT annotator_id, p, 1, 0, 0 FROM judged
    ), classes AS (
      SELECT annotator_id, l, 2 * SUM(hits) / CAST(SUM(weight) AS DOUBLE) AS f1,
             CASE WHEN SUM(support) > 0 THEN SUM(hits) / CAST(SUM(support) AS DOUBLE) ELSE 0 END AS recall
      FROM sides GROUP BY ALL
    ), scores AS (SELECT annotator_id, AVG(f1) AS f, MIN(recall) AS r FROM classes GROUP BY annotator_id)
    SELECT annotator_id, ROUND(f, 6) AS macro_f1, ROUND(r, 6) AS least_recall,
           CASE WHEN f < 0.65 THEN 'red' WHEN f >= 0.8 AND r >= 0.7 THEN 'green' ELSE 'yellow' END AS gate FROM scores""",
)
def routing_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate for each annotator taken as a classifier of the true language."""
    truth = views.preds(spark, sf_dir).select("question_id", "true_label")
    judged = notes(spark, sf_dir).join(truth, "question_id").withColumnRenamed("intent_label", "predicted_label")
    counts = metrics.pair_counts(judged, by=["annotator_id"])
    summary = metrics.summary_metrics(counts, LABELS, ["annotator_id"])
    classes = metrics.per_class_metrics(counts, LABELS, ["annotator_id"])
    gated = agreement.gate(summary, classes, ("annotator_id",))
    return gated.withColumns({name: F.round(name, 6) for name in ("macro_f1", "least_recall")})
