"""Queries over the predictions of a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.durable import materialize
from corpusgauge.operators import diagnose, metrics, reports, split, validate
from corpusgauge.plans import views
from corpusgauge.plans.curation import FOLDS_SQL, LABEL_ORDER_SQL, scratch
from corpusgauge.plans.registry import query
from corpusgauge.plans.views import LABELS, PREDS_SQL
from corpusgauge.sources import tables
from corpusgauge.sources.runs import RunStore

ERRORS_SQL = """COUNT(*) AS n, CAST(SUM(1 - is_correct) AS BIGINT) AS error_count,
  ROUND(CAST(SUM(1 - is_correct) AS DOUBLE) / COUNT(*), 4) AS error_rate"""
LENGTH_SQL = """CASE WHEN text_length < 100 THEN '<100' WHEN text_length < 200 THEN '100-199'
  WHEN text_length < 400 THEN '200-399' ELSE '400+' END"""


def sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.src(spark, sf_dir).withColumn("text_length", F.length("question").cast("bigint"))


def narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions as they are stored, without the columns of the questions table."""
    return views.preds(spark, sf_dir).select(
        "question_id", "true_label", "predicted_label", "confidence", "decision_score", "is_correct"
    )


@query("errors_by_class", f"WITH {PREDS_SQL} SELECT true_label AS subject, {ERRORS_SQL} FROM preds GROUP BY true_label")
def errors_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.errors_by_class(views.preds(spark, sf_dir))


@query("errors_by_source", f"WITH {PREDS_SQL} SELECT source_name, {ERRORS_SQL} FROM preds GROUP BY source_name")
def errors_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.errors_by_source(narrow(spark, sf_dir), views.src(spark, sf_dir))


@query(
    "confusion_pairs",
    f"""WITH {PREDS_SQL} SELECT true_label, predicted_label, COUNT(*) AS confusion_count
    FROM preds WHERE is_correct = 0 GROUP BY true_label, predicted_label""",
)
def confusion_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.confusion_pairs(views.preds(spark, sf_dir))


@query("errors_by_length", f"WITH {PREDS_SQL} SELECT {LENGTH_SQL} AS length_band, {ERRORS_SQL} FROM preds GROUP BY 1")
def errors_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.errors_by_length(narrow(spark, sf_dir), sized(spark, sf_dir))


@query(
    "accuracy_by_confidence",
    f"""WITH {PREDS_SQL} SELECT CASE WHEN confidence < 0.5 THEN '[0.0,0.5)' WHEN confidence < 0.6 THEN '[0.5,0.6)'
      WHEN confidence < 0.7 THEN '[0.6,0.7)' WHEN confidence < 0.8 THEN '[0.7,0.8)'
      WHEN confidence < 0.9 THEN '[0.8,0.9)' ELSE '[0.9,1.0]' END AS confidence_band,
      COUNT(*) AS n, ROUND(AVG(is_correct), 4) AS accuracy
    FROM preds WHERE confidence IS NOT NULL GROUP BY 1""",
)
def accuracy_by_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.accuracy_by_confidence(views.preds(spark, sf_dir))


@query(
    "error_slices",
    f"""WITH {PREDS_SQL}, parts AS (
      SELECT 'subject' AS slice_type, true_label AS slice_value, is_correct FROM preds
      UNION ALL SELECT 'source', source_name, is_correct FROM preds
      UNION ALL SELECT 'length_band', {LENGTH_SQL}, is_correct FROM preds
      UNION ALL SELECT 'length_band', b, NULL FROM (VALUES ('<100'), ('100-199'), ('200-399'), ('400+')) v(b)
    ), counted AS (
      SELECT slice_type, slice_value, COUNT(is_correct) AS n,
             CAST(coalesce(SUM(is_correct), 0) AS BIGINT) AS correct
      FROM parts GROUP BY slice_type, slice_value)
    SELECT *, n - correct AS errors,
           ROUND(CASE WHEN n > 0 THEN correct / CAST(n AS DOUBLE) END, 6) AS accuracy,
           ROUND(CASE WHEN n > 0 THEN (n - correct) / CAST(n AS DOUBLE) END, 6) AS error_rate
    FROM counted""",
)
def error_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = diagnose.error_slices(views.preds(spark, sf_dir))
    return slices.withColumns({c: F.round(c, 6) for c in ("accuracy", "error_rate")})


@query(
    "confusion_matrix",
    f"""WITH {PREDS_SQL} SELECT l AS true_label,
      {", ".join(f"COUNT(*) FILTER (predicted_label = '{label}') AS {label}" for label in LABELS)}
    FROM (VALUES ('en'), ('fr'), ('de'), ('es')) v(l) LEFT JOIN preds ON true_label = l GROUP BY l""",
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(views.preds(spark, sf_dir), LABELS)


CLASS_SQL = """classes AS (
  SELECT l AS subject,
         (SELECT COUNT(*) FROM preds WHERE true_label = l) AS support,
         (SELECT COUNT(*) FROM preds WHERE predicted_label = l) AS claimed,
         (SELECT COUNT(*) FROM preds WHERE predicted_label = l AND true_label = l) AS hits
  FROM (VALUES ('en'), ('fr'), ('de'), ('es')) v(l)
), per_class AS (
  SELECT subject, support,
         CASE WHEN claimed > 0 THEN hits / CAST(claimed AS DOUBLE) ELSE 0 END AS precision,
         CASE WHEN support > 0 THEN hits / CAST(support AS DOUBLE) ELSE 0 END AS recall,
         CASE WHEN support + claimed > 0 THEN 2 * hits / CAST(support + claimed AS DOUBLE) ELSE 0 END AS f1
  FROM classes
), summary AS (
  SELECT (SELECT COUNT(*) FROM preds) AS n, (SELECT CAST(SUM(is_correct) AS BIGINT) FROM preds) AS correct,
         AVG(f1) AS macro_f1, SUM(f1 * support) / SUM(support) AS weighted_f1
  FROM per_class
)"""


@query(
    "per_class_metrics",
    f"""WITH {PREDS_SQL}, {CLASS_SQL} SELECT subject, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall,
      ROUND(f1, 6) AS f1, support FROM per_class""",
)
def per_class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = metrics.pair_counts(views.preds(spark, sf_dir))
    table = metrics.per_class_metrics(counts, LABELS)
    return table.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "summary_metrics",
    f"""WITH {PREDS_SQL}, {CLASS_SQL} SELECT n, correct, ROUND(correct / CAST(n AS DOUBLE), 6) AS accuracy,
      ROUND(macro_f1, 6) AS macro_f1, ROUND(weighted_f1, 6) AS weighted_f1 FROM summary""",
)
def summary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = metrics.summary_metrics(metrics.pair_counts(views.preds(spark, sf_dir)), LABELS)
    return table.withColumns({c: F.round(c, 6) for c in ("accuracy", "macro_f1", "weighted_f1")})


@query(
    "metric_scores_long",
    f"""WITH {PREDS_SQL}, {CLASS_SQL}
    SELECT subject, support, 'precision' AS metric, ROUND(precision, 6) AS score FROM per_class
    UNION ALL SELECT subject, support, 'recall', ROUND(recall, 6) FROM per_class
    UNION ALL SELECT subject, support, 'f1', ROUND(f1, 6) FROM per_class""",
)
def metric_scores_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = metrics.pair_counts(views.preds(spark, sf_dir))
    long = metrics.unpivot_metrics(metrics.per_class_metrics(counts, LABELS))
    return long.withColumn("score", F.round("score", 6))


FOLD_F1_SQL = f"""{PREDS_SQL}, placed AS (SELECT *, question_id % 5 AS fold FROM preds
), sides AS (
  SELECT fold, true_label AS l, 1 AS support, CAST(is_correct AS INTEGER) AS hits, 0 AS claimed FROM placed
  UNION ALL SELECT fold, predicted_label, 0, 0, 1 FROM placed
), class_f1 AS (
  SELECT fold, l, 2 * SUM(hits) / CAST(SUM(support) + SUM(claimed) AS DOUBLE) AS f1 FROM sides GROUP BY fold, l
), fold_f1 AS (SELECT fold, AVG(f1) AS macro_f1 FROM class_f1 GROUP BY fold)"""


@query(
    "fold_statistics",
    f"""WITH {FOLD_F1_SQL} SELECT 'stop_words' AS model_name, ROUND(AVG(macro_f1), 6) AS macro_f1_mean,
      ROUND(stddev_pop(macro_f1), 6) AS macro_f1_std, COUNT(*) AS folds FROM fold_f1""",
)
def fold_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = views.preds(spark, sf_dir).withColumn("fold", F.col("question_id") % 5)
    scores = metrics.summary_metrics(metrics.pair_counts(placed, by=["fold"]), None, ["fold"])
    named = scores.withColumn("model_name", F.lit("stop_words"))
    table = metrics.fold_statistics(named, ["model_name"])
    return table.withColumns({c: F.round(c, 6) for c in ("macro_f1_mean", "macro_f1_std")})


@query(
    "majority_baseline",
    f"""WITH {FOLDS_SQL.format(k=5)}, placed AS (
      SELECT fold, category FROM questions JOIN folds USING (duplicate_group_id)
    ), grid AS (
      SELECT f.fold, l.category, (SELECT COUNT(*) FROM placed p WHERE p.fold <> f.fold AND p.category = l.category) AS outside
      FROM (SELECT DISTINCT fold FROM placed) f, (SELECT DISTINCT category FROM placed) l
    ), choice AS (
      SELECT fold, category AS predicted_label FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY fold ORDER BY outside DESC, category) AS turn FROM grid) WHERE turn = 1
    ), scored AS (
      SELECT c.fold, c.predicted_label, COUNT(*) AS n, COUNT(DISTINCT p.category) AS kinds,
             COUNT(*) FILTER (p.category = c.predicted_label) AS hits
      FROM choice c JOIN placed p USING (fold) GROUP BY ALL)
    SELECT fold, predicted_label,
           ROUND(2 * hits / CAST(hits + n AS DOUBLE) / (kinds + CASE WHEN hits = 0 THEN 1 ELSE 0 END), 6) AS macro_f1
    FROM scored""",
)
def majority_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.questions(spark, sf_dir).select("question_id", "category", "duplicate_group_id")
    folded = split.assign_folds(rows, LABELS, 5)
    return metrics.majority_baseline(folded, 5).withColumn("macro_f1", F.round("macro_f1", 6))


BOOTSTRAP_SQL = f"""WITH {PREDS_SQL}, members AS (
  SELECT true_label, predicted_label,
         ROW_NUMBER() OVER (PARTITION BY true_label
           ORDER BY {LABEL_ORDER_SQL.replace("category", "predicted_label")}) AS place,
         ROW_NUMBER() OVER (PARTITION BY true_label ORDER BY question_id) - 1 AS draw,
         COUNT(*) OVER (PARTITION BY true_label) AS size
  FROM preds
), draws AS (
  SELECT b.iteration, m.true_label,
         1 + CAST('0x' || substr(md5('42:' || b.iteration || ':' || m.true_label || ':' || m.draw), 1, 8) AS BIGINT) % m.size
           AS pick
  FROM members m, range(2000) b(iteration)
), drawn AS (
  SELECT iteration, true_label, m.predicted_label FROM draws JOIN members m USING (true_label) WHERE m.place = pick
), sides AS (
  SELECT iteration, true_label AS l, COUNT(*) AS weight, COUNT(*) FILTER (true_label = predicted_label) AS hits
  FROM drawn GROUP BY 1, 2
  UNION ALL SELECT iteration, predicted_label, COUNT(*), 0 FROM drawn GROUP BY 1, 2
), scores AS (
  SELECT iteration, SUM(f1) / 4 AS macro_f1
  FROM (SELECT iteration, l, 2 * SUM(hits) / CAST(SUM(weight) AS DOUBLE) AS f1 FROM sides GROUP BY 1, 2) GROUP BY 1)
SELECT ROUND(quantile_cont(macro_f1, 0.025), 6) AS lower, ROUND(quantile_cont(macro_f1, 0.975), 6) AS upper,
       CAST(2000 AS BIGINT) AS iterations
FROM scores"""


@query("bootstrap_by_draws", BOOTSTRAP_SQL)
def bootstrap_by_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = metrics.bootstrap_by_draws(views.preds(spark, sf_dir), LABELS, 2000)
    return table.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


@query("bootstrap_by_counts")
def bootstrap_by_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.bootstrap_by_counts(views.preds(spark, sf_dir), LABELS, 2000)


COVERAGE_SQL = f"""WITH {PREDS_SQL}
SELECT t AS threshold, COUNT(*) FILTER (confidence >= t) AS automated_count,
       ROUND(COUNT(*) FILTER (confidence >= t) / CAST(COUNT(*) AS DOUBLE), 6) AS automated_coverage,
       COUNT(*) - COUNT(*) FILTER (confidence >= t) AS manual_review_volume,
       ROUND(AVG(is_correct) FILTER (confidence >= t), 6) AS automated_accuracy, 'available' AS status
FROM preds, (VALUES (0.0::DOUBLE), (0.5), (0.6), (0.7), (0.8), (0.9), (0.95)) v(t) GROUP BY t"""


@query("coverage_curve", COVERAGE_SQL)
def coverage_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = diagnose.coverage_curve(views.preds(spark, sf_dir))
    return curve.withColumns({c: F.round(c, 6) for c in ("automated_coverage", "automated_accuracy")})


@query(
    "coverage_without_confidence",
    """SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS BIGINT) AS automated_count,
         CAST(0 AS DOUBLE) AS automated_coverage, COUNT(*) AS manual_review_volume,
         CAST(NULL AS DOUBLE) AS automated_accuracy,
         'not_available_locked_model_has_no_calibrated_probability' AS status FROM documents""",
)
def coverage_without_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    margins = views.preds(spark, sf_dir).withColumn("confidence", F.lit(None).cast("double"))
    return diagnose.coverage_curve(margins)


@query(
    "representative_cases",
    f"""WITH {PREDS_SQL}, scored AS (
      SELECT *, CASE WHEN is_correct = 0 THEN confidence ELSE -confidence END AS score,
             CASE WHEN is_correct = 0 THEN 'incorrect' ELSE 'correct' END AS outcome FROM preds
    ), turns AS (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY outcome, true_label ORDER BY score NULLS LAST, question_id) AS turn
      FROM scored
    ), placed AS (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY outcome ORDER BY turn, true_label) AS place FROM turns)
    SELECT outcome, source_question_id, true_label, predicted_label, source_name, text_length,
           ROUND(confidence, 6) AS confidence, decision_score, substr(question_text, 1, 240) AS question_excerpt
    FROM placed WHERE place <= 5""",
)
def representative_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = diagnose.representative_cases(views.preds(spark, sf_dir))
    return cases.withColumn("confidence", F.round("confidence", 6))


@query(
    "enriched_predictions",
    f"""WITH {PREDS_SQL} SELECT source_question_id, predicted_label, md5(question_text) AS text_md5 FROM preds""",
)
def enriched_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = narrow(spark, sf_dir).withColumnRenamed("question_id", "source_question_id")
    enriched = validate.enrich_one_to_one(stored, views.src(spark, sf_dir), ["question"])
    return enriched.select("source_question_id", "predicted_label", F.md5("question").alias("text_md5"))


@query(
    "headline_metrics",
    f"""WITH {PREDS_SQL}, {CLASS_SQL}
    SELECT 'strongest_class' AS name, upper(s[1:1]) || s[2:] AS text, ROUND(f, 6) AS value
      FROM (SELECT subject AS s, f1 AS f FROM per_class ORDER BY f1 DESC, subject LIMIT 1)
    UNION ALL SELECT 'weakest_class', upper(s[1:1]) || s[2:], ROUND(f, 6)
      FROM (SELECT subject AS s, f1 AS f FROM per_class ORDER BY f1, subject LIMIT 1)
    UNION ALL SELECT 'accuracy', NULL, ROUND(correct / CAST(n AS DOUBLE), 6) FROM summary
    UNION ALL SELECT 'macro_f1', NULL, ROUND(macro_f1, 6) FROM summary
    UNION ALL SELECT 'weighted_f1', NULL, ROUND(weighted_f1, 6) FROM summary
    UNION ALL SELECT 'correct_predictions', NULL, correct FROM summary
    UNION ALL SELECT 'improvement_over_majority', NULL, ROUND(macro_f1 / CAST(0.25 AS DOUBLE), 6) FROM summary
    UNION ALL SELECT 'short_text_error_rate', NULL, ROUND(AVG(1 - is_correct), 6) FROM preds WHERE text_length < 100""",
)
def headline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = views.preds(spark, sf_dir)
    counts = metrics.pair_counts(predictions)
    table = metrics.headline(
        metrics.per_class_metrics(counts, LABELS),
        metrics.summary_metrics(counts, LABELS),
        diagnose.error_slices(predictions),
        0.25,
    )
    return table.withColumn("value", F.round("value", 6))


@query(
    "metric_reconciliation",
    f"""WITH {PREDS_SQL}, shown AS (
      SELECT 'correct ' || true_label AS claim, CAST(SUM(is_correct) AS DOUBLE) AS v FROM preds GROUP BY true_label
    ), truth AS (
      SELECT 'correct ' || predicted_label AS claim,
             CAST(SUM(is_correct) + CASE WHEN predicted_label = 'de' THEN 1 ELSE 0 END AS DOUBLE) AS v
      FROM preds GROUP BY predicted_label)
    SELECT claim, shown.v AS displayed_value, truth.v AS authoritative_value,
           abs(shown.v - truth.v) AS absolute_difference, CAST(1e-9 AS DOUBLE) AS tolerance,
           CASE WHEN abs(shown.v - truth.v) <= 1e-9 THEN 'pass' ELSE 'fail' END AS status
    FROM shown FULL JOIN truth USING (claim)""",
)
def metric_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correct rows per label counted on either side, one of them off by one."""
    rows = views.preds(spark, sf_dir)
    shown = rows.groupBy(F.concat(F.lit("correct "), "true_label").alias("claim")).agg(
        F.sum("is_correct").alias("value")
    )
    off = F.when(F.col("predicted_label") == "de", 1).otherwise(0)
    truth = rows.groupBy("predicted_label").agg(F.sum("is_correct").alias("value")).select(
        F.concat(F.lit("correct "), "predicted_label").alias("claim"), (F.col("value") + off).alias("value")
    )
    return metrics.reconcile(shown, truth)


def voted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stop-word models with two settings each on every row.

    A setting is the least confidence at which the vote stands; below it the row counts as 'en'.
    """
    settings = F.array(
        *[
            F.struct(F.lit(name).alias("model_name"), F.lit(at).alias("grid_order"), F.lit(least).alias("least"))
            for at, (name, least) in enumerate(
                [("strict_vote", 0.9), ("strict_vote", 0.8), ("open_vote", 0.0), ("open_vote", 0.3)]
            )
        ]
    )
    return (
        narrow(spark, sf_dir)
        .withColumn("fold", F.col("question_id") % 5)
        .select("*", F.inline(settings))
        .withColumn(
            "predicted_label",
            F.when(F.col("confidence") >= F.col("least"), F.col("predicted_label")).otherwise("en"),
        )
    )


def vote_grid(spark: SparkSession, sf_dir: str, rows: str = "true") -> tuple[DataFrame, DataFrame]:
    """Scores of every setting: (by fold, over the five folds) of the rows that a condition selects."""
    keys = ["model_name", "grid_order", "fold"]
    chosen = voted(spark, sf_dir).filter(rows)
    folds = metrics.summary_metrics(metrics.pair_counts(chosen, by=keys), None, keys)
    scores = metrics.fold_statistics(folds, ["model_name", "grid_order"]).select(
        "model_name",
        "grid_order",
        F.round("macro_f1_mean", 6).alias("mean_score"),
        F.round("macro_f1_std", 6).alias("std_score"),
    )
    return folds, scores


GRID_SQL = f"""{PREDS_SQL}, settings AS (
  SELECT * FROM (VALUES ('strict_vote', 0, 0.9::DOUBLE), ('strict_vote', 1, 0.8), ('open_vote', 2, 0.0),
                        ('open_vote', 3, 0.3)) v(model_name, grid_order, least)
), voted AS (
  SELECT model_name, grid_order, question_id % 5 AS fold, true_label,
         CASE WHEN confidence >= least THEN predicted_label ELSE 'en' END AS predicted_label
  FROM preds, settings
), sides AS (
  SELECT model_name, grid_order, fold, true_label AS l, 1 AS weight,
         CASE WHEN true_label = predicted_label THEN 1 ELSE 0 END AS hits FROM voted
  UNION ALL SELECT model_name, grid_order, fold, predicted_label, 1, 0 FROM voted
), fold_f1 AS (
  SELECT model_name, grid_order, fold, AVG(f1) AS macro_f1 FROM (
    SELECT model_name, grid_order, fold, l, 2 * SUM(hits) / CAST(SUM(weight) AS DOUBLE) AS f1
    FROM sides GROUP BY ALL) GROUP BY ALL
), scores AS (
  SELECT model_name, grid_order, ROUND(AVG(macro_f1), 6) AS mean_score, ROUND(stddev_pop(macro_f1), 6) AS std_score
  FROM fold_f1 GROUP BY ALL
), best AS (
  SELECT model_name, grid_order, mean_score, std_score FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY mean_score DESC, grid_order) AS turn FROM scores)
  WHERE turn = 1
)"""


# The same on development rows, and the winner's score on the test rows.
FINAL_SQL = GRID_SQL.replace("FROM preds, settings", "FROM preds, settings WHERE question_id % 7 <> 0") + """, final_pred AS (
  SELECT s.model_name, true_label, CASE WHEN confidence >= least THEN predicted_label ELSE 'en' END AS predicted_label
  FROM preds, settings s
  JOIN (SELECT model_name, grid_order FROM best ORDER BY mean_score DESC, grid_order LIMIT 1) b USING (model_name, grid_order)
  WHERE question_id % 7 = 0
), final_sides AS (
  SELECT model_name, true_label AS l, 1 AS weight, CASE WHEN true_label = predicted_label THEN 1 ELSE 0 END AS hits FROM final_pred
  UNION ALL SELECT model_name, predicted_label, 1, 0 FROM final_pred
), final_score AS (
  SELECT model_name, AVG(f1) AS final_f1 FROM (
    SELECT model_name, l, 2 * SUM(hits) / CAST(SUM(weight) AS DOUBLE) AS f1 FROM final_sides GROUP BY ALL) GROUP BY ALL
)"""


@query("best_candidates", f"WITH {GRID_SQL} SELECT * FROM best")
def best_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_candidates(vote_grid(spark, sf_dir)[1])


@query("selected_model", f"WITH {GRID_SQL} SELECT * FROM best ORDER BY mean_score DESC, grid_order LIMIT 1")
def selected_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.winner(metrics.best_candidates(vote_grid(spark, sf_dir)[1]))


@query(
    "fold_variation",
    f"""WITH {GRID_SQL} SELECT f.model_name, f.fold, ROUND(f.macro_f1, 6) AS macro_f1
    FROM fold_f1 f JOIN best b USING (model_name, grid_order)""",
)
def fold_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds, scores = vote_grid(spark, sf_dir)
    best = metrics.best_candidates(scores)
    return metrics.fold_scores_of_best(folds, best).withColumn("macro_f1", F.round("macro_f1", 6))


@query(
    "model_comparison",
    f"""WITH {FINAL_SQL} SELECT model_name, mean_score AS grouped_cv_macro_f1_mean, std_score AS grouped_cv_macro_f1_std,
      model_name = won AS locked_final_model,
      CASE WHEN model_name = won THEN final_f1 END AS final_test_macro_f1,
      CASE WHEN model_name = won THEN 'one-time locked confirmation'
           ELSE 'not evaluated to avoid test-set model selection' END AS test_evaluation_policy
    FROM best, (SELECT model_name AS won, ROUND(final_f1, 6) AS final_f1 FROM final_score)""",
)
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings are chosen on the folds of development rows; the winner alone meets the test rows."""
    best = materialize(metrics.best_candidates(vote_grid(spark, sf_dir, "question_id % 7 <> 0")[1]))
    chosen = metrics.winner(best).first()
    test = metrics.pair_counts(voted(spark, sf_dir).filter("question_id % 7 = 0").filter(F.col("grid_order") == chosen.grid_order))
    final = metrics.summary_metrics(test, None).first().macro_f1
    return metrics.model_comparison(best, chosen.model_name, round(final, 6))


@query(
    "replaced_run",
    f"""WITH {PREDS_SQL}
    SELECT 'a' AS run_id, COUNT(*) AS n, CAST(SUM(is_correct) AS BIGINT) AS correct FROM preds WHERE true_label <> 'en'
    UNION ALL SELECT 'b', COUNT(*), CAST(SUM(is_correct) AS BIGINT) FROM preds""",
)
def replaced_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run a is stored, run b is stored, then run a is stored again with fewer rows."""
    store = RunStore(spark, scratch(spark))
    rows = narrow(spark, sf_dir)
    for run_id, frame in (("a", rows), ("b", rows), ("a", rows.filter("true_label <> 'en'"))):
        store.replace(frame, spark.createDataFrame([(run_id, "stop_words")], "run_id string, model_name string"))
    sizes = store.predictions().groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.sum("is_correct").alias("correct"))
    # Both sides have one row per run.
    return store.runs().select("run_id").join(sizes, "run_id")


@query(
    "json_document",
    f"""WITH {PREDS_SQL}, {CLASS_SQL}
    SELECT 'stop_words' AS model_name, n AS final_test_rows, ROUND(macro_f1, 6) AS macro_f1 FROM summary""",
)
def json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics document written as JSON and read back."""
    path = scratch(spark) + "/metrics"
    table = metrics.summary_metrics(metrics.pair_counts(views.preds(spark, sf_dir)), LABELS)
    document = table.select(
        F.lit("stop_words").alias("model_name"),
        F.col("n").alias("final_test_rows"),
        F.round("macro_f1", 6).alias("macro_f1"),
    )
    document.write.mode("overwrite").json(path)
    return tables.read_json_document(spark, path, "model_name string, final_test_rows long, macro_f1 double")
