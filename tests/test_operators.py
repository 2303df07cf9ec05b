"""Operators on small hand-made tables."""

import pytest
from pyspark.sql import functions as F

from corpusgauge.functions.text import normalize_text
from corpusgauge.operators import diagnose, features, keyed, metrics, models, reports, split, validate
from corpusgauge.sources import tables

LABELS = ["math", "physics", "chemistry", "biology"]
# A published confusion matrix, rows are true labels.
MATRIX = [[183, 9, 1, 0], [4, 159, 17, 5], [6, 18, 133, 5], [5, 3, 4, 78]]


def predictions(spark):
    rows = [
        (true, predicted)
        for true, line in zip(LABELS, MATRIX)
        for predicted, count in zip(LABELS, line)
        for _ in range(count)
    ]
    return spark.createDataFrame(rows, "true_label string, predicted_label string").withColumn(
        "is_correct", (F.col("true_label") == F.col("predicted_label")).cast("int")
    )


def test_normalization(spark):
    given = ["  If  E = mc²,\n why?  ", "a\u00a0b\u2003c\u3000d\u001ce", "e\u0301te\u0301  \U0001d11e", ""]
    want = ["If E = mc², why?", "a b c d e", "\u00e9t\u00e9 \U0001d11e", ""]
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(given)], "n int, t string")
    assert [r.t for r in frame.select("n", normalize_text(F.col("t")).alias("t")).orderBy("n").collect()] == want


def test_exclusion_reasons_and_their_priority(spark):
    rows = [
        (1, 10, "first text", "math", "s"),
        (2, 11, "   ", "math", "s"),
        (3, 12, "other", "art", "s"),
        (4, 10, "third", "math", "s"),
        (5, 13, "fourth", "math", "  "),
        (6, 14, "first  text", "math", "s"),
        (7, 15, "other", "math", "s"),
        (8, 12, "fifth", "math", "s"),
        (9, None, "sixth", None, None),
        (10, None, "seventh", "math", "s"),
        (11, 16, None, "math", "s"),
    ]
    frame = spark.createDataFrame(
        rows, "row_key long, question_id long, question string, category string, src string"
    )
    annotated = validate.annotate_rows(frame, LABELS, "row_key")
    got = {r.row_key: r.exclusion_reason for r in annotated.collect()}
    assert got == {
        1: None,
        2: "empty_question",
        3: "invalid_subject",
        4: "duplicate_question_id",
        5: "missing_source",
        6: "exact_duplicate",
        7: "exact_duplicate",
        8: "duplicate_question_id",
        9: "invalid_subject",
        10: "duplicate_question_id",
        11: "empty_question",
    }
    with pytest.raises(ValueError, match="src"):
        validate.annotate_rows(frame.drop("src"), LABELS, "row_key")


def test_metrics_of_a_known_matrix(spark):
    counts = metrics.pair_counts(predictions(spark))
    summary = metrics.summary_metrics(counts, LABELS).first()
    assert (summary.n, summary.correct) == (630, 553)
    assert summary.accuracy == pytest.approx(0.877778, abs=1e-6)
    assert summary.macro_f1 == pytest.approx(0.875462, abs=1e-6)
    assert summary.weighted_f1 == pytest.approx(0.877417, abs=1e-6)
    matrix = metrics.confusion_matrix(predictions(spark), LABELS).collect()
    assert [[row[label] for label in LABELS] for row in matrix] == MATRIX
    wider = metrics.per_class_metrics(counts, [*LABELS, "art"]).filter("subject = 'art'").first()
    assert (wider.precision, wider.recall, wider.f1, wider.support) == (0.0, 0.0, 0.0, 0)


def test_bootstrap_intervals(spark):
    rows = predictions(spark)
    by_counts = metrics.bootstrap_by_counts(rows, LABELS, 500).first()
    by_draws = metrics.bootstrap_by_draws(rows, LABELS, 200).first()
    for interval in (by_counts, by_draws):
        assert interval.lower == pytest.approx(0.847, abs=0.01)
        assert interval.upper == pytest.approx(0.900, abs=0.01)
    assert by_counts == metrics.bootstrap_by_counts(rows, LABELS, 500).first()
    with pytest.raises(ValueError, match="at least one draw"):
        metrics.bootstrap_by_counts(rows, LABELS, 0)
    with pytest.raises(ValueError, match="no row to draw from"):
        metrics.bootstrap_by_counts(rows, [*LABELS, "art"])


def test_empty_band_and_null_slices(spark):
    rows = spark.createDataFrame(
        [("math", None, 50, 1), ("math", "s", 450, 0)],
        "true_label string, source_name string, text_length long, is_correct int",
    )
    got = {(r.slice_type, r.slice_value): (r.n, r.error_rate) for r in diagnose.error_slices(rows).collect()}
    assert got["length_band", "100-199"] == (0, None) and got["source", None] == (1, 0.0)
    assert got["length_band", "400+"] == (1, 1.0)


def test_crossing_groups_raise(spark):
    rows = spark.createDataFrame([(1, "development"), (1, "test")], "duplicate_group_id long, split_name string")
    with pytest.raises(ValueError, match="two splits"):
        reports.assert_no_crossing(rows)


def test_folds_keep_groups_whole_and_balanced(spark):
    rows = spark.range(400).select(
        F.col("id").alias("question_id"),
        F.element_at(F.array(*[F.lit(x) for x in LABELS]), (F.col("id") % 4 + 1).cast("int")).alias("category"),
        F.floor(F.col("id") / 12).alias("duplicate_group_id"),
    )
    folded = split.assign_folds(rows, LABELS, 5)
    assert folded.groupBy("duplicate_group_id").agg(F.countDistinct("fold").alias("n")).filter("n > 1").isEmpty()
    assert folded.select("fold").distinct().count() == 5


def test_sample_needs_enough_rows(spark):
    rows = spark.range(16).select(
        F.col("id").alias("question_id"), F.lit("t").alias("question_text"), (F.col("id") % 4).cast("string").alias("category")
    )
    assert split.balanced_sample(rows, 3).count() == 12
    with pytest.raises(ValueError, match="too few rows"):
        split.balanced_sample(rows, 5)


def test_lookup_join_with_a_hot_key(spark):
    facts = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    sizes = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    plain = {tuple(r) for r in keyed.lookup_join(facts, sizes, "k", "n").collect()}
    cut = {tuple(r) for r in keyed.lookup_join(facts, sizes, "k", "n", limit=10).collect()}
    assert plain == cut and len(plain) == 1000


def test_unknown_keys_and_repeated_keys_raise(spark):
    keys = spark.createDataFrame([(1, 10)], "external long, local long")
    rows = spark.createDataFrame([(1,), (2,)], "external long")
    with pytest.raises(ValueError, match=r"\[2\]"):
        tables.translate_keys(rows, keys, "external", "local")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "question_id long, t string")
    with pytest.raises(ValueError, match="unique"):
        validate.enrich_one_to_one(rows.withColumnRenamed("external", "source_question_id"), twice, ["t"])


def test_reconciliation_fails_on_drift(spark):
    shown = spark.createDataFrame([("f1", 0.5)], "claim string, value double")
    truth = spark.createDataFrame([("f1", 0.6)], "claim string, value double")
    with pytest.raises(ValueError, match="disagree: f1"):
        metrics.require_reconciled(metrics.reconcile(shown, truth))
    assert metrics.require_reconciled(metrics.reconcile(shown, shown)).first().status == "pass"


def corpus(spark):
    words = {"math": "integral matrix prime", "physics": "force quark photon"}
    rows = [
        (n, f"{words[label]} the number {n % 7}", label, n, "test" if n % 5 == 0 else "development", f"s{n % 2}")
        for n, label in enumerate(["math", "physics"] * 20)
    ]
    return spark.createDataFrame(
        rows,
        "question_id long, question_text string, category string, duplicate_group_id long, split_name string, src string",
    )


@pytest.mark.parametrize("name", models.MODELS)
def test_classifiers_separate_plain_classes(spark, name):
    setting = models.Setting(name, c=10.0, max_iter=20)
    scored = models.score_test(corpus(spark), setting, ["math", "physics"], "run").collect()
    assert len(scored) == 8 and all(r.is_correct for r in scored)
    assert all((r.confidence is None) != (r.decision_score is None) for r in scored)


def test_search_and_holdout(spark):
    labels = ["math", "physics"]
    folded = corpus(spark).withColumn("fold", F.col("question_id").cast("int") % 2)
    grid = models.search_grid(("logistic_regression",), (1,), (1,), (0.1, 10.0), (None,), 10)
    search = models.grouped_search(folded, grid, labels, 2)
    assert search.scores.count() == 2 and search.selected in grid
    assert sum(r.support for r in search.recall.collect()) == 40
    held = models.source_holdout(corpus(spark), grid[0], labels, min_rows=100).first()
    assert held.status == "not_feasible" and held.n == 0


def test_features_are_fitted_on_training_rows_only(spark):
    train = spark.createDataFrame([(1, "alpha beta beta"), (2, "alpha x")], "question_id long, question_text string")
    test = spark.createDataFrame([(3, "gamma alpha"), (4, "gamma")], "question_id long, question_text string")
    model = features.fit_tfidf(train)
    assert [r.feature for r in model.vocabulary.orderBy("index").collect()] == ["alpha", "beta"]
    got = {r.question_id: r.features.toArray().tolist() for r in model.transform(test).collect()}
    assert got == {3: [1.0, 0.0], 4: [0.0, 0.0]}
    with pytest.raises(ValueError, match="exceed"):
        features.fit_tfidf(train, max_features=1)


def test_decision_guard(spark):
    rows = corpus(spark)
    columns = ["question_text", "category", "duplicate_group_id"]
    mark = validate.fingerprint(rows, columns).first().fingerprint
    assert mark == validate.fingerprint(rows.repartition(5), columns).first().fingerprint
    models.check_locked({"development_fingerprint": mark}, rows, columns)
    with pytest.raises(ValueError, match="other rows than these"):
        models.check_locked({"development_fingerprint": mark}, rows.limit(3), columns)
