"""Trained results by invariants, on small tables."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusgauge.operators import features, models

LABELS = ["a", "b"]
SETTING = models.Setting("logistic_regression", 1, 1, 10.0, None, 50)
REPO = Path(__file__).resolve().parents[1]


def texts(spark, rows=48):
    """Two labels told apart by one word each; groups of two rows; two sources."""
    made = []
    for at in range(rows):
        label = LABELS[at % 2]
        made.append((at, f"{'apple' if label == 'a' else 'brick'} filler word{at % 5} more", label, f"s{at % 4 // 2}", at // 4 * 2 + at % 2, at // 4 % 3))
    columns = "question_id long, question_text string, category string, src string, duplicate_group_id long, fold int"
    return spark.createDataFrame(made, columns)


def test_learned_words_lead_the_features(spark):
    model = models.fit_classifier(texts(spark), SETTING, LABELS)
    best = {row.subject: row.feature for row in model.weights().withColumn("r", F.expr("row_number() over (partition by subject order by coefficient desc)")).filter("r = 1").collect()}
    assert best == {"a": "apple", "b": "brick"}
    scored = model.score(texts(spark))
    assert scored.filter("predicted_label <> category").count() == 0


def test_learning_curve_and_holdout(spark):
    curve = models.learning_curve(texts(spark), SETTING, LABELS, 3, (0.5, 1.0)).collect()
    assert [row.development_fraction for row in curve] == [0.5, 1.0]
    assert curve[0].mean_training_rows < curve[1].mean_training_rows == 32
    assert curve[1].validation_macro_f1_mean == 1.0
    held = models.source_holdout(texts(spark), SETTING, LABELS, min_rows=10).collect()
    assert [(row.status, row.held_out_source, row.n, row.macro_f1) for row in held] == [("evaluated", "s0", 24, 1.0), ("evaluated", "s1", 24, 1.0)]
    assert models.source_holdout(texts(spark), SETTING, LABELS, min_rows=1000).first().status == "not_feasible"


def test_search_shares_its_counts(spark):
    grid = models.search_grid(("logistic_regression",), (1, 2), (1,), (1.0,), (None,), 20)
    search = models.grouped_search(texts(spark), grid, LABELS, 3)
    assert search.scores.count() == 2 and search.fold_scores.count() == 6
    assert all(row.recall == 1.0 for row in search.recall.collect())


def test_unlisted_labels_are_refused(spark):
    with pytest.raises(ValueError, match="outside .*: c"):
        models.fit_classifier(texts(spark).withColumn("category", F.when(F.col("question_id") == 3, "c").otherwise(F.col("category"))), SETTING, LABELS)


def test_workers_find_the_package_from_another_folder(tmp_path):
    """Normalization runs a Python function of the package on the workers."""
    script = f"""
import sys; sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").config("spark.driver.bindAddress", "127.0.0.1").config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as spec
print("ROWS", spec.queries()["validated_rows"](spark, "/root/testdata/sf0.001").count())
"""
    environment = {key: value for key, value in os.environ.items() if key != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]


def test_registered_queries_ask_for_the_whole_job(monkeypatch):
    from types import SimpleNamespace

    from corpusgauge.plans import learning

    asked = {}
    monkeypatch.setattr(learning, "folded", lambda spark, sf_dir, folds: folds)
    monkeypatch.setattr(learning, "materialize", lambda rows: rows)
    questions = SimpleNamespace(filter=lambda condition: condition)
    monkeypatch.setattr(learning.views, "questions", lambda spark, sf_dir: questions)

    def search(folded, grid, labels, folds):
        asked["search"] = (folded, folds, len(set(grid)), {s.max_iter for s in grid})
        return SimpleNamespace(scores=None, recall=None)

    def curve(folded, setting, labels, folds, fractions=(0.2, 0.4, 0.6, 0.8, 1.0)):
        asked["curve"] = (folded, folds, fractions)

    monkeypatch.setattr(learning.models, "grouped_search", search)
    monkeypatch.setattr(learning.models, "learning_curve", curve)
    monkeypatch.setattr(learning.models, "source_holdout", lambda rows, setting, labels, least: asked.update(holdout=rows))
    for query in (learning.grid_search, learning.out_of_fold_recall):
        asked.pop("search", None)
        query(None, "")
        assert asked["search"] == (5, 5, 72, {5000})
    learning.learning_curve(None, "")
    assert asked["curve"] == (5, 5, (0.2, 0.4, 0.6, 0.8, 1.0))
    learning.source_holdout(None, "")
    assert asked["holdout"] == "split_name = 'development'"
    assert learning.LOGISTIC.max_iter == learning.MACHINE.max_iter == 5000


def test_counts_of_just_these_rows_are_not_joined_by_id(spark):
    rows = spark.createDataFrame(
        [(1, "aa bb bb"), (2, "aa cc"), (2, "cc dd"), (None, "aa bb"), (3, None)], "question_id long, question_text string"
    )
    counts = features.materialize(features.word_counts(rows))
    old, new = (features.fit_tfidf(rows, min_df=2, counts=counts, **more) for more in ({}, {"exact": True}))
    assert sorted(old.vocabulary.collect()) == sorted(new.vocabulary.collect())
    wanted, got = old.postings(rows, counts=counts), new.postings(rows, counts=counts, exact=True)
    assert sorted(wanted.collect()) == sorted(got.collect())
    assert "LeftSemi" not in got._jdf.queryExecution().toString()
    sums = {row.id: row for row in new.summary(rows, counts=counts, exact=True).collect()}
    for id in (1, 2):
        weights = [row.weight for row in got.collect() if row.id == id]
        assert sums[id].features == len(weights)
        assert abs(sums[id].top_weight - max(weights)) < 1e-12 and abs(sums[id].weight_sum - sum(weights)) < 1e-12
    assert len(sums) == 2


@pytest.mark.parametrize("name", models.MODELS)
def test_test_rows_are_scored_inside_the_fit(spark, monkeypatch, name):
    """As by the model's weights; before, all words of all rows were stored and joined with the weights."""
    rows = texts(spark).withColumn("split_name", F.when(F.col("question_id") % 3 == 0, "test").when(F.col("question_id") >= 0, "development"))
    more = [(None, "apple", "a", "s0", 0, 0, "test"), (6, "brick twice", "a", "s1", 1, 0, "test"), (48, None, "b", "s1", 1, 0, "test")]
    rows = rows.unionByName(spark.createDataFrame([*more, (49, "brick", "b", "s0", 1, 0, None)], rows.schema))
    setting = models.Setting(name, 1, 2, 1.0, None, 50)
    development = rows.filter("split_name = 'development'")
    model = models.fit_classifier(development, setting, LABELS, counts=features.word_counts(rows))
    wanted = model.score(rows.filter("split_name = 'test'"), counts=features.word_counts(rows))
    shown = ["predicted_label", "confidence", "decision_score"]
    wanted = sorted(str([r[0], *r[1:2], *(x and round(x, 7) for x in r[2:])]) for r in wanted.select("question_id", *shown).collect())
    monkeypatch.setattr(models, "word_counts", None)
    scored = models.score_test(rows, setting, LABELS, "run")
    got = sorted(str([r[0], *r[1:2], *(x and round(x, 7) for x in r[2:])]) for r in scored.select("source_question_id", *shown).collect())
    assert len(got) == 19 and got == wanted


def test_sources_are_summed_for_the_leading_features_only(spark):
    """As from all postings; before, these were made and joined for every feature of every row."""
    from corpusgauge.operators import diagnose

    rows = texts(spark)
    rows = rows.unionByName(rows.filter("question_id < 3")).withColumn("src", F.when(F.col("question_id") != 7, F.col("src")))
    rows = rows.unionByName(spark.createDataFrame([(None, "apple none", "a", "s9", 0, 0)], rows.schema))
    model = models.fit_classifier(rows, SETTING, LABELS)
    documents = rows.select(F.col("question_id").alias("id"), "src")
    wanted = diagnose.source_dominance(model.tfidf.postings(rows), documents)
    wanted = diagnose.top_features(model.weights(), 2, wanted, rows.select("src")).collect()
    leading = diagnose.leading_features(model.weights(), 2).select("subject", "feature", "coefficient").distinct()
    sums = model.group_sums(documents, leading.select("feature").distinct())
    got = diagnose.top_features(leading, 2, diagnose.dominance_of_sums(sums, documents), rows.select("src")).collect()
    tidy = lambda found: sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in found)
    assert tidy(got) == tidy(wanted) and len(got) == 8
