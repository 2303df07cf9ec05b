"""Classification metrics from (true, predicted) pairs, as aggregates that never fetch rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.functions.text import hash_int, position, ratio, ratio_or_zero


def pair_counts(
    predictions: DataFrame,
    true: str = "true_label",
    predicted: str = "predicted_label",
    by: Sequence[str] = (),
) -> DataFrame:
    """(by…, true_label, predicted_label, n): at most labels² rows per ``by`` group."""
    return predictions.groupBy(
        *by, F.col(true).alias("true_label"), F.col(predicted).alias("predicted_label")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(predictions: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Dense matrix, one row per true label in the given order, one column per predicted label."""
    labels = list(labels)
    known = pair_counts(predictions).filter(F.col("true_label").isin(labels))
    cells = known.select("true_label", "predicted_label", "n")
    # A zero row per label keeps labels without predictions in the matrix.
    empty = cells.sparkSession.createDataFrame([(label,) for label in labels], "true_label string")
    padded = cells.unionByName(
        empty.select("true_label", F.col("true_label").alias("predicted_label"), F.lit(0).cast("bigint").alias("n"))
    )
    return (
        padded.groupBy("true_label")
        .pivot("predicted_label", labels)
        .agg(F.sum("n"))
        .fillna(0, subset=labels)
        .orderBy(position(F.col("true_label"), labels))
    )


def per_class_metrics(
    counts: DataFrame, labels: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """(by…, subject, precision, recall, f1, support) from pair counts; 0/0 is 0.

    With ``labels`` exactly those labels are reported, present or not; without, the labels seen
    as true or predicted.
    """
    hit = F.col("true_label") == F.col("predicted_label")
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("true_label").alias("subject"),
            F.col("n").alias("support"),
            F.when(hit, F.col("n")).otherwise(zero).alias("hits"),
            zero.alias("claimed"),
        ),
        F.struct(
            F.col("predicted_label").alias("subject"),
            zero.alias("support"),
            zero.alias("hits"),
            F.col("n").alias("claimed"),
        ),
    )
    sums = counts.select(*by, F.inline(sides))
    if labels is not None:
        wanted = F.explode(F.array(*[F.lit(label) for label in labels])).alias("subject")
        blank = counts.select(*by).distinct().select(
            *by, wanted, zero.alias("support"), zero.alias("hits"), zero.alias("claimed")
        )
        sums = sums.filter(F.col("subject").isin(list(labels))).unionByName(blank)
    totals = sums.groupBy(*by, "subject").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("support", "hits", "claimed")]
    )
    return totals.select(
        *by,
        "subject",
        ratio_or_zero(F.col("hits"), F.col("claimed")).alias("precision"),
        ratio_or_zero(F.col("hits"), F.col("support")).alias("recall"),
        ratio_or_zero(2 * F.col("hits"), F.col("claimed") + F.col("support")).alias("f1"),
        "support",
    )


def summary_metrics(
    counts: DataFrame, labels: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """(by…, n, correct, accuracy, macro_f1, weighted_f1) from pair counts."""
    keyed = counts.withColumn("_all", F.lit(1))
    keys = ["_all", *by]
    totals = keyed.groupBy(*keys).agg(
        F.sum("n").cast("bigint").alias("n"),
        F.coalesce(
            F.sum(F.when(F.col("true_label") == F.col("predicted_label"), F.col("n"))), F.lit(0)
        ).cast("bigint").alias("correct"),
    )
    averages = (
        per_class_metrics(keyed, labels, keys)
        .groupBy(*keys)
        .agg(
            F.avg("f1").alias("macro_f1"),
            ratio_or_zero(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
        )
    )
    return totals.join(averages, keys).select(
        *by, "n", "correct", ratio(F.col("correct"), F.col("n")).alias("accuracy"), "macro_f1", "weighted_f1"
    )


def fold_statistics(
    scores: DataFrame, by: Sequence[str], score: str = "macro_f1"
) -> DataFrame:
    """Mean and population standard deviation of a score over folds."""
    return scores.groupBy(*by).agg(
        F.avg(score).alias(f"{score}_mean"),
        F.stddev_pop(score).alias(f"{score}_std"),
        F.count(F.lit(1)).alias("folds"),
    )


def majority_baseline(
    folded: DataFrame, folds: int, label: str = "category", fold: str = "fold"
) -> DataFrame:
    """(fold, predicted_label, macro_f1) when each fold is predicted as the most frequent label
    of the other folds. Only fold-by-label counts are moved; ties go to the lesser label."""
    cells = folded.groupBy(F.col(fold).cast("bigint").alias("fold"), F.col(label).alias("true_label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = cells.groupBy("true_label").agg(F.sum("n").alias("total"))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(folds - 1).cast("bigint"))
    rest = (
        totals.select("true_label", "total", F.explode(every).alias("fold"))
        .join(cells, ["fold", "true_label"], "left")
        .withColumn("outside", F.col("total") - F.coalesce("n", F.lit(0)))
    )
    choice = rest.groupBy("fold").agg(
        F.min_by("true_label", F.struct(-F.col("outside"), F.col("true_label"))).alias("predicted_label")
    )
    scored = summary_metrics(cells.join(choice, "fold"), None, ["fold"])
    return choice.join(scored.select("fold", "macro_f1"), "fold").orderBy("fold")


def confusion_table(predictions: DataFrame, labels: Sequence[str]) -> list[list[int]]:
    """The k×k counts as Python numbers, after checks that every label has true rows."""
    labels = list(labels)
    rows = {(r.true_label, r.predicted_label): r.n for r in pair_counts(predictions).filter(
        F.col("true_label").isin(labels)).groupBy(
        "true_label",
        F.when(F.col("predicted_label").isin(labels), F.col("predicted_label")).alias("predicted_label"),
    ).agg(F.sum("n").alias("n")).collect()}
    if not rows:
        raise ValueError("no rows to draw from")
    table = [[rows.get((true, label), 0) for label in [*labels, None]] for true in labels]
    if any(sum(line) == 0 for line in table):
        raise ValueError("a label has no row to draw from")
    return table


def _interval(scores: DataFrame, iterations: int) -> DataFrame:
    return scores.agg(F.percentile("macro_f1", F.array(F.lit(0.025), F.lit(0.975))).alias("p")).select(
        F.col("p")[0].alias("lower"),
        F.col("p")[1].alias("upper"),
        F.lit(iterations).cast("bigint").alias("iterations"),
    )


def bootstrap_by_draws(
    predictions: DataFrame, labels: Sequence[str], iterations: int = 2000, seed: int = 42
) -> DataFrame:
    """Interval of macro-F1 from resampling every row inside its true class, draw by draw.

    Each (iteration, row) is one generated row whose md5 picks a member of the class; members
    are ordered by predicted label, so the pick reads off the class's confusion row. The work is
    iterations × rows; :func:`bootstrap_by_counts` gives the same law without that factor.
    """
    if iterations < 1:
        raise ValueError("ask for at least one draw")
    labels = list(labels)
    table = confusion_table(predictions, labels)
    sizes = [sum(line) for line in table]
    rows = sum(sizes)
    spark = predictions.sparkSession
    at = F.col("id") % rows
    true, start, size, before = F.lit(None).cast("string"), F.lit(0), F.lit(1), 0
    for label, count in zip(labels, sizes):
        inside = at >= before
        true = F.when(inside, F.lit(label)).otherwise(true)
        start = F.when(inside, F.lit(before)).otherwise(start)
        size = F.when(inside, F.lit(count)).otherwise(size)
        before += count
    draws = spark.range(iterations * rows).select(
        F.expr(f"id div {rows}").alias("iteration"),
        true.alias("true_label"),
        (at - start).cast("bigint").alias("draw"),
        size.cast("bigint").alias("size"),
    )
    pick = 1 + F.pmod(
        hash_int(
            F.lit(str(seed)), F.col("iteration").cast("string"), "true_label", F.col("draw").cast("string")
        ),
        F.col("size"),
    )
    predicted = F.lit(None).cast("string")
    for label, line in zip(labels, table):
        upto, chosen = 0, F.lit(None).cast("string")
        bounds = []
        for name, count in zip(labels, line):
            upto += count
            bounds.append((upto, name))
        for upper, name in reversed(bounds):
            chosen = F.when(F.col("pick") <= upper, F.lit(name)).otherwise(chosen)
        predicted = F.when(F.col("true_label") == label, chosen).otherwise(predicted)
    counts = (
        draws.withColumn("pick", pick)
        .select("iteration", "true_label", predicted.alias("predicted_label"))
        .groupBy("iteration", "true_label", "predicted_label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _interval(summary_metrics(counts, labels, ["iteration"]), iterations)


def bootstrap_by_counts(
    predictions: DataFrame, labels: Sequence[str], iterations: int = 2000, seed: int = 42
) -> DataFrame:
    """The same interval from multinomial draws of each class's confusion row.

    Resampling n rows of a class with replacement gives multinomial confusion counts, and
    macro-F1 depends on those counts alone: k² numbers per iteration, whatever the row count.
    """
    if iterations < 1:
        raise ValueError("ask for at least one draw")
    table = np.asarray(confusion_table(predictions, labels), dtype=np.int64)
    sizes = table.sum(axis=1)
    shares = table / sizes[:, None]

    def resample(batches):
        for batch in batches:
            scores = np.empty(len(batch))
            for at, iteration in enumerate(batch["id"]):
                generator = np.random.default_rng([seed, int(iteration)])
                drawn = np.stack([generator.multinomial(n, p) for n, p in zip(sizes, shares)])
                inside = drawn[:, : len(sizes)]
                whole = inside.sum(axis=0) + sizes
                scores[at] = np.mean(2 * np.diagonal(inside) / np.where(whole == 0, 1, whole))
            yield pd.DataFrame({"macro_f1": scores})

    scores = predictions.sparkSession.range(iterations).mapInPandas(resample, "macro_f1 double")
    return _interval(scores, iterations)


def unpivot_metrics(per_class: DataFrame) -> DataFrame:
    return per_class.unpivot(
        ["subject", "support"], ["precision", "recall", "f1"], "metric", "score"
    )


def headline(
    per_class: DataFrame, summary: DataFrame, slices: DataFrame, baseline_macro_f1: float
) -> DataFrame:
    """(name, value) table: best and worst class, correct rows, gain, error on short texts."""
    extremes = per_class.agg(
        F.min_by("subject", F.struct(-F.col("f1"), F.col("subject"))).alias("strongest_class"),
        F.max("f1").alias("strongest_f1"),
        F.min_by("subject", F.struct(F.col("f1"), F.col("subject"))).alias("weakest_class"),
        F.min("f1").alias("weakest_f1"),
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f"{end}_class").alias("name"),
                        F.initcap(f"{end}_class").alias("text"),
                        F.col(f"{end}_f1").alias("value"),
                    )
                    for end in ("strongest", "weakest")
                ]
            )
        )
    )
    none = F.lit(None).cast("string")
    numbers = summary.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("name"), none.alias("text"), value.cast("double").alias("value"))
                    for name, value in (
                        ("accuracy", F.col("accuracy")),
                        ("macro_f1", F.col("macro_f1")),
                        ("weighted_f1", F.col("weighted_f1")),
                        ("correct_predictions", F.col("correct")),
                        ("improvement_over_majority", F.col("macro_f1") / F.lit(baseline_macro_f1)),
                    )
                ]
            )
        )
    )
    short = slices.filter("slice_type = 'length_band' AND slice_value = '<100'").select(
        F.lit("short_text_error_rate").alias("name"), none.alias("text"), F.col("error_rate").alias("value")
    )
    return extremes.unionByName(numbers).unionByName(short)


def best_candidates(
    scores: DataFrame, model: str = "model_name", score: str = "mean_score", order: str = "grid_order"
) -> DataFrame:
    """Best setting of each model; ties go to the first in grid order. One row per setting enters."""
    best = F.min_by(F.struct(*[F.col(c) for c in scores.columns]), F.struct(-F.col(score), F.col(order)))
    return scores.groupBy(model).agg(best.alias("best")).select("best.*")


def winner(best: DataFrame, score: str = "mean_score", order: str = "grid_order") -> DataFrame:
    return best.orderBy(F.desc(score), order).limit(1)


def model_comparison(
    best: DataFrame, selected: str, final_macro_f1: float, score: str = "mean_score", std: str = "std_score"
) -> DataFrame:
    """One row per model; only the locked model shows a test score."""
    locked = F.col("model_name") == selected
    return best.select(
        "model_name",
        F.col(score).alias("grouped_cv_macro_f1_mean"),
        F.col(std).alias("grouped_cv_macro_f1_std"),
        locked.alias("locked_final_model"),
        F.when(locked, F.lit(final_macro_f1)).alias("final_test_macro_f1"),
        F.when(locked, "one-time locked confirmation")
        .otherwise("not evaluated to avoid test-set model selection")
        .alias("test_evaluation_policy"),
    )


def fold_scores_of_best(fold_scores: DataFrame, best: DataFrame) -> DataFrame:
    """(model_name, fold, macro_f1) for each model's best setting."""
    chosen = best.select("model_name", "grid_order")
    return (
        fold_scores.join(F.broadcast(chosen), ["model_name", "grid_order"])
        .select("model_name", "fold", "macro_f1")
        .orderBy("model_name", "fold")
    )


def reconcile(
    displayed: DataFrame, authoritative: DataFrame, tolerance: float = 1e-9
) -> DataFrame:
    """Compare (claim, value) tables; a claim missing on either side fails."""
    both = displayed.select("claim", F.col("value").cast("double").alias("displayed_value")).join(
        authoritative.select("claim", F.col("value").cast("double").alias("authoritative_value")),
        "claim",
        "full_outer",
    )
    difference = F.abs(F.col("displayed_value") - F.col("authoritative_value"))
    return both.select(
        "claim",
        "displayed_value",
        "authoritative_value",
        difference.alias("absolute_difference"),
        F.lit(tolerance).alias("tolerance"),
        F.when(difference <= tolerance, "pass").otherwise("fail").alias("status"),
    ).orderBy("claim")


def require_reconciled(comparison: DataFrame) -> DataFrame:
    failed = comparison.filter("status = 'fail'").select("claim").collect()
    if failed:
        raise ValueError("these numbers disagree: " + ", ".join(sorted(r.claim for r in failed)))
    return comparison
