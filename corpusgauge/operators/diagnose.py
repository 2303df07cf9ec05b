"""Where a classifier errs: slices, coverage, example cases, and features that betray a source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusgauge.durable import materialize
from corpusgauge.functions.text import LENGTH_BANDS, band, position, ratio

# Confidence thresholds of the coverage curve.
THRESHOLDS = [0.0, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95]
# Fixed value: the status shown where a model gives no probability.
NO_PROBABILITY = "not_available_locked_model_has_no_calibrated_probability"


def error_slices(predictions: DataFrame) -> DataFrame:
    """Correctness by label, source and length band in one aggregation.

    NULL is a slice of its own; length bands without rows appear with n = 0 and NULL rates.
    """
    slices = F.array(
        F.struct(F.lit("subject").alias("slice_type"), F.col("true_label").alias("slice_value")),
        F.struct(F.lit("source").alias("slice_type"), F.col("source_name").alias("slice_value")),
        F.struct(
            F.lit("length_band").alias("slice_type"),
            band(F.col("text_length"), LENGTH_BANDS).alias("slice_value"),
        ),
    )
    counted = (
        predictions.select(F.inline(slices), "is_correct")
        .groupBy("slice_type", "slice_value")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("is_correct").cast("bigint").alias("correct"))
    )
    names = [name for _, name in LENGTH_BANDS]
    bands = predictions.sparkSession.createDataFrame(
        [("length_band", name, 0, 0) for name in names],
        "slice_type string, slice_value string, n bigint, correct bigint",
    )
    totals = (
        counted.unionByName(bands)
        .groupBy("slice_type", "slice_value")
        .agg(F.sum("n").alias("n"), F.sum("correct").alias("correct"))
    )
    errors = F.col("n") - F.col("correct")
    return totals.select(
        "slice_type",
        "slice_value",
        "n",
        "correct",
        errors.alias("errors"),
        ratio(F.col("correct"), F.col("n")).alias("accuracy"),
        ratio(errors, F.col("n")).alias("error_rate"),
    ).orderBy(
        position(F.col("slice_type"), ["subject", "source"]),
        F.when(F.col("slice_type") == "length_band", position(F.col("slice_value"), names)).otherwise(0),
        F.col("slice_value").asc_nulls_last(),
    )


def coverage_curve(
    predictions: DataFrame, thresholds: Sequence[float] = tuple(THRESHOLDS)
) -> DataFrame:
    """Rows, coverage of all rows, and accuracy at or above each threshold, from one pass.

    Without any confidence a single row says so.
    """
    sums = [F.count(F.lit(1)).alias("rows"), F.count("confidence").alias("valid")]
    for at, threshold in enumerate(thresholds):
        above = F.col("confidence") >= F.lit(float(threshold))
        sums.append(F.count(F.when(above, 1)).alias(f"n{at}"))
        sums.append(F.sum(F.when(above, F.col("is_correct"))).cast("bigint").alias(f"c{at}"))
    available = [
        F.struct(
            F.lit(float(threshold)).alias("threshold"),
            F.col(f"n{at}").alias("automated_count"),
            ratio(F.col(f"n{at}"), F.col("rows")).alias("automated_coverage"),
            (F.col("rows") - F.col(f"n{at}")).alias("manual_review_volume"),
            ratio(F.col(f"c{at}"), F.col(f"n{at}")).alias("automated_accuracy"),
            F.lit("available").alias("status"),
        )
        for at, threshold in enumerate(thresholds)
    ]
    nothing = F.struct(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0).cast("bigint").alias("automated_count"),
        F.lit(0.0).cast("double").alias("automated_coverage"),
        F.col("rows").alias("manual_review_volume"),
        F.lit(None).cast("double").alias("automated_accuracy"),
        F.lit(NO_PROBABILITY).alias("status"),
    )
    return (
        predictions.agg(*sums)
        .select(F.when(F.col("valid") > 0, F.array(*available)).otherwise(F.array(nothing)).alias("lines"))
        .select(F.inline("lines"))
    )


def representative_cases(predictions: DataFrame, per_outcome: int = 5) -> DataFrame:
    """Deterministic wrong (lowest score) and right (highest score) rows, taken label by label.

    The score of an outcome is its confidence, or the decision score where it has none. What
    the choice needs is computed once, as a narrow table; texts are fetched for the few rows that
    are shown.
    """
    shown = ["source_question_id", "true_label", "predicted_label", "source_name", "text_length", "confidence", "decision_score"]
    narrow = materialize(
        predictions.select(*shown, (F.col("is_correct") == 0).alias("wrong")).filter("wrong IS NOT NULL")
    )
    confident = {r["wrong"] for r in narrow.filter("confidence IS NOT NULL").select("wrong").distinct().collect()}
    by_confidence = F.col("wrong").isin(*confident) if confident else F.lit(False)
    sign = F.when(F.col("wrong"), 1.0).otherwise(-1.0)
    score = sign * F.when(by_confidence, F.col("confidence")).otherwise(F.col("decision_score"))
    in_label = Window.partitionBy("wrong", "true_label").orderBy(F.col("_score").asc_nulls_last(), "source_question_id")
    in_outcome = Window.partitionBy("wrong").orderBy("_turn", "true_label")
    # Spark drops rows beyond the limit before the shuffle of such a window.
    leading = narrow.withColumn("_score", score).withColumn("_turn", F.row_number().over(in_label))
    leading = leading.filter(F.col("_turn") <= per_outcome)
    chosen = leading.withColumn("_place", F.row_number().over(in_outcome)).filter(F.col("_place") <= per_outcome)
    # At most ``per_outcome`` rows of each outcome.
    texts = predictions.select("source_question_id", "question_text", (F.col("is_correct") == 0).alias("wrong"))
    wanted = materialize(chosen.select(*shown, "wrong", "_place"))
    ids = [r["source_question_id"] for r in wanted.select("source_question_id").distinct().collect()]
    fetched = texts.filter(F.col("source_question_id").isin(ids)) if ids else texts.limit(0)
    return (
        fetched.join(F.broadcast(wanted), ["source_question_id", "wrong"])
        .withColumn("outcome", F.when(F.col("wrong"), "incorrect").otherwise("correct"))
        .orderBy(F.desc("outcome"), "_place")
        .select(
            "outcome",
            "source_question_id",
            "true_label",
            "predicted_label",
            "source_name",
            "text_length",
            "confidence",
            "decision_score",
            F.substring("question_text", 1, 240).alias("question_excerpt"),
        )
    )


def source_dominance(postings: DataFrame, documents: DataFrame, source: str = "src") -> DataFrame:
    """(feature, dominant_source, source_dominance_ratio) from postings (id, feature, weight).

    A feature's weight in a source is its mean over all documents of the source; the ratio is
    the largest mean over the sum of means. ``documents`` is (id, source).
    """
    sums = postings.join(documents, "id").groupBy("feature", source).agg(F.sum("weight").alias("total"))
    return dominance_of_sums(sums, documents, source)


def dominance_of_sums(sums: DataFrame, documents: DataFrame, source: str = "src") -> DataFrame:
    """:func:`source_dominance` from the postings' weights summed by feature and source (feature, source, total)."""
    sizes = documents.groupBy(source).agg(F.count(F.lit(1)).alias("_docs"))
    means = (
        sums.withColumnRenamed("total", "_sum")
        .join(sizes, source)
        .withColumn("_mean", F.col("_sum") / F.col("_docs"))
    )
    return means.groupBy("feature").agg(
        F.min_by(source, F.struct(-F.round("_mean", 12), F.col(source))).alias("dominant_source"),
        ratio(F.max("_mean"), F.sum("_mean")).alias("source_dominance_ratio"),
    )


def leading_features(weights: DataFrame, top: int, label: str = "subject") -> DataFrame:
    """The ``top`` largest and smallest weights of each label, with their direction and rank."""
    up = Window.partitionBy(label).orderBy(F.desc("coefficient"), "feature")
    down = Window.partitionBy(label).orderBy(F.asc("coefficient"), "feature")
    best = weights.select("*", F.lit("positive").alias("direction"), F.row_number().over(up).alias("rank"))
    worst = weights.select("*", F.lit("negative").alias("direction"), F.row_number().over(down).alias("rank"))
    return best.filter(F.col("rank") <= top).unionByName(worst.filter(F.col("rank") <= top))


def top_features(
    weights: DataFrame,
    top: int = 20,
    dominance: DataFrame | None = None,
    sources: DataFrame | None = None,
    label: str = "subject",
) -> DataFrame:
    """The ``top`` largest and smallest weights (label, feature, coefficient) of each label.

    ``dominance`` comes from :func:`source_dominance`; ``sources`` holds the source names in one
    column. A feature is a possible shortcut when one source has at least 0.8 of its mean weight.
    """
    ranked = leading_features(weights, top, label)
    if dominance is not None:
        ranked = ranked.join(dominance, "feature", "left")
    else:
        ranked = ranked.withColumns(
            {
                "dominant_source": F.lit(None).cast("string"),
                "source_dominance_ratio": F.lit(None).cast("double"),
            }
        )
    if sources is not None:
        name = F.translate(F.lower(F.col(sources.columns[0])), "_-", "  ")
        names = sources.select(name.alias("feature")).distinct().withColumn("_named", F.lit(True))
        ranked = ranked.join(names, "feature", "left")
    else:
        ranked = ranked.withColumn("_named", F.lit(False))
    return ranked.select(
        label,
        "direction",
        F.col("rank").cast("bigint").alias("rank"),
        "feature",
        "coefficient",
        F.coalesce("_named", F.lit(False)).alias("exact_source_name_match"),
        F.coalesce("dominant_source", F.lit("")).alias("dominant_source"),
        "source_dominance_ratio",
        F.coalesce(F.col("source_dominance_ratio") >= 0.8, F.lit(False)).alias("possible_source_shortcut"),
    ).orderBy(label, F.desc("direction"), "rank")
