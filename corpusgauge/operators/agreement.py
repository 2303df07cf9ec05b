"""Annotations of several people: agreement, disputed items, intents, and the routing gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Least macro-F1 of green and yellow, least recall of green.
GREEN_F1, YELLOW_F1, GREEN_RECALL = 0.80, 0.65, 0.70
LOW_CONFIDENCE = 1


def agreement(
    notes: DataFrame, item: str = "question_id", annotator: str = "annotator_id", label: str = "intent_label"
) -> DataFrame:
    """(first_annotator, second_annotator, items, raw_agreement, kappa) of annotators with common items.

    The items' labels are gathered per item (one per annotator), and only counts of label pairs go
    on. Cohen's kappa is NULL where chance alone would agree always. NULL labels take no part.
    """
    held = notes.filter(F.col(label).isNotNull()).groupBy(item).agg(
        F.sort_array(F.collect_set(F.struct(F.col(annotator).alias("who"), F.col(label).alias("what")))).alias("own")
    )
    pairs = F.flatten(
        F.transform(
            "own",
            lambda x: F.transform(
                F.filter("own", lambda y: y["who"] > x["who"]),
                lambda y: F.struct(x["who"].alias("a"), y["who"].alias("b"), x["what"].alias("x"), y["what"].alias("y")),
            ),
        )
    )
    cells = held.select(F.inline(pairs)).groupBy("a", "b", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    totals = cells.groupBy("a", "b").agg(
        F.sum("n").alias("items"),
        F.coalesce(F.sum(F.when(F.col("x") == F.col("y"), F.col("n"))), F.lit(0)).alias("same"),
    )
    left = cells.groupBy("a", "b", F.col("x").alias("label")).agg(F.sum("n").alias("l"))
    right = cells.groupBy("a", "b", F.col("y").alias("label")).agg(F.sum("n").alias("r"))
    chance = left.join(right, ["a", "b", "label"]).groupBy("a", "b").agg(F.sum(F.col("l") * F.col("r")).alias("products"))
    share = F.col("same") / F.col("items")
    by_chance = F.coalesce("products", F.lit(0)) / (F.col("items") * F.col("items"))
    return totals.join(chance, ["a", "b"], "left").select(
        F.col("a").alias("first_annotator"),
        F.col("b").alias("second_annotator"),
        "items",
        share.alias("raw_agreement"),
        F.when(by_chance < 1, (share - by_chance) / (1 - by_chance)).alias("kappa"),
    )


def intents_by_subject(
    notes: DataFrame, questions: DataFrame, item: str = "question_id", label: str = "intent_label", subject: str = "category"
) -> DataFrame:
    """(subject, intent_label, n, share of the subject's annotations)."""
    counts = (
        notes.filter(F.col(label).isNotNull())
        .join(questions.select(item, F.col(subject).alias("subject")), item)
        .groupBy("subject", F.col(label).alias("intent_label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy("subject").agg(F.sum("n").alias("_all"))
    return counts.join(totals, "subject").select("subject", "intent_label", "n", (F.col("n") / F.col("_all")).alias("share"))


def disputed(
    notes: DataFrame, item: str = "question_id", label: str = "intent_label", confidence: str = "confidence"
) -> DataFrame:
    """(item, labels, least_confidence, reason) of items with different labels or a low confidence."""
    held = notes.groupBy(item).agg(F.countDistinct(label).alias("labels"), F.min(confidence).alias("least_confidence"))
    several, unsure = F.col("labels") > 1, F.coalesce(F.col("least_confidence") <= LOW_CONFIDENCE, F.lit(False))
    reason = F.when(several & unsure, "both").when(several, "disagreement").otherwise("low_confidence")
    return held.filter(several | unsure).withColumn("reason", reason)


def gate(summary: DataFrame, per_class: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by…, macro_f1, least_recall, gate): green, yellow or red routing from the test scores."""
    least = per_class.withColumn("_all", F.lit(1)).groupBy("_all", *by).agg(F.min("recall").alias("least_recall"))
    color = (
        F.when(F.col("macro_f1") < YELLOW_F1, "red")
        .when((F.col("macro_f1") >= GREEN_F1) & (F.col("least_recall") >= GREEN_RECALL), "green")
        .otherwise("yellow")
    )
    joined = summary.withColumn("_all", F.lit(1)).join(least, ["_all", *by])
    return joined.select(*by, "macro_f1", "least_recall", color.alias("gate"))
