"""Word n-gram TF-IDF: sublinear counts, smoothed idf, unit length, learned on training rows only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Normalizer
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgauge.durable import materialize
from corpusgauge.functions.text import token_ngrams, tokens
from corpusgauge.operators.keyed import lookup_join, number_rows


def word_counts(
    df: DataFrame, id: str = "question_id", text: str = "question_text", low: int = 1, high: int = 1
) -> DataFrame:
    """(id, feature, tf) of token n-grams.

    Texts are spread by id before they are cut: the counts, which outweigh them, then stay put.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.select(F.col(id).alias("id"), F.col(text).alias("_text"))
        .repartition(parts, "id")
        .select("id", tokens(F.col("_text")).alias("_units"))
        .select("id", F.explode(token_ngrams(F.col("_units"), low, high)).alias("feature"))
        .groupBy("id", "feature")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def _counts_of(
    df: DataFrame, counts: DataFrame | None, id: str, text: str, low: int, high: int, exact: bool = False
) -> DataFrame:
    if counts is None:
        return word_counts(df, id, text, low, high)
    if exact:  # of these very rows: no join by id, only what it would not keep
        return counts.filter(F.col("id").isNotNull())
    return counts.join(df.select(F.col(id).alias("id")), "id", "left_semi")


def word_weight(tf: Column, documents: Column | int, frequency: Column) -> Column:
    whole = F.lit(documents) if isinstance(documents, int) else documents
    return (1.0 + F.log(tf.cast("double"))) * (F.log((1.0 + whole) / (1.0 + frequency)) + 1.0)


@dataclass
class TfidfModel:
    """The fitted vocabulary (feature, frequency, index), its size, and the training row count.

    Where ``counts`` are given, a stored :func:`word_counts` table of at least the rows asked for,
    their texts are not cut again; ``exact`` says that it is of just these rows.
    """

    vocabulary: DataFrame
    size: int
    documents: int
    low: int
    high: int

    def _weighted(self, counts: DataFrame) -> DataFrame:
        return lookup_join(counts, self.vocabulary, "feature", "frequency").withColumn(
            "_weight", word_weight(F.col("tf"), self.documents, F.col("frequency"))
        )

    def summary(
        self,
        df: DataFrame,
        id: str = "question_id",
        text: str = "question_text",
        counts: DataFrame | None = None,
        exact: bool = False,
    ) -> DataFrame:
        """(id, features, top_weight, weight_sum) of each text's postings, which are not made."""
        counts = _counts_of(df, counts, id, text, self.low, self.high, exact)
        norm = F.sqrt(F.sum(F.col("_weight") * F.col("_weight")))
        return self._weighted(counts).groupBy("id").agg(
            F.count(F.lit(1)).alias("features"),
            (F.max("_weight") / norm).alias("top_weight"),
            (F.sum("_weight") / norm).alias("weight_sum"),
        )

    def postings(
        self,
        df: DataFrame,
        id: str = "question_id",
        text: str = "question_text",
        counts: DataFrame | None = None,
        exact: bool = False,
    ) -> DataFrame:
        """(id, feature, index, weight) with weights of unit length per text."""
        counts = _counts_of(df, counts, id, text, self.low, self.high, exact)
        weighted = self._weighted(counts)
        norms = weighted.groupBy("id").agg(F.sqrt(F.sum(F.col("_weight") * F.col("_weight"))).alias("_norm"))
        return weighted.join(norms, "id").select(
            "id", "feature", "index", (F.col("_weight") / F.col("_norm")).alias("weight")
        )

    def transform(
        self,
        df: DataFrame,
        id: str = "question_id",
        text: str = "question_text",
        output: str = "features",
        counts: DataFrame | None = None,
    ) -> DataFrame:
        """``df`` with a sparse unit vector; texts without known features get the zero vector."""
        counts = _counts_of(df, counts, id, text, self.low, self.high)
        cells = lookup_join(counts, self.vocabulary, "feature", "frequency").select(
            "id",
            F.struct(
                F.col("index").cast("int").alias("index"),
                word_weight(F.col("tf"), self.documents, F.col("frequency")).alias("weight"),
            ).alias("cell"),
        )
        rows = cells.groupBy(F.col("id").alias(id)).agg(F.array_sort(F.collect_list("cell")).alias("_cells"))
        size = self.size
        assemble = F.udf(
            lambda indices, weights: SparseVector(size, indices or [], weights or []), VectorUDT(), useArrow=True
        )
        vectors = df.join(rows, id, "left").withColumn("_raw", assemble("_cells.index", "_cells.weight"))
        return Normalizer(inputCol="_raw", outputCol=output).transform(vectors).drop("_raw", "_cells")


def fit_tfidf(
    df: DataFrame,
    min_df: int = 1,
    low: int = 1,
    high: int = 1,
    id: str = "question_id",
    text: str = "question_text",
    max_features: int | None = None,
    counts: DataFrame | None = None,
    exact: bool = False,
) -> TfidfModel:
    """Vocabulary of features found in at least ``min_df`` rows, numbered in feature order."""
    frequencies = (
        _counts_of(df, counts, id, text, low, high, exact)
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("frequency"))
        .filter(F.col("frequency") >= min_df)
    )
    numbered = materialize(
        number_rows(frequencies, ["feature"], "index").withColumn("index", F.col("index") - 1)
    )
    size = numbered.count()
    if max_features is not None and size > max_features:
        raise ValueError(f"{size} features exceed {max_features}: raise min_df or max_features")
    return TfidfModel(numbered, size, df.count(), low, high)
