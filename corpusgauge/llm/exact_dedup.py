"""Exact duplicates through a persistent digest index, in DataFrame operations only.

The index is a table bucketed and sorted by digest. A batch is cut down to one row per digest,
anti-joined with the index by sort-merge (the index side is not shuffled), and what is new is
appended to it. A whole table goes through the index in batches from long to short texts, so of
equal texts the first that the index meets is the one that stays.

Defined results: null text counts as empty, so null, empty and white-space-only texts are equal;
a null id is the smallest id; rows that repeat an id are rows of their own and are counted in
``group_size``, and all of them are kept if the id is the one that stays; an empty batch gives no
rows and leaves the index as it is. Other columns of the input are never read, so their names
cannot clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.durable import Steps
from corpusgauge.operators.keyed import lookup_join

# The characters of [\x20\x09-\x0D].
WHITE_SPACE = " \t\n\x0b\x0c\r"
ROWS_PER_BUCKET = 2_000_000
#: Digests broadcast at once; 100,000 of them take about 25 MB.
BROADCAST_DIGESTS = 100_000
#: Batches in which a whole table meets its index.
BATCHES = 2


def text_digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8 without white space."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, ""), 256)


class DigestIndex:
    """Digests seen so far and the id that stays for each.

    ``name`` is a table of the session's catalog; with ``path`` its files lie there, otherwise in
    the warehouse. ``buckets`` is fixed when the table is made.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int, path: str | None = None) -> None:
        self.spark, self.name, self.buckets, self.path = spark, name, buckets, path

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def new_only(self, groups: DataFrame) -> DataFrame:
        """The groups whose digest the index lacks."""
        if not self.exists():
            return groups
        known = self.spark.table(self.name).select("digest")
        return groups.join(known.hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        """Append (digest, keep_id) of new groups; one file per bucket."""
        writer = (
            groups.select("digest", "keep_id")
            .repartition(self.buckets, "digest")
            .write.format("parquet")
            .mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
        )
        if self.path:
            writer = writer.option("path", self.path)
        writer.saveAsTable(self.name)

    def keepers(self, groups: DataFrame) -> DataFrame:
        """The groups with the id that the index keeps for their digest."""
        known = self.spark.table(self.name).hint("merge")
        return groups.drop("keep_id").join(known, "digest")

    def forget(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def deduplicate(
    index: DigestIndex, docs: DataFrame, steps: Steps, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Of equal texts in a batch, the one with the most code points in its original form stays, then
    the least id. A text that the index knows from an earlier batch keeps that batch's id.
    ``group_size`` counts the rows of this batch.
    """
    rows = _digests(docs, steps, id_col, text_col)
    groups = _groups(rows, steps)
    index.append(index.new_only(groups))
    return _marked(rows, steps.keep(index.keepers(groups)), id_col)


def _digests(docs: DataFrame, steps: Steps, id_col: str, text_col: str) -> DataFrame:
    """(id, digest, n_chars) of each row."""
    return steps.keep(
        docs.select(
            F.col(id_col).alias("id"),
            text_digest(F.col(text_col)).alias("digest"),
            F.coalesce(F.length(text_col), F.lit(0)).alias("n_chars"),
        )
    )


def _groups(rows: DataFrame, steps: Steps) -> DataFrame:
    """(digest, keep_id, group_size): of each digest the row that stays, by a partial aggregate."""
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), "id"))
    grouped = rows.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    return steps.keep(grouped.select("digest", F.col("best.id").alias("keep_id"), "group_size"))


def _marked(rows: DataFrame, kept: DataFrame, id_col: str) -> DataFrame:
    # The digest of a hot group is broadcast, never shuffled.
    return lookup_join(rows.select("id", "digest"), kept, "digest", "group_size", BROADCAST_DIGESTS).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def fresh_index(spark: SparkSession, steps: Steps, n_rows: int) -> DigestIndex:
    """An empty index in the run's shared folder, with a bucket for every two million rows."""
    buckets = max(16, -(-n_rows // ROWS_PER_BUCKET))
    return DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}", buckets, steps.path("index"))


def deduplicate_once(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """One row per row of a whole table, as ``deduplicate``, with ``group_size`` over the table.

    The table meets an empty index in ``batches`` of about equal numbers of rows, longest originals
    first: a row of a later batch is shorter than all of the earlier ones, so the id that the index
    has is the one that stays.
    """
    spark = docs.sparkSession
    steps = Steps(spark)
    rows = _digests(docs, steps, id_col, text_col)
    shares = [1 - at / batches for at in range(1, batches)]
    n_rows, cuts = rows.agg(F.count(F.lit(1)), F.percentile_approx("n_chars", shares) if shares else F.array()).first()
    index = fresh_index(spark, steps, n_rows)
    limits = [None, *(cuts or []), None]
    sizes = None
    for below, least in zip(limits, limits[1:]):
        inside = F.lit(True)
        inside = inside if below is None else inside & (F.col("n_chars") < below)
        inside = inside if least is None else inside & (F.col("n_chars") >= least)
        groups = _groups(rows.filter(inside), steps)
        index.append(index.new_only(groups))
        part = groups.select("digest", "group_size")
        sizes = part if sizes is None else sizes.unionByName(part)
    totals = sizes.groupBy("digest").agg(F.sum("group_size").alias("group_size"))
    result = _marked(rows, steps.keep(index.keepers(totals)), id_col)
    index.forget()
    return result
