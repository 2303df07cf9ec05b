"""From documents to packed training sequences.

The stages, each on the table that the one before wrote:

1. language: texts in no learned language go (no letter, or more bits per byte than raw bytes); a
   missing ``lang`` is filled with the predicted one;
2. exact: of texts equal but for white space, the longest stays, then the least doc_id;
3. near: of each group of near duplicates (five-word shingles, likeness 0.8) the least doc_id stays;
4. secrets: spans that look like secrets are replaced by a mark, and ``n_chars`` follows;
5. packing: the texts become sequences of 2048 tokens; the result has one row per piece.

Defined results: nulls in any column are carried along; a null text has no letter and goes at the
first stage; rows that repeat a doc_id are rows of their own; an empty table gives no rows;
columns beyond those of documents are carried to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.durable import Steps, scratch
from corpusgauge.llm import bound_batches, exact_dedup, language_id, near_dedup, packing, secrets
from corpusgauge.shipping import ship

RAW_BITS = 8.0
#: Row numbers, and entries of their arrays, broadcast at once (about 32 MB as a hash table); more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


#: Bytes of a batch of rows in a worker: stages follow each other in the same workers.
BATCH_BYTES = str(4 << 20)


def _ready(spark: SparkSession) -> None:
    ship(spark)
    bound_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def _numbered(docs: DataFrame, steps: Steps) -> tuple[DataFrame, str]:
    """The documents with a column that tells their rows apart, and that column's name.

    Rows of a table of files are known by their file and their place in it, so nothing is copied
    (files are told apart by 64-bit hashes of their paths); other rows are numbered in a table.
    """
    name = "row_number"
    while name in docs.columns:
        name = "_" + name
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    try:
        return docs.select("*", place.alias(name)), name
    except AnalysisException:  # no table of files
        return steps.keep(docs.withColumn(name, F.monotonically_increasing_id())), name


def _bounded(small: DataFrame, array: str | None = None) -> DataFrame:
    """Broadcast a written table of few rows and few entries of its array column."""
    entries = F.lit(1) if array is None else F.lit(1) + F.size(array)
    return F.broadcast(small) if (small.agg(F.sum(entries)).first()[0] or 0) <= BROADCAST_ROWS else small


def _identity(number: str) -> F.Column:
    """Least doc_id first; rows that repeat one are told apart by their number."""
    return F.struct(F.col("doc_id"), F.col(number).alias("row"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts in no learned language; learned from the labelled documents."""
    _ready(spark)
    labelled = docs.select(F.col("doc_id").alias("id"), "text", "lang").dropna(subset=["text", "lang"])
    model = language_id.train(labelled)
    if model is None:  # no language is known: only texts without letters can be told
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    judged = language_id.predict(docs.select(F.struct("*").alias("doc"), "text"), model)
    known = judged.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("bits_per_byte") <= RAW_BITS))
    columns = [F.col(f"doc.`{name}`") for name in docs.columns]
    columns[docs.columns.index("lang")] = F.coalesce("doc.lang", "lang_pred").alias("lang")
    return known.select(columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of each set of equal texts."""
    _ready(spark)
    steps = Steps(spark)
    rows, number = _numbered(docs, steps)
    with scratch():
        marked = exact_dedup.deduplicate_once(rows.select(_identity(number).alias("id"), "text"), "id", "text")
        kept = steps.keep(marked.filter("kept").select(F.col("id.row").alias(number)))
    return rows.join(_bounded(kept), number, "left_semi").drop(number)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of each group of near duplicates."""
    _ready(spark)
    steps = Steps(spark)
    rows, number = _numbered(docs, steps)
    with scratch():
        grouped = near_dedup.group(rows.select(_identity(number).alias("id"), "text"), 5, 80, "id", "text")
        kept = steps.keep(grouped.filter("kept").select(F.col("id.row").alias(number)))
    return rows.join(_bounded(kept), number, "left_semi").drop(number)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark."""
    _ready(spark)
    steps = Steps(spark)
    rows, number = _numbered(docs, steps)
    with scratch():
        scanned = secrets.scan(rows.select(F.col(number).alias("id"), "text"), "id", "text")
        found = scanned.filter(F.size("spans") > 0)
        hits = steps.keep(found.select(F.col("id").alias(number), F.col("spans").alias("found")))
    whole = rows.select(number, F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc"))
    joined = whole.join(_bounded(hits, "found"), number, "left")
    text = F.when(F.col("found").isNull(), F.col("doc.text")).otherwise(secrets.redact(F.col("doc.text"), F.col("found")))
    joined = joined.withColumn("shown", text)
    columns = [F.col(f"doc.`{name}`") for name in docs.columns]
    columns[docs.columns.index("text")] = F.col("shown").alias("text")
    if "n_chars" in docs.columns:
        length = F.when(F.col("found").isNull(), F.col("doc.n_chars")).otherwise(F.length("shown"))
        columns[docs.columns.index("n_chars")] = length.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return joined.select(columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    _ready(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("exact duplicates", exact),
    ("near duplicates", near),
    ("secrets", redact),
    ("packing", pack),
]

# Language models and signatures cannot be stated in SQL; tests/llm/test_pipeline.py checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; all but the last are written and read again.

    A stage's step tables and its input go once its output is written.
    """
    steps = Steps(spark)
    docs, source = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        with scratch():
            docs = steps.keep(stage(spark, docs, sf_dir))
        if source is not None:
            steps.drop(source)
        source = docs
    return STAGES[-1][1](spark, docs, sf_dir)
