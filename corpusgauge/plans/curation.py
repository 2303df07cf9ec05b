"""Queries that profile, validate, split and sample the labelled text table."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.durable import ensure_checkpoint_dir
from corpusgauge.functions.text import normalize_text
from corpusgauge.operators import reports, split, validate
from corpusgauge.operators.keyed import keep_first
from corpusgauge.plans import views
from corpusgauge.plans.registry import query
from corpusgauge.plans.views import DIRTY_SQL, LABELS, QUESTIONS_SQL, SRC_SQL
from corpusgauge.sources import tables

LABEL_ORDER_SQL = "CASE category WHEN 'en' THEN 1 WHEN 'fr' THEN 2 WHEN 'de' THEN 3 WHEN 'es' THEN 4 ELSE 5 END"


@query(
    "select_labels",
    f"""WITH {SRC_SQL}
    SELECT question_id, category, src, CAST(length(question) AS BIGINT) AS n_chars
    FROM src WHERE category IN ('en', 'fr') ORDER BY question_id""",
)
def select_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = validate.select_labels(views.src(spark, sf_dir), ["en", "fr"])
    return chosen.select(
        "question_id", "category", "src", F.length("question").cast("bigint").alias("n_chars")
    )


@query(
    "label_profile",
    """SELECT CASE WHEN GROUPING(lang) = 1 THEN 'all' ELSE 'label' END AS scope, lang AS label,
              COUNT(*) AS "rows"
       FROM documents GROUP BY ROLLUP (lang)""",
)
def label_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.label_profile(views.src(spark, sf_dir))


@query(
    "label_distribution",
    """SELECT lang AS subject, COUNT(*) AS record_count,
              ROUND(CAST(100.0 AS DOUBLE) * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS percentage
       FROM documents GROUP BY lang""",
)
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.label_distribution(views.src(spark, sf_dir), LABELS)


@query(
    "label_source_distribution",
    """SELECT lang AS subject, source AS source_name, COUNT(*) AS record_count
       FROM documents GROUP BY lang, source ORDER BY subject, record_count DESC, source_name""",
)
def label_source_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.label_source_distribution(views.src(spark, sf_dir))


@query(
    "data_quality",
    f"""WITH {DIRTY_SQL}
    SELECT COUNT(*) AS total_records,
           CAST(SUM(CASE WHEN trim(question) = '' THEN 1 ELSE 0 END) AS BIGINT) AS empty_questions,
           CAST(SUM(CASE WHEN trim(src) = '' THEN 1 ELSE 0 END) AS BIGINT) AS missing_sources,
           COUNT(*) - COUNT(DISTINCT question_id) AS duplicate_source_ids
    FROM dirty""",
)
def data_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.data_quality(views.dirty(spark, sf_dir).withColumnRenamed("question", "question_text"))


@query(
    "text_length_summary",
    """SELECT lang AS subject, COUNT(*) AS n, ROUND(AVG(length(text)), 2) AS mean_length,
              CAST(MIN(length(text)) AS BIGINT) AS min_length, CAST(MAX(length(text)) AS BIGINT) AS max_length
       FROM documents GROUP BY lang ORDER BY lang""",
)
def text_length_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = views.src(spark, sf_dir).withColumn("text_length", F.length("question"))
    return reports.text_length_summary(sized)


@query(
    "split_integrity",
    f"""WITH {QUESTIONS_SQL}
    SELECT split_name, category AS subject, COUNT(*) AS record_count,
           COUNT(DISTINCT duplicate_group_id) AS duplicate_groups
    FROM questions GROUP BY split_name, category""",
)
def split_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.split_integrity(views.questions(spark, sf_dir))


@query(
    "crossing_groups",
    f"""WITH {QUESTIONS_SQL}, moved AS (
      SELECT duplicate_group_id, CASE WHEN question_id % 5 = 0 THEN 'test' ELSE 'development' END AS split_name
      FROM questions)
    SELECT duplicate_group_id, MIN(split_name) AS first_split, MAX(split_name) AS last_split, COUNT(*) AS n
    FROM moved GROUP BY duplicate_group_id HAVING COUNT(DISTINCT split_name) > 1""",
)
def crossing_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split by row instead of by group, so that groups do cross."""
    moved = views.questions(spark, sf_dir).withColumn(
        "split_name", F.when(F.col("question_id") % 5 == 0, "test").otherwise("development")
    )
    return reports.crossing_groups(moved)


@query(
    "top_sources_matrix",
    f"""WITH {SRC_SQL}, totals AS (
      SELECT src, COUNT(*) AS total FROM src GROUP BY src ORDER BY total DESC, src LIMIT 12
    ), shown AS (
      SELECT category AS subject, CASE WHEN src IN (SELECT src FROM totals) THEN src ELSE 'Other sources' END AS s
      FROM src)
    SELECT l.subject, b.s AS source_name, COUNT(shown.s) AS n
    FROM (SELECT DISTINCT subject FROM shown) l CROSS JOIN (SELECT DISTINCT s FROM shown) b
    LEFT JOIN shown ON shown.subject = l.subject AND shown.s = b.s GROUP BY ALL""",
)
def top_sources_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix in its long form: one row per label and source shown."""
    wide = reports.top_sources_matrix(views.src(spark, sf_dir), LABELS)
    return wide.unpivot("subject", [c for c in wide.columns if c != "subject"], "source_name", "n")


NORMALIZED = (
    r"trim(regexp_replace(nfc_normalize({0}), '[\x09-\x0D\x1C-\x20\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}"
    r"\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+', ' ', 'g'))"
)


@query(
    "normalized_text",
    "SELECT page_id, md5(t) AS text_md5, CAST(length(t) AS BIGINT) AS text_length FROM (SELECT page_id, "
    + NORMALIZED.format("html")
    + " AS t FROM pages)",
)
def normalized_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = views.table(spark, sf_dir, "pages").select("page_id", normalize_text(F.col("html")).alias("t"))
    return text.select(
        "page_id", F.md5("t").alias("text_md5"), F.length("t").cast("bigint").alias("text_length")
    )


ANNOTATED_SQL = (
    f"""{DIRTY_SQL}, normal AS (
  SELECT *, """
    + NORMALIZED.format("coalesce(question, '')")
    + """ AS question_text FROM dirty
), marked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY question_id ORDER BY row_key) AS id_turn,
         ROW_NUMBER() OVER (PARTITION BY question_text ORDER BY row_key) AS text_turn
  FROM normal
), annotated AS (
  SELECT *, CASE WHEN question_text = '' THEN 'empty_question'
                 WHEN category IS NULL OR category NOT IN ('en', 'fr', 'de', 'es') THEN 'invalid_subject'
                 WHEN id_turn > 1 THEN 'duplicate_question_id'
                 WHEN src IS NULL OR trim(src) = '' THEN 'missing_source'
                 WHEN text_turn > 1 THEN 'exact_duplicate' END AS exclusion_reason
  FROM marked
)"""
)


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.annotate_rows(views.dirty(spark, sf_dir), LABELS, "row_key")


@query(
    "validated_rows",
    f"""WITH {ANNOTATED_SQL}
    SELECT row_key, question_id, category, src, md5(question_text) AS text_md5,
           CAST(length(question_text) AS BIGINT) AS text_length
    FROM annotated WHERE exclusion_reason IS NULL""",
)
def validated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.clean_rows(annotated(spark, sf_dir)).select(
        "row_key", "question_id", "category", "src", F.md5("question_text").alias("text_md5"), "text_length"
    )


@query(
    "exclusion_register",
    f"""WITH {ANNOTATED_SQL}
    SELECT row_key, question_id, category, src, exclusion_reason FROM annotated
    WHERE exclusion_reason IS NOT NULL""",
)
def exclusion_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.excluded_rows(annotated(spark, sf_dir)).select(
        "row_key", "question_id", "category", "src", "exclusion_reason"
    )


@query(
    "validation_profile",
    f"""WITH {ANNOTATED_SQL}
    SELECT 'rows' AS scope, 'source' AS key, COUNT(*) AS "rows" FROM annotated
    UNION ALL SELECT 'rows', CASE WHEN exclusion_reason IS NULL THEN 'clean' ELSE 'excluded' END, COUNT(*)
      FROM annotated GROUP BY 2
    UNION ALL SELECT 'label', category, COUNT(*) FROM annotated WHERE exclusion_reason IS NULL GROUP BY 2
    UNION ALL SELECT 'reason', exclusion_reason, COUNT(*) FROM annotated
      WHERE exclusion_reason IS NOT NULL GROUP BY 2""",
)
def validation_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validation_profile(annotated(spark, sf_dir))


@query(
    "split_profile",
    f"""WITH {ANNOTATED_SQL}, placed AS (
      SELECT *, CASE WHEN row_key % 5 = 0 THEN 'test' ELSE 'development' END AS split_name, row_key // 3 AS group_id FROM annotated
    ), groups AS (
      SELECT group_id, MIN(split_name) <> MAX(split_name) AS crossing FROM placed WHERE exclusion_reason IS NULL GROUP BY group_id)
    SELECT 'rows' AS scope, 'source' AS key, COUNT(*) AS "rows" FROM placed
    UNION ALL SELECT 'rows', CASE WHEN exclusion_reason IS NULL THEN 'clean' ELSE 'excluded' END, COUNT(*) FROM placed GROUP BY 2
    UNION ALL SELECT 'label', category, COUNT(*) FROM placed WHERE exclusion_reason IS NULL GROUP BY 2
    UNION ALL SELECT 'reason', exclusion_reason, COUNT(*) FROM placed WHERE exclusion_reason IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'split', split_name, COUNT(*) FROM placed WHERE exclusion_reason IS NULL GROUP BY 2
    UNION ALL SELECT 'groups', 'all', COUNT(*) FROM groups
    UNION ALL SELECT 'groups', 'crossing', COUNT(*) FILTER (crossing) FROM groups""",
)
def split_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of a split by row, whose groups of three neighbours may cross it."""
    rows = annotated(spark, sf_dir).withColumns(
        {
            "split_name": F.when(F.col("row_key") % 5 == 0, "test").otherwise("development"),
            "group_id": F.floor(F.col("row_key") / 3),
        }
    )
    return validate.validation_profile(rows, split="split_name", group="group_id")


@query(
    "keep_first_text",
    """SELECT doc_id, ROW_NUMBER() OVER (PARTITION BY text ORDER BY doc_id) = 1 AS is_first FROM documents""",
)
def keep_first_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = views.table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return keep_first(keys, "digest", "doc_id", "is_first").select("doc_id", "is_first")


@query(
    "constraint_report",
    f"""WITH {DIRTY_SQL}, orphan AS (
      SELECT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'))
    SELECT 'question_id not null' AS rule, COUNT(*) FILTER (question_id IS NULL) AS violations FROM dirty
    UNION ALL SELECT 'src not blank', COUNT(*) FILTER (NOT coalesce(length(trim(src)) > 0, FALSE)) FROM dirty
    UNION ALL SELECT 'category in allowed set',
      COUNT(*) FILTER (NOT coalesce(category IN ('en', 'fr', 'de', 'es'), FALSE)) FROM dirty
    UNION ALL SELECT 'row_key at least 1', COUNT(*) FILTER (NOT coalesce(row_key >= 1, FALSE)) FROM dirty
    UNION ALL SELECT 'question_id unique', COUNT(*) FROM (
      SELECT question_id FROM dirty GROUP BY question_id HAVING COUNT(*) > 1)
    UNION ALL SELECT 'l_orderkey, l_linenumber unique', COUNT(*) FROM (
      SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
    UNION ALL SELECT 'l_orderkey references o_orderkey', COUNT(*) FROM orphan""",
)
def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.dirty(spark, sf_dir)
    lines = views.table(spark, sf_dir, "lineitem")
    open_orders = views.table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    report = validate.check_rules(
        rows,
        [
            validate.not_null("question_id"),
            validate.not_blank("src"),
            validate.one_of("category", LABELS),
            validate.at_least("row_key", 1),
        ],
    )
    return (
        report.unionByName(validate.check_unique(rows, "question_id"))
        .unionByName(validate.check_unique(lines, "l_orderkey", "l_linenumber"))
        .unionByName(validate.check_reference(lines, "l_orderkey", open_orders, "o_orderkey"))
    )


@query(
    "dataset_fingerprint",
    f"""WITH {QUESTIONS_SQL}, hashed AS (
      SELECT sha256(question_text || chr(31) || category || chr(31) || duplicate_group_id) AS h
      FROM questions WHERE split_name = 'development'
    ), summed AS (
      SELECT COUNT(*) AS n, {", ".join(
          f"SUM(CAST('0x' || substr(h, {1 + 8 * at}, 8) AS BIGINT)) AS s{at}" for at in range(8))}
      FROM hashed)
    SELECT n AS "rows", sha256(concat_ws(':', n, {", ".join(f"s{at}" for at in range(8))})) AS fingerprint
    FROM summed""",
)
def dataset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    development = views.questions(spark, sf_dir).filter("split_name = 'development'")
    return validate.fingerprint(development, ["question_text", "category", "duplicate_group_id"])


@query(
    "training_columns",
    f"""WITH {QUESTIONS_SQL}
    SELECT question_id, question_text, category, duplicate_group_id FROM questions""",
)
def training_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.training_columns(views.questions(spark, sf_dir))


FOLDS_SQL = f"""{QUESTIONS_SQL}, label_counts AS (
  SELECT duplicate_group_id, category, COUNT(*) AS n FROM questions GROUP BY 1, 2
), label_turns AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY duplicate_group_id ORDER BY n DESC, {LABEL_ORDER_SQL}) AS turn,
         CAST(SUM(n) OVER (PARTITION BY duplicate_group_id) AS BIGINT) AS size
  FROM label_counts
), ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY category
           ORDER BY size DESC, md5('42:' || duplicate_group_id), duplicate_group_id) - 1 AS place
  FROM label_turns WHERE turn = 1
), folds AS (
  SELECT duplicate_group_id,
         CASE WHEN place % (2 * {{k}}) < {{k}} THEN place % (2 * {{k}})
              ELSE 2 * {{k}} - 1 - place % (2 * {{k}}) END AS fold
  FROM ranked
)"""


@query(
    "group_folds",
    f"WITH {FOLDS_SQL.format(k=5)} SELECT question_id, category, fold FROM questions JOIN folds USING (duplicate_group_id)",
)
def group_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.questions(spark, sf_dir).select("question_id", "category", "duplicate_group_id")
    return split.assign_folds(rows, LABELS, 5).select("question_id", "category", "fold")


@query(
    "project_split",
    f"""WITH {FOLDS_SQL.format(k=7)}
    SELECT question_id, duplicate_group_id, CASE WHEN fold = 0 THEN 'test' ELSE 'development' END AS split_name
    FROM questions JOIN folds USING (duplicate_group_id)""",
)
def project_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.questions(spark, sf_dir).select("question_id", "category", "duplicate_group_id")
    return split.assign_split(rows, LABELS).select("question_id", "duplicate_group_id", "split_name")


@query(
    "group_subset",
    f"""WITH {QUESTIONS_SQL}, pairs AS (SELECT DISTINCT duplicate_group_id, category FROM questions
    ), ranked AS (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY md5('42:0:' || duplicate_group_id), duplicate_group_id) AS place,
             COUNT(*) OVER (PARTITION BY category) AS groups
      FROM pairs)
    SELECT question_id, category FROM questions WHERE duplicate_group_id IN (
      SELECT duplicate_group_id FROM ranked
      WHERE place <= greatest(1, CAST(round_even(groups * CAST(0.4 AS DOUBLE), 0) AS BIGINT)))""",
)
def group_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.questions(spark, sf_dir).select("question_id", "category", "duplicate_group_id")
    return split.group_subset(rows, 0.4, "42:0").select("question_id", "category")


SAMPLE_SQL = """sample AS (
  SELECT doc_id AS question_id, lang AS subject, text AS question_text, '' AS annotator_id, '' AS intent_label,
         CAST(NULL AS INTEGER) AS confidence, '' AS notes
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS place FROM documents)
  WHERE place <= 10
)"""


@query("annotation_sample", f"WITH {SAMPLE_SQL} SELECT * FROM sample")
def annotation_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.src(spark, sf_dir).withColumnRenamed("question", "question_text")
    return split.balanced_sample(rows, 10)


def conversation_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as a filled annotation sheet: roles stand for labels, turns for scores."""
    turn = F.col("turn")
    return views.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("question_id"),
        F.lit("any").alias("subject"),
        F.col("text").alias("question_text"),
        F.when(turn % 5 == 4, " ").otherwise(F.concat(F.lit("a"), (turn % 2).cast("string"))).alias("annotator_id"),
        F.when(F.col("role") == "user", "conceptual_explanation").otherwise(F.col("role")).alias("intent_label"),
        F.when(turn % 7 == 6, "high").otherwise((turn % 3 + 1).cast("string")).alias("confidence"),
        F.lit("").alias("notes"),
    )


SHEET_SQL = """sheet AS (
  SELECT conv_id AS question_id, 'any' AS subject, text AS question_text,
         CASE WHEN turn % 5 = 4 THEN ' ' ELSE 'a' || (turn % 2) END AS annotator_id,
         CASE WHEN role = 'user' THEN 'conceptual_explanation' ELSE role END AS intent_label,
         CASE WHEN turn % 7 = 6 THEN 'high' ELSE CAST(turn % 3 + 1 AS VARCHAR) END AS confidence, '' AS notes
  FROM conversations
)"""
INTENTS_SQL = ", ".join(f"'{name}'" for name in split.INTENTS)
SHEET_ERRORS_SQL = f"""errors AS (
  SELECT DISTINCT 'unknown intent labels' AS error, intent_label AS detail FROM sheet
  WHERE intent_label IS NOT NULL AND intent_label NOT IN ({INTENTS_SQL})
  UNION ALL SELECT 'annotator_id must be non-empty', NULL FROM sheet HAVING bool_or(trim(annotator_id) = '')
  UNION ALL SELECT 'confidence must be an integer from 1 to 3', NULL FROM sheet
    HAVING bool_or(NOT coalesce(TRY_CAST(confidence AS DOUBLE) BETWEEN 1 AND 3, FALSE))
  UNION ALL SELECT DISTINCT 'question_id and annotator_id pairs must be unique', NULL FROM sheet
    GROUP BY question_id, annotator_id HAVING COUNT(*) > 1
)"""


@query("annotation_errors", f"WITH {SHEET_SQL}, {SHEET_ERRORS_SQL} SELECT * FROM errors")
def annotation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.annotation_errors(conversation_sheet(spark, sf_dir))


@query(
    "annotation_summary",
    f"""WITH {SHEET_SQL}, {SHEET_ERRORS_SQL}
    SELECT (SELECT COUNT(*) = 0 FROM errors) AS valid, (SELECT COUNT(*) FROM sheet) AS "rows",
           (SELECT COUNT(*) FROM (SELECT question_id FROM sheet GROUP BY 1 HAVING COUNT(*) >= 2))
             AS agreement_ready_questions,
           FALSE AS human_annotation_completed""",
)
def annotation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.annotation_summary(conversation_sheet(spark, sf_dir))


@query(
    "unknown_labels",
    f"""WITH {SHEET_SQL} SELECT DISTINCT intent_label FROM sheet
    WHERE intent_label NOT IN ({INTENTS_SQL})""",
)
def unknown_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.unknown_labels(conversation_sheet(spark, sf_dir))


@query(
    "surrogate_keys",
    """SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS question_id FROM orders""",
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    keyed = tables.with_surrogate_key(orders, ["o_orderdate", "o_orderkey"], "question_id")
    return keyed.select("o_orderkey", "question_id")


@query(
    "translated_keys",
    """SELECT l_linenumber, l_quantity, k.local_id FROM lineitem JOIN (
         SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS local_id FROM orders) k
       ON l_orderkey = k.o_orderkey""",
)
def translated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("external_id"))
    keys = tables.with_surrogate_key(orders, ["external_id"], "local_id")
    lines = views.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("external_id"), "l_linenumber", "l_quantity"
    )
    return tables.translate_keys(lines, keys, "external_id", "local_id")


def scratch(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which every executor can reach."""
    base = ensure_checkpoint_dir(spark)
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="tables-", dir=base.removeprefix("file:"))
    return f"{base}/tables-{spark.sparkContext.applicationId}-{spark.range(1).select(F.uuid()).first()[0]}"


@query(
    "parquet_round_trip",
    "SELECT split_name, question_id, category FROM (WITH " + QUESTIONS_SQL + " SELECT * FROM questions)",
)
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The controlled table written by split and read back."""
    path = scratch(spark) + "/questions"
    rows = views.questions(spark, sf_dir).select("question_id", "category", "split_name")
    tables.write_parquet(rows, path, ["split_name"])
    return tables.read_parquet(spark, path, "question_id long, category string, split_name string")


@query(
    "csv_round_trip",
    f"""WITH {ANNOTATED_SQL}
    SELECT row_key, category, md5(question) AS text_md5, exclusion_reason FROM annotated
    WHERE exclusion_reason IS NOT NULL""",
)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exclusion register, whole texts with line breaks and quotes, through CSV."""
    path = scratch(spark) + "/exclusions"
    register = validate.excluded_rows(annotated(spark, sf_dir)).select(
        "row_key", "category", "question", "exclusion_reason"
    )
    tables.write_csv(register, path)
    back = tables.read_csv(
        spark, path, "row_key long, category string, question string, exclusion_reason string"
    )
    return back.select("row_key", "category", F.md5("question").alias("text_md5"), "exclusion_reason")
