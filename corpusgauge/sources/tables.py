"""Reading and writing tables, and the checks made at that boundary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgauge.operators.keyed import number_rows
from corpusgauge.sources.csv_records import csv_records


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header; quotes are doubled and a value may span lines. Large files are split."""
    options = {
        "escape": '"',
        # A record is parsed alone, and it holds line ends only inside of values.
        "multiLine": "true",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    kind = schema if isinstance(schema, str) else schema.toDDL()
    return csv_records(spark, path).select(F.from_csv("record", kind, options).alias("row")).select("row.*")


def read_csv_whole(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The same by Spark's own reader, which takes each file in one task."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_json_document(
    spark: SparkSession, path: str, schema: T.StructType | str
) -> DataFrame:
    """One JSON document per file, as written for manifests and metrics."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header, doubled quotes; nested columns become JSON text first."""
    flat = [
        F.to_json(field.name).alias(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
        else F.col(field.name)
        for field in df.schema.fields
    ]
    (
        df.select(*flat)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def require_columns(df: DataFrame, required: Sequence[str], what: str = "table") -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks required columns: {missing}")
    return df


def with_surrogate_key(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    return number_rows(df, order, name)


def translate_keys(
    df: DataFrame, keys: DataFrame, external: str, local: str, shown: int = 20
) -> DataFrame:
    """Replace ``external`` by ``local`` through ``keys``; unknown external keys raise.

    ``shown`` bounds the keys named in the message only.
    """
    mapping = keys.select(external, local)
    unknown = df.join(mapping, external, "left_anti").select(external).distinct()
    found = [row[0] for row in unknown.orderBy(external).limit(shown).collect()]
    if found:
        raise ValueError(f"rows reference unknown {external}: {found}")
    return df.join(mapping, external).drop(external)
