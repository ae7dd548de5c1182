"""Readers. Schemas are given, not inferred, wherever the format does not carry one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.rollup import TRACE_SCHEMA

CORPUS_SCHEMA = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("is_attack", T.BooleanType()),
        T.StructField("source", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = CORPUS_SCHEMA, text: str = "text") -> DataFrame:
    """CSV with a header, quoted line breaks and doubled quotes; rows without a text are dropped."""
    rows = spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"')
    return rows.na.drop(subset=[text])


def read_traces(spark: SparkSession, path: str) -> DataFrame:
    """Nested trace documents, one JSON object per line."""
    return spark.read.schema(TRACE_SCHEMA).json(path)


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """``(file_name, content)``, one row per file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("content")
    )


def read_vectors(spark: SparkSession, path: str, key: str, vector: str) -> DataFrame:
    """Vectors by key; rows are matched by the key, never by position."""
    return spark.read.parquet(path).select(key, F.col(vector).cast("array<float>").alias(vector))
