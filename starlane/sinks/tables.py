"""Typed Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def create_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty table or replace what is there."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def create_table_like(spark: SparkSession, path: str, files: str, multi_line: bool = False) -> None:
    """Create an empty table with the schema found in staged JSON files."""
    from starlane.sources.drift import infer_schema

    create_table(spark, path, infer_schema(spark, files, multi_line))


def truncate_table(spark: SparkSession, path: str) -> None:
    create_table(spark, path, spark.read.parquet(path).schema)


def replace_table(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Overwrite ``path``; ``df`` must not read from it."""
    conform(df, schema).write.mode("overwrite").parquet(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
