"""Schema of files as found, against the schema declared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def infer_schema(spark: SparkSession, path: str, multi_line: bool = False) -> T.StructType:
    """The schema of all JSON objects under ``path``."""
    return spark.read.option("multiLine", multi_line).json(path).schema


def leaves(schema: T.StructType, prefix: str = "") -> dict[str, str]:
    """Dotted path -> type name of every scalar field."""
    found = {}
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            found |= leaves(field.dataType, f"{prefix}{field.name}.")
        else:
            found[prefix + field.name] = field.dataType.simpleString()
    return found


def _status(declared: str | None, found: str | None) -> str:
    if found is None:
        return "missing"
    if declared is None:
        return "added"
    # JSON has one whole-number type, so a declared int is found as a bigint.
    return "same" if found == declared or (declared, found) == ("int", "bigint") else "retyped"


def drift_report(
    spark: SparkSession, path: str, declared: T.StructType, multi_line: bool = False
) -> DataFrame:
    """One line per field of either schema, with the number of rows that carry it."""
    inferred = infer_schema(spark, path, multi_line)
    expected, actual = leaves(declared), leaves(inferred)
    rows = spark.read.schema(inferred).option("multiLine", multi_line).json(path)
    names = sorted(expected.keys() | actual.keys())
    present = rows.agg(*[
        (F.count(F.col(n)) if n in actual else F.lit(0).cast("long")).alias(f"n{i}")
        for i, n in enumerate(names)
    ])
    lines = [
        F.struct(
            F.lit(n).alias("field"),
            F.lit(expected.get(n)).cast("string").alias("declared_type"),
            F.lit(actual.get(n)).cast("string").alias("found_type"),
            F.lit(_status(expected.get(n), actual.get(n))).alias("status"),
            F.col(f"n{i}").alias("present_rows"),
        )
        for i, n in enumerate(names)
    ]
    return present.select(F.inline(F.array(*lines)))
