"""Rental files: nested JSON, one array per day or one object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.operators.rentals import RAW, complete
from starlane.schemas import RENTAL
from starlane.sources.json_array import read_array_objects


def read_rentals(
    spark: SparkSession, path: str, multi_line: bool = False, schema: T.StructType = RENTAL
) -> DataFrame:
    """Rentals under ``path``; ``batch_date=...`` folders become a column.

    A multi-line file (one JSON array) is parsed by a single task here; ``read_objects`` reads
    it in parts. One object per line is the default.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_objects(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Column ``raw``: the text of each rental as written, one per line, or with ``multi_line`` of JSON arrays.

    Either way a large file is read by many tasks, unless it is compressed. Empty lines are none.
    """
    if multi_line:
        return read_array_objects(spark, path)
    return spark.read.text(path).select(F.col("value").alias(RAW)).filter(F.trim(RAW) != "")


def _relaxed(schema: T.StructType) -> T.StructType:
    """The schema with whole numbers read as doubles: they may be written with a point (``2.0``)."""
    return T.StructType([
        T.StructField(f.name, _relaxed(f.dataType) if isinstance(f.dataType, T.StructType)
                      else T.DoubleType() if isinstance(f.dataType, T.IntegerType) else f.dataType)
        for f in schema
    ])


def _whole(value: Column) -> Column:
    return F.when(value == F.floor(value), value.try_cast("int"))


def parse_rentals(objects: DataFrame) -> DataFrame:
    """The fields of raw rentals; ``raw`` stays beside those that lack a required one, byte for byte.

    A field of another type is NULL, and so is a fraction for a whole number. Text that is no
    object, or breaks off, has no fields, as Spark's reader has it.
    """
    # As a generated column it is parsed once; a filter on its fields would parse anew for each.
    parsed = objects.withColumn("_r", F.explode(F.array(F.from_json(RAW, _relaxed(RENTAL)))))
    car = F.when(F.col("_r.car").isNotNull(), F.struct(
        "_r.car.make", "_r.car.model", _whole(F.col("_r.car.year")).alias("year")
    ))
    rows = parsed.select(
        *[{"car": car, "quantity": _whole(F.col("_r.quantity"))}.get(n, F.col(f"_r.{n}")).alias(n) for n in RENTAL.fieldNames()],
        RAW,
    )
    return rows.withColumn(RAW, F.when(~complete(), F.col(RAW)))


def write_rentals(rentals: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object per line, in a folder per ``batch_date``; a big day becomes many files.

    Compressed, as the names of fields make most of the text: a file is then read by one task, and
    rebalancing keeps each to what one task should have.
    """
    (
        rentals.hint("rebalance", "batch_date")
        .write.mode(mode).partitionBy("batch_date").json(path, compression="gzip")
    )
