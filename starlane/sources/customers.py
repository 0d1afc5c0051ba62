"""Customer files: CSV without a header, columns by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.schemas import CUSTOMER_BATCH


# The place of a line among all lines read, where a batch carries it.
LINE = "line_number"


def read_customers(
    spark: SparkSession, path: str, quoted: bool = True, line_breaks: bool = False, numbered: bool = False
) -> DataFrame:
    """The four columns by position.

    Quotes may enclose a field; a doubled quote inside stands for one. ``quoted=False``
    keeps quote characters as data. ``line_breaks`` allows them within quotes, at the
    price that one task reads a whole file. ``numbered`` adds the lines' order.
    """
    reader = spark.read.schema(CUSTOMER_BATCH).option("header", False).option("multiLine", line_breaks)
    reader = reader.option("quote", '"').option("escape", '"') if quoted else reader.option("quote", "")
    batch = reader.csv(path)
    return batch.withColumn(LINE, F.monotonically_increasing_id()) if numbered else batch


def write_customers(batch: DataFrame, path: str) -> None:
    batch.select(CUSTOMER_BATCH.fieldNames()).write.option("header", False).option("escape", '"').csv(path)
