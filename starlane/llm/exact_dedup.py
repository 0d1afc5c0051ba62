"""Exact deduplication over recipes of content-defined chunks.

A text is cut where its own content says so: a chunk ends at the first sentence or
line end behind ``MIN_CHUNK`` characters, or after ``MAX_CHUNK`` characters without
one. A text's recipe is the ordered list of its chunks' identifiers. Texts are equal
when their recipes are, once no identifier stands for two different chunks. That is
verified by comparing the chunks themselves, and only those of texts whose recipe
occurs more than once: no other text can have an equal. An identifier found to stand
for several chunks is told apart by each chunk's number among them.

Long texts are not moved: recipes are; of the chunks to verify, each distinct one
moves once per task.

Defined results: a null text counts as the empty text, whose recipe is empty. A null
id never wins against another id, and is the group's ``keep_id`` only if all ids are
null. Rows that repeat both id and text are all marked alike (``drop_copies`` keeps one
of them). Of a table without rows comes a result without rows. Other columns are never
looked at and may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.session import fresh_path

MIN_CHUNK, MAX_CHUNK = 512, 8192


def chunks(text: Column, shortest: int = MIN_CHUNK, longest: int = MAX_CHUNK) -> Column:
    """The text's chunks in order; joined they are the text."""
    cut = rf"(?s).{{{shortest},{longest - 1}}}?[.!?\n]|.{{1,{longest}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def recipes(docs: DataFrame, id_col: str, text_col: str, identify: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        F.sha2(text, 256).alias("sha"),
        F.transform(chunks(text), lambda c: identify(c)).alias("recipe"),
    )


def find_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    identify: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the largest id stays. ``identify`` gives a chunk's identifier
    (a long); a poor one costs time, never a wrong result.
    """
    spark = docs.sparkSession
    def keep(frame: DataFrame, name: str) -> DataFrame:
        path = fresh_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    stored = keep(recipes(docs, id_col, text_col, identify), "recipes")
    shared = stored.groupBy("recipe").count().filter("count > 1")
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = docs.select(F.col(id_col).alias("id"), F.sha2(text, 256).alias("sha"), chunks(text).alias("parts"))
    suspects = parts.withColumn("recipe", F.transform("parts", lambda c: identify(c))).join(
        shared.select("recipe"), "recipe", "left_semi"
    )

    def exploded(*columns: str) -> DataFrame:
        return suspects.select(*columns, F.posexplode("parts").alias("pos", "chunk")).select(
            *columns, "pos", "chunk", identify(F.col("chunk")).alias("chunk_id")
        )

    distinct = keep(exploded().select("chunk_id", "chunk").distinct(), "chunks")
    unsure = distinct.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("chunk_id")
    # Chunks that share an identifier, numbered by sorting each identifier's few.
    numbered = keep(
        distinct.join(unsure, "chunk_id", "left_semi")
        .groupBy("chunk_id").agg(F.sort_array(F.collect_list("chunk")).alias("all"))
        .select("chunk_id", F.posexplode("all").alias("number", "chunk")),
        "numbered",
    )
    none = F.array().cast("array<struct<pos:int,number:int>>")
    if numbered.isEmpty():  # each identifier stands for one chunk; recipes can be compared as they are
        told = stored.withColumn("marks", none)
    else:
        marks = (
            exploded("id", "sha").join(numbered, ["chunk_id", "chunk"])
            .groupBy("id", "sha")
            .agg(F.sort_array(F.collect_set(F.struct("pos", "number"))).alias("marks"))
            .select(F.col("id").alias("m_id"), F.col("sha").alias("m_sha"), "marks")
        )
        told = (
            stored.join(marks, F.col("id").eqNullSafe(F.col("m_id")) & (F.col("sha") == F.col("m_sha")), "left")
            .select("id", "sha", "recipe", F.coalesce("marks", none).alias("marks"))
        )
    groups = told.groupBy("recipe", "marks").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return told.join(groups, ["recipe", "marks"]).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one of rows equal in id and text."""
    kept = (
        find_copies(docs, id_col, text_col).filter("kept")
        .groupBy("doc_id", "text_sha256").count()
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), F.sha2(text, 256).alias("sha")
    ).join(kept, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("sha") == F.col("text_sha256")))
    once = rows.filter("count = 1").select("row")
    again = rows.filter("count > 1").groupBy("id", "sha").agg(F.first("row").alias("row")).select("row")
    return once.unionByName(again).select("row.*")
