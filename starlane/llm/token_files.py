"""Token-id files: documents' ids in ascending order of their document ids, range-coded.

``write`` orders documents by id, encodes them, closes each with an end id, and writes
Parquet files whose rows are blocks (see ``range_coder``): whole documents in order, up to
about ``BLOCK`` ids or one longer document. Each block is decoded alone and checked by its
sums. ``read`` gives every document with its place in the sequence of all ids.

Documents are dealt by ranges of (id, hash of the text), so no task holds more than its
share and the files of all tasks in order are the order of ids. Only totals of each file
meet in one task.

Defined results: a null or empty text has the end id alone. A null id comes before all
others. Rows that repeat an id are written one after the other, in the order of their
texts' hashes. A table without rows makes files without blocks, which read as no rows.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlane.llm import range_coder
from starlane.llm.word_ids import byte_level_cuts, encoder, read_spec, slices

BLOCK, END_ID = 1 << 21, 2


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """``tokenizer`` is the path of a byte-level tokenizer."""
    spec = read_spec(tokenizer)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(spec, byte_level_cuts)
        file, number, before = TaskContext.get().partitionId(), 0, 0
        names: list = []
        held: list[np.ndarray] = []
        total = 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate(held)
            return pa.RecordBatch.from_arrays([
                pa.array([file], pa.int64()), pa.array([number], pa.int64()), pa.array([before], pa.int64()),
                pa.array([len(ids)], pa.int64()), pa.array([names], pa.list_(pa.int64())),
                pa.array([[len(x) for x in held]], pa.list_(pa.int64())), pa.array([range_coder.encode(ids)], pa.binary()),
            ], names=["file", "block", "before", "n", "doc_ids", "sizes", "coded"])

        for batch in batches:
            for part in slices(batch, 1):
                ids, sizes = coder.texts(part.column(1))
                for name, x in zip(part.column(0).to_pylist(), np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
                    names.append(name)
                    held.append(np.append(x, np.uint32(end_id)))
                    total += len(held[-1])
                    if total >= BLOCK:
                        yield block()
                        number, before = number + 1, before + total
                        names, held, total = [], [], 0
        if held:
            yield block()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(
        blocks, "file long, block long, before long, n long, doc_ids array<long>, sizes array<long>, coded binary"
    ).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``; ``ids`` are little-endian unsigned 32-bit integers."""
    stored = spark.read.parquet(path)
    # A row per file; their number does not depend on the number of documents.
    totals = stored.groupBy("file").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    blocks = stored.join(starts, "file").select(
        (F.col("first") + F.col("before")).alias("start"), "doc_ids", "sizes", "coded"
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start, names, sizes, coded = (c[row].as_py() for c in batch.columns)
                sizes = np.array(sizes, np.int64)
                ids = range_coder.decode(coded).astype("<u4")
                ends = np.cumsum(sizes)
                for at in range(0, len(names), 1024):
                    part = slice(at, at + 1024)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(names[part], pa.int64()), pa.array(start + ends[part] - sizes[part]), pa.array(sizes[part]),
                        pa.array([ids[e - n:e].tobytes() for e, n in zip(ends[part], sizes[part], strict=True)], pa.binary()),
                    ], names=["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")
