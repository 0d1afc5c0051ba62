"""The objects of JSON arrays, found by all tasks that read parts of a file.

A file is read as text parted at closing braces, so that Spark cuts it by bytes like any text,
whatever line breaks it has. Whether a part of it begins inside a string, and how deep in
braces, follows from all parts before: each split counts its quotes (less the escaped ones) and
its braces twice, as if it began outside a string and as if inside; sums of these over the
file's splits tell which count holds. An object is the parts from where depth leaves 0 to where
it is 0 again.

A split's parts come to its task in order, so tasks count and cut them where they are read, as
arrays; the text is read three times (counts, objects, rests at the borders of splits) and only
what crosses a border is shuffled.

A compressed file is one split, unless its codec can part it. How long its text is, its size does
not tell, so its text is read once more, parted at opening braces.

No backslash stands before a part's border in a way that matters: outside of strings there is
none, and inside a string the closing brace behind one takes its escape with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starlane.session import importable

OBJECT = "raw"
FILE, SPLIT = ["file"], ["file", "split"]
PACKED = "*.{gz,gzip,bz2,deflate,zst,zstd,lz4,snappy,lzo}"
TOTALS = "file string, split long, file_size long, parts long, bytes long, quotes long, change_0 long, change_1 long"
RESTS = "file string, split long, object long, closed boolean, text string"


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """The text between closing braces, and the split of a file that it is from."""
    return importable(spark).read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("file_size"), F.col("value").alias("text"),
    )


def _packed_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Bytes of the text of each compressed file, one more unless it ends with an opening brace."""
    files = spark.read.option("lineSep", "{").option("pathGlobFilter", PACKED).text(path)
    return files.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.sum(F.octet_length("value") + 1).alias("packed_size"))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Rows that follow one another in one split, and whether they are its first."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, split = batch.column("file"), batch.column("split")
        turns = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(split[1:], split[:-1]))
        cuts = np.flatnonzero(turns.to_numpy(zero_copy_only=False)) + 1
        for start, end in pairwise([0, *cuts.tolist(), batch.num_rows]):
            here = (file[start].as_py(), split[start].as_py())
            yield here != last, batch.slice(start, end - start)
            last = here


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each begins, with the end of the last."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, at - at[0]


def _with_brace(texts: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(texts.cast(pa.large_binary()), pa.scalar(b"", pa.large_binary()), pa.scalar(b"}", pa.large_binary()))


def _counted(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each part's quotes, and its opening braces behind an even and behind an odd number of them."""
    if (data == ord("\\")).any():
        data = np.frombuffer(re.sub(rb"(?s)\\.", b"  ", data.tobytes()), np.uint8)
    before = np.concatenate([[0], np.cumsum(data == ord('"'), dtype=np.int32)])
    braces = np.flatnonzero(data == ord("{"))
    part = np.searchsorted(at, braces, "right") - 1
    odd = ((before[braces] - before[at[part]]) & 1).astype(bool)
    n = len(at) - 1
    return np.diff(before[at]).astype(np.int64), np.bincount(part[~odd], minlength=n), np.bincount(part[odd], minlength=n)


def _inside(quotes: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each part begins, and whether it ends, inside a string."""
    ends = (inside + np.cumsum(quotes)) & 1
    return np.concatenate([[inside], ends[:-1]]), ends


def _changes(begins: np.ndarray, ends: np.ndarray, even: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """How each part, with the brace behind it, changes the depth."""
    return np.where(begins == 0, even, odd) - (ends == 0)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: what it counts, whichever way it begins."""
    def row(found: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([found])

    found: dict = {}
    for first, rows in _stretches(batches):
        if first:
            if found:
                yield row(found)
            found = {n: rows.column(n)[0].as_py() for n in (*SPLIT, "file_size")}
            found |= dict.fromkeys(("parts", "bytes", "quotes", "change_0", "change_1"), 0)
        texts = _with_brace(rows.column("text"))
        data, at = _bytes(texts)
        quotes, even, odd = _counted(data, at)
        for way in (0, 1):
            begins, ends = _inside(quotes, (found["quotes"] + way) & 1)
            found[f"change_{way}"] += int(_changes(begins, ends, even, odd).sum())
        found["parts"] += len(texts)
        found["bytes"] += len(data)
        found["quotes"] += int(quotes.sum())
    if found:
        yield row(found)


def _split_starts(totals: DataFrame, packed: DataFrame) -> DataFrame:
    """How each split begins: inside a string or not, at which depth. One row per split of a file."""
    totals = totals.join(packed, FILE, "left")
    whole = W.partitionBy(*FILE)
    before = whole.orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    change = F.when(F.col("split_inside") == 0, F.col("change_0")).otherwise(F.col("change_1"))
    # The last part of a file has no brace behind it, unless parts and braces make up all its
    # bytes. Of a file's byte order mark Spark shows nothing, which leaves three bytes out.
    # A text cannot end with both braces, so with the closing one at its end it has one byte less here.
    held = F.sum("bytes").over(whole)
    one_more = F.when(F.col("packed_size").isNull(), F.pmod(held - F.col("file_size"), F.lit(3)) == 1).otherwise(held >= F.col("packed_size"))
    no_border = one_more & (F.col("split") == F.max("split").over(whole))
    return (
        totals.withColumn("split_inside", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int"))
        .select(
            *SPLIT, "split_inside", F.coalesce(F.sum(change).over(before), F.lit(0)).alias("split_depth"),
            # Which part has no brace behind it, counted from 1; 0 is none.
            F.when(no_border, F.col("parts")).otherwise(0).alias("open_end"),
        )
    )


def _cut(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """The objects that lie in one split (``whole``), or what else a split has: at most its first and its last piece."""
    def rest(closed: bool) -> pa.RecordBatch:
        text = pa.array([b"".join(held)], pa.binary()).view(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([file]), pa.array([split]), pa.array([objects]), pa.array([closed]), text], ["file", "split", "object", "closed", "text"]
        )

    held: list[bytes] = []
    file = split = None
    inside = depth = seen = objects = 0
    begun = False
    for first, rows in _stretches(batches):
        if first:
            if held and not whole:
                yield rest(False)
            file, split, inside, depth, open_end = (
                rows.column(n)[0].as_py() for n in (*SPLIT, "split_inside", "split_depth", "open_end")
            )
            held, seen, objects, begun = [], 0, 0, depth == 0 and inside == 0
        data, at = _bytes(_with_brace(rows.column("text")))
        quotes, even, odd = _counted(data, at)
        begins, ends = _inside(quotes, inside)
        border = np.ones(rows.num_rows, bool)
        seen += rows.num_rows
        if seen == open_end:
            border[-1] = False
        change = np.where(border, _changes(begins, ends, even, odd), np.where(begins == 0, even, odd))
        depths = depth + np.cumsum(change)
        closes = at[1:][border & (ends == 0) & (depths == 0)]
        inside, depth = int(ends[-1]), int(depths[-1])
        end = len(data) - (not border[-1])
        start = 0
        if len(closes):
            # What was held back and goes on here.
            held.append(data[:closes[0]].tobytes())
            if begun and whole:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary()).view(pa.string())], ["text"])
            elif not begun and not whole:
                yield rest(True)
            begun, held = True, []
            objects += len(closes)
            start = int(closes[-1])
            if whole and len(closes) > 1:
                held_here = pa.py_buffer(data[closes[0]:start])
                offsets = pa.py_buffer((closes - closes[0]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.StringArray.from_buffers(len(closes) - 1, offsets, held_here)], ["text"])
        if start < end:
            held.append(data[start:end].tobytes())
    if held and not whole:
        yield rest(False)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _cut(batches, whole=True)


def _rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _cut(batches, whole=False)


def read_array_objects(spark: SparkSession, path: str) -> DataFrame:
    """Column ``raw``: the text of each top-level object of the JSON arrays under ``path``, as written.

    What is no object comes too, together with the object behind it, and so does an object
    that the file's end cuts off. Objects one after another without an array are found as
    well. The order of rows is not kept.
    """
    parts = _parts(spark, path)
    # One row per split, so a broadcast leaves the parts where and as they are read.
    starts = F.broadcast(_split_starts(parts.mapInArrow(_totals, TOTALS), _packed_sizes(spark, path)))
    known = parts.drop("file_size").join(starts, SPLIT)
    # At most two pieces of a split reach over its borders.
    in_file = W.partitionBy(*FILE).orderBy("split", "object").rowsBetween(W.unboundedPreceding, -1)
    pieces = F.array_sort(F.collect_list(F.struct("split", "object", "text")))
    crossing = (
        known.mapInArrow(_rests, RESTS).withColumn("number", F.coalesce(F.count_if("closed").over(in_file), F.lit(0)))
        .groupBy(*FILE, "number").agg(F.array_join(F.transform(pieces, lambda x: x["text"]), "").alias("text"))
    )
    texts = known.mapInArrow(_whole, "text string").unionByName(crossing.select("text"))
    bare = F.regexp_replace("text", r"^[\s,\[\]\x{FEFF}]+", "")
    return texts.select(bare.alias(OBJECT)).filter(F.col(OBJECT) != "")
