"""Encoding and decoding with a distinct-word table.

Texts are cut into words in Spark's tasks. A block of texts becomes its list of distinct
words and, for each text, the positions' numbers in that list. Words are dealt by their
hash over all tasks, where each distinct word is encoded once (as long as the task's
bounded memory of words lasts); their ids go back to the blocks, and by position to the
texts. Only distinct words of a block travel, compressed, never a row per occurrence. Decoding is the same join by position on the other
side: ids to the pieces of the vocabulary, whose size is fixed.

Blocks are bounded by ``BLOCK`` bytes of text, or one longer text. A block's name comes
from its partition and content, so a block recomputed after a loss meets its words
again; one that doesn't is an error, not a shorter result.

Defined results: null counts as empty; an empty text has no ids and decodes to the empty
text. Repeated rows come out repeated. A null id is kept. Of a table without rows comes
none. Other columns are not looked at.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.llm.packed import pack, unpack
from starlane.llm.word_ids import encoder, read_spec, slices, spaced_cuts, text_bytes

BLOCK, TOGETHER = 4 << 20, 1 << 19


def _word_codes(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the number of each occurrence, and how many occurrences a text has."""
    data, edges = text_bytes(texts)
    if not len(data):
        return pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    cut = np.zeros(len(data) + 1, bool)
    cut[spaced_cuts(data)] = True
    cut[edges] = True
    at = np.flatnonzero(cut)
    words = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data))
    # Words begin with the white space before them, which the tokenizer drops.
    coded = pc.ascii_trim_whitespace(words).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.diff(np.searchsorted(at, edges))


def _lay_out(flat: np.ndarray, sizes: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries ``code`` of a table (``flat`` in rows of ``sizes``) in a row, and where each ends."""
    n = sizes[code]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat((np.cumsum(sizes) - sizes)[code] - (ends - n), n) + np.arange(total)], ends


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids``; ``ids`` holds little-endian unsigned 32-bit integers.

    ``tokenizer`` is the path of a tokenizer that drops white space.
    """
    spec = read_spec(tokenizer)

    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, 1, BLOCK):
                data, edges = text_bytes(part.column(1))
                name = f"{task}-{number}-{xxhash.xxh64_hexdigest(data.tobytes() + edges.tobytes())}"
                number += 1
                words, codes, counts = _word_codes(part.column(1))
                # Numbered by how often they occur, so that most numbers are small.
                order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                yield name, part, words.take(pa.array(order)), rank[codes], counts

    def word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per block and bucket of words."""
        for name, _, words, _, _ in named(batches):
            found = words.to_pylist()
            bucket = np.array([crc32(w.encode()) % buckets for w in found], np.int64)
            rows = []
            by_bucket = np.argsort(bucket, kind="stable")
            for some in np.split(by_bucket, np.flatnonzero(np.diff(bucket[by_bucket])) + 1):
                if len(some):
                    text = "\n".join(found[i] for i in some).encode()
                    rows.append((int(bucket[some[0]]), pack(some), zstandard.compress(text, 3)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(rows)), *map(pa.array, zip(*rows, strict=True))],
                    schema=pa.schema([("block", pa.string()), ("bucket", pa.int64()), ("numbers", pa.binary()), ("words", pa.binary())]),
                )

    def text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, part, words, codes, counts in named(batches):
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * part.num_rows), part.column(0), pa.array(counts),
                pa.array([len(words)] * part.num_rows, pa.int32()),
                pa.array([pack(c) for c in np.split(codes, np.cumsum(counts)[:-1])], pa.binary()),
            ], names=["block", "doc_id", "n", "n_words", "codes"])

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(spec, spaced_cuts)
        for batch in batches:
            for row in range(batch.num_rows):
                block, _, numbers, words = (c[row].as_py() for c in batch.columns)
                # Words hold no line end: that is white space.
                number = coder.pieces(zstandard.decompress(words).decode().split("\n"))
                flat, sizes = coder.table()
                ids, _ = _lay_out(flat, sizes, number)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), *(pa.array([x], pa.binary()) for x in (numbers, pack(sizes[number]), pack(ids)))],
                    names=["block", "numbers", "sizes", "ids"],
                )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    table = (
        source.mapInArrow(word_rows, "block string, bucket long, numbers binary, words binary")
        .repartition(buckets, "bucket").sortWithinPartitions("bucket")
        .mapInArrow(encode_words, "block string, numbers binary, sizes binary, ids binary")
    )
    texts = source.mapInArrow(text_rows, "block string, doc_id long, n long, n_words int, codes binary")

    def join(key: tuple, texts: pa.Table, table: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _nothing()
        n_words = texts["n_words"][0].as_py()
        parts = [
            (unpack(n), unpack(s).astype(np.int64), unpack(i))
            for n, s, i in zip(*(table[c].to_pylist() for c in ("numbers", "sizes", "ids")), strict=True)
        ] or [(np.zeros(0, np.int64),) * 3]
        numbers, sizes, flat = (np.concatenate(x) for x in zip(*parts, strict=True))
        row_of = np.argsort(numbers)
        if not np.array_equal(numbers[row_of], np.arange(n_words)):
            raise RuntimeError(f"block {key[0]} has not met its words; the input must read the same each time")
        out = []
        for data in texts["codes"].to_pylist():
            ids, _ = _lay_out(flat, sizes, row_of[unpack(data)])
            out.append(ids.astype("<u4").tobytes())
        return pa.table({
            "doc_id": texts["doc_id"], "n_tokens": pa.array([len(x) // 4 for x in out], pa.int64()),
            "ids": pa.array(out, pa.binary()),
        })

    return texts.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(
        join, "doc_id long, n_tokens long, ids binary"
    )


def _nothing() -> pa.Table:
    return pa.table({
        "doc_id": pa.array([], pa.int64()), "n_tokens": pa.array([], pa.int64()), "ids": pa.array([], pa.binary()),
    })


def piece_table(spec: str) -> list[str]:
    """The piece of each id, as the library's own table of ids has it; empty where an id has none."""
    model = json.loads(spec)
    pieces = {i: p for p, i in model["model"]["vocab"].items()}
    pieces |= {t["id"]: t["content"] for t in model["added_tokens"]}
    return [pieces.get(i, "") for i in range(max(pieces) + 1)]


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and stops of runs of equal values."""
    edges = np.flatnonzero(np.diff(values, prepend=values[:1] - 1, append=values[-1:] + 1)).tolist()
    return edges[:-1], edges[1:]


def decode(coded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` with ``decoded``: the pieces, joined as the library joins them.

    The tokenizer has no decoder of its own; the library then puts a space between pieces.
    """
    spec = read_spec(tokenizer)
    if json.loads(spec).get("decoder"):
        raise ValueError("made for tokenizers without a decoder")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaced = [(" " + p).encode() for p in piece_table(spec)]
        sizes = np.array([len(p) for p in spaced], np.int64)
        flat = np.frombuffer(b"".join(spaced), np.uint8)
        for batch in batches:
            counts = batch.column(1).to_numpy()
            run_of = np.cumsum(counts) // TOGETHER  # rows of about as many ids are decoded at once
            for start, stop in zip(*_runs(run_of), strict=True):
                rows = batch.slice(start, stop - start)
                ids = np.frombuffer(b"".join(rows.column(2).to_pylist()), "<u4")
                text, ends = _lay_out(flat, sizes, ids)
                last = np.concatenate([[0], ends])[np.cumsum(counts[start:stop])]
                first = np.concatenate([[0], last[:-1]])
                whole = text.tobytes()
                decoded = [whole[a + 1:b].decode() for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"]
                )

    return coded.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
