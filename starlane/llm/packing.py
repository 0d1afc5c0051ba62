"""Cost-balanced packing of documents into sequences of bounded length.

A document's ids, closed by an end id, are cut into pieces of at most ``capacity``.
Training cost of a sequence is estimated as ``LINEAR`` per id plus ``QUADRATIC`` per
pair of ids that attend to each other, which are those of one piece. Pieces go, longest
first, each to the cheapest sequence with room for it; one that fits nowhere whole is
cut to fill the cheapest sequence with room. A shard has as many sequences as its ids
need, so less than one sequence of padding is left in each shard.

Shards are runs of a partition's documents of about ``SHARD`` ids: nothing is shuffled,
and memory depends on ``SHARD`` and the longest document only. A sequence's id is
made of the partition's and a running number, so it is unique.

Defined results: a null or empty text has the end id alone. Repeated rows are packed
each on its own. Of a table without rows come no sequences. A null document id is kept.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.llm.word_ids import encoder, read_spec, slices, spaced_cuts

CAPACITY, END_ID = 2048, 1
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
SHARD = 1 << 21

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, cost double"


def assign(sizes: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of documents with these sizes."""
    def price(n: int) -> float:
        return LINEAR * n + QUADRATIC * n * n

    room = np.full(-(-int(sizes.sum()) // capacity), capacity, np.int64)
    cost = np.zeros(len(room))
    out = []
    used = 0  # sequences that one full piece has taken
    rest = []
    for doc, size in enumerate(sizes.tolist()):
        for start in range(0, size - capacity + 1, capacity):
            out.append((doc, start, capacity, used, 0))
            used += 1
        if size % capacity:
            rest.append((size % capacity, doc, size - size % capacity))
    room[:used] = 0
    open_cost, open_room = cost[used:], room[used:]
    for size, doc, start in sorted(rest, key=lambda r: (-r[0], r[1])):
        while size:
            fits = open_room >= size
            if not fits.any():
                fits = open_room > 0
            best = int(np.where(fits, open_cost, np.inf).argmin())
            n = min(size, int(open_room[best]))
            out.append((doc, start, n, used + best, capacity - int(open_room[best])))
            open_room[best] -= n
            open_cost[best] += price(n)
            size, start = size - n, start + n
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per piece; ``ids`` holds its ids as little-endian unsigned 32-bit integers.

    ``tokenizer`` is the path of a tokenizer that drops white space.
    """
    spec = read_spec(tokenizer)
    layout = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("cost", pa.float64()),
    ])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
        coder = encoder(spec, spaced_cuts)
        names: list = []
        docs_ids: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for part in slices(batch, 1):
                ids, sizes = coder.texts(part.column(1))
                for name, x in zip(part.column(0).to_pylist(), np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
                    names.append(name)
                    docs_ids.append(np.append(x, np.uint32(end_id)).astype("<u4"))
                    held += len(docs_ids[-1])
                    if held >= SHARD:
                        yield names, docs_ids
                        names, docs_ids, held = [], [], 0
        if names:
            yield names, docs_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for names, docs_ids in shards(batches):
            sizes = np.array([len(x) for x in docs_ids], np.int64)
            pieces = sorted(assign(sizes, capacity), key=lambda p: (p[3], p[4]))
            doc, start, length, seq, offset = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
            for at in range(0, len(pieces), 4096):
                part = slice(at, at + 4096)
                n = length[part]
                yield pa.RecordBatch.from_arrays([
                    pa.array([names[d] for d in doc[part]], pa.int64()), pa.array(start[part]), pa.array(n),
                    pa.array([docs_ids[d][s:s + m].tobytes() for d, s, m in zip(doc[part], start[part], n, strict=True)], pa.binary()),
                    pa.array(sizes[doc[part]]), pa.array(first + seq[part]), pa.array(offset[part]),
                    pa.array(LINEAR * n + QUADRATIC * n * n),
                ], schema=layout)
            first += int(seq.max()) + 1

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)
