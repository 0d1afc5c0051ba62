"""Periodic runs of words, by tiles of the scale of their period.

A run is a stretch of at least ``max(24, 3 * q)`` words with smallest period ``q`` that
cannot be longer. Words ``q`` apart are equal along at least ``max(24 - q, 2 * q)``
places of it. Periods are taken by octave ``[P, 2 P)``; a grid of step ``G`` (``P``, at
least 8) has a whole cell inside each of these stretches of equal places. Hence:

1. A document is exploded, per octave, into tiles around the cells that occur again
   at a distance within the octave (found by hashes of cells, exact by then on word numbers).
   A tile has the words from one step before its first cell to two octaves behind its last
   cell, so tiles overlap. Documents without such cells have no run and go on unshuffled.
2. Tiles are dealt over all tasks and solved alone. At a cell's start, the Z-function of the
   words behind gives for all periods at once how far words ``q`` apart stay equal, the
   Z-function of the reversed words how far before. A period is left out if its first words
   have a smaller one that divides it.
3. The fragments go by (document, period); those that overlap or touch are one stretch.

A fragment that ends inside its tile on both sides is judged there; any other goes on. Work and
fragments are near-linear in the words, also in a text of one word repeated.

Defined results: null counts as empty; an empty text has no words and no runs. Words are
compared by their bytes. Repeated rows come out repeated (rows, not ids, are keys), a null
id is kept, of a table without rows comes none. Other columns are not looked at. Texts of
any length are taken whole; a tile's size is bounded by its octave.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starlane.llm.packed import pack, unpack
from starlane.llm.shingles import U, mix
from starlane.llm.word_ids import SPACE, slices, text_bytes
from starlane.session import fresh_path

LEAST, REPEATS = 24, 3  # a run's least length, in words and in periods
SMALL = 8  # periods below share one octave and its grid
TILE = 4096  # words between the first and the last cell of a tile, if not less than the octave
RUNS = "array<struct<start: long, length: long, period: long>>"
STAGED = "key string, doc_id long, n_words long, text string, octave long, at long, cells binary, words binary"


def octaves(words: int) -> list[tuple[int, int]]:
    """Least and greatest period of each octave that a text of so many words can hold."""
    out, low = [], 1
    while REPEATS * low <= words and words >= LEAST:
        high = SMALL - 1 if low == 1 else 2 * low - 1
        out.append((low, high))
        low = high + 1
    return out


def step(low: int) -> int:
    return max(low, SMALL)


class Words:
    """The words of several texts in a row: numbers, places, and texts with single spaces."""

    def __init__(self, texts: pa.Array):
        data, edges = text_bytes(texts)
        word = ~SPACE[data]
        fresh = np.zeros(len(data) + 1, bool)  # a text starts here
        fresh[edges] = True
        before = np.concatenate([[False], word[:-1]]) if len(data) else word
        starts = np.flatnonzero(word & (fresh[:-1] | ~before))
        ends = np.flatnonzero(word & (fresh[1:] | ~np.concatenate([word[1:], [False]]))) + 1 if len(data) else starts
        sizes = ends - starts
        self.counts = np.diff(np.searchsorted(starts, edges))
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        kept = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(bounds), pa.py_buffer(data[word].tobytes()))
        self.numbers = kept.dictionary_encode().indices.to_numpy().astype(np.int64)
        # One space behind each word that another follows.
        gap = ~word & before & ~fresh[:-1]
        shown = word | gap
        self.bytes = np.where(word, data, 32)[shown].astype(np.uint8).tobytes()
        at = np.concatenate([[0], np.cumsum(shown)])[edges]
        trailing = gap & shown
        self.text_from = at[:-1]
        ends_open = np.zeros(len(at) - 1, np.int64)
        some = at[1:] > at[:-1]
        last = np.flatnonzero(shown)
        ends_open[some] = trailing[last[at[1:][some] - 1]] if len(last) else 0
        self.text_to = at[1:] - ends_open

    def text(self, i: int) -> str:
        return self.bytes[self.text_from[i]:self.text_to[i]].decode()


def cells(numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where a cell seems to occur again: least period of the octave, text, and word in that text.

    Texts are laid in a row with a mark of its own behind each, so no cell reaches over.
    """
    n_texts = len(counts)
    first = np.cumsum(counts) - counts + np.arange(n_texts)
    row = np.empty(len(numbers) + n_texts, np.int64)
    mark = np.zeros(len(row), bool)
    mark[first + counts] = True
    row[~mark] = numbers
    row[mark] = -1 - np.arange(n_texts)
    hashes, size = mix(row.astype(U)), 1
    found: list[tuple[int, np.ndarray]] = []

    def grown(values: np.ndarray, n: int) -> np.ndarray:
        return mix(values[:len(values) - n] * U(0x9E3779B97F4A7C15) + values[n:]) if len(values) > n else values[:0]

    for low, high in octaves(int(counts.max(initial=0))):
        g = step(low)
        while size < g:
            hashes, size = grown(hashes, size), 2 * size
        if low == 1:
            own = hashes[::g]
            again = np.zeros(len(own), bool)
            for q in range(low, high + 1):
                other = hashes[q::g]
                again[:len(other)] |= own[:len(other)] == other
        else:
            rows = -(-len(hashes) // g)
            if rows < 2:
                break
            square = np.zeros(rows * g, U)
            square[:len(hashes)] = hashes
            square = square.reshape(rows, g)
            again = (square[1:] == square[:-1, :1]).any(axis=1)
        at = np.flatnonzero(again) * g
        if len(at):
            found.append((low, at))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    low = np.concatenate([np.full(len(at), low) for low, at in found])
    at = np.concatenate([at for _, at in found])
    text = np.searchsorted(first, at, "right") - 1
    return low, text, at - first[text]


def tiles(low: int, at: np.ndarray, numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Where a tile begins, its cells relative to that, its words; ``at`` in ascending order."""
    g, reach = step(low), max(TILE, low)
    start = 0
    for i in range(1, len(at) + 1):
        if i == len(at) or at[i] - at[i - 1] > 4 * g or at[i] - at[start] >= reach:
            base = max(0, int(at[start]) - g)
            stop = int(at[i - 1]) + (2 * low if low > 1 else SMALL) + 2 * g
            yield base, at[start:i] - base, numbers[base:stop]
            start = i


def z_function(x: list[int]) -> list[int]:
    """For each place how many elements from there equal those from the start."""
    n = len(x)
    out = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, out[i - left]) if i < right else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        out[i] = k
    return out


def _prime_factors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return [*out, n] if n > 1 else out


def solve(low: int, at: np.ndarray, numbers: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """Per period the stretches of a tile along which words that far apart are equal.

    Only those that hold a cell, and only as far as they reach one step before and two
    behind its start; neighbouring cells have the rest.
    """
    g = step(low)
    high = SMALL - 1 if low == 1 else 2 * low - 1
    words = numbers.tolist()
    found: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for c in at.tolist():
        behind = z_function(words[c:c + high + 1 + 2 * g])
        periods = [
            q for q in range(low, min(high + 1, len(behind)))
            if behind[q] >= g and not any(behind[q // r] >= q - q // r for r in _prime_factors(q))
        ]
        if not periods:
            continue
        own = words[max(0, c - g):c][::-1]
        there = words[max(0, c - g):c + high][::-1]  # its place 0 is word c + high - 1
        short = c + high - max(0, c - g) - len(there)  # words that the text lacks at its end
        before = z_function([*own, -1, *there])[len(own) + 1:]
        for q in periods:
            back = min(before[high - q - short], g) if own else 0
            on = min(behind[q], 2 * g)
            if back + on < max(LEAST - q, (REPEATS - 1) * q) and back < min(g, c) and on < 2 * g:
                continue
            start, stop = c - back, c + on
            if found[q] and found[q][-1][1] >= start:
                start = min(start, found[q][-1][0])
                stop = max(stop, found[q].pop()[1])
            found[q].append((start, stop))
    return found


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed``.

    ``runs`` are in order of start and period, starts counted in words from 0; ``collapsed``
    has the words that no run holds behind its first period, parted by single spaces.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for part in slices(batch, 1):
                own = Words(part.column(1))
                yield part, own, *cells(own.numbers, own.counts)

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents that have no tile."""
        for part, own, _, text, _ in read(batches):
            rest = np.setdiff1d(np.arange(part.num_rows), text)
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(pa.array(rest)), pa.array(own.counts[rest], pa.int64()),
                pa.array([own.text(i) for i in rest.tolist()], pa.string()),
            ], names=["doc_id", "n_words", "collapsed"])

    names = [c.split()[0] for c in STAGED.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The other documents, and their tiles in rows of their own."""
        task, number = TaskContext.get().partitionId(), 0
        for part, own, low, text, at in read(batches):
            first = np.cumsum(own.counts) - own.counts
            order = np.lexsort((at, low, text))
            low, text, at = low[order], text[order], at[order]
            edges = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(low, prepend=-1) != 0)).tolist()
            key, last = "", -1
            for a, b in zip(edges, [*edges[1:], len(text)][:len(edges)], strict=True):
                i = int(text[a])
                rows = []
                if i != last:
                    key, last, number = f"{task}-{number}", i, number + 1
                    rows.append((key, part.column(0)[i].as_py(), int(own.counts[i]), own.text(i), None, None, None, None))
                words = own.numbers[first[i]:first[i] + own.counts[i]]
                for base, places, numbers in tiles(int(low[a]), at[a:b], words):
                    rows.append((key, None, None, None, int(low[a]), base, pack(places), pack(numbers)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), types, strict=True)], names=names
                )

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (key, period, base + start, base + stop)
                for key, low, base, places, numbers in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for period, stretches in solve(low, unpack(places), unpack(numbers)).items()
                for start, stop in stretches
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [[]] * 4, [types[0], *types[1:3], types[2]], strict=True)],
                names=["key", "period", "start", "stop"],
            )

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                text, runs = row.column(2)[0].as_py(), row.column(3)[0].as_py()
                if runs:
                    words = text.split(" ")
                    depth = np.zeros(len(words) + 1, np.int64)
                    for r in runs:
                        depth[r["start"] + r["period"]] += 1
                        depth[r["start"] + r["length"]] -= 1
                    text = " ".join([words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()])
                yield pa.RecordBatch.from_arrays(
                    [row.column(0), row.column(1), pa.array([text], pa.string()), row.column(3)],
                    names=["doc_id", "n_words", "collapsed", "runs"],
                )

    path = fresh_path(spark, "periodic-tiles")
    source.mapInArrow(exploded, STAGED).write.parquet(path)
    staged = spark.read.schema(STAGED).parquet(path)
    fragments = (
        staged.filter("octave IS NOT NULL").select("key", "octave", "at", "cells", "words")
        .repartition("key", "octave", "at").mapInArrow(solved, "key string, period long, start long, stop long")
    )
    ordered = W.partitionBy("key", "period").orderBy("start")
    reached = F.max("stop").over(ordered.rowsBetween(W.unboundedPreceding, -1))
    opens = F.when(F.col("start") <= F.col("_reached"), 0).otherwise(1)
    stretches = (
        fragments.withColumn("_reached", reached)
        .withColumn("_stretch", F.sum(opens).over(ordered.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("key", "period", "_stretch").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .select("key", "start", (F.col("stop") - F.col("start") + F.col("period")).alias("length"), "period")
        .filter(F.col("length") >= F.greatest(F.lit(LEAST), REPEATS * F.col("period")))
    )
    runs = stretches.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("found")
    ).select("key", F.transform("found", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))).alias("runs"))
    tiled = (
        staged.filter("octave IS NULL").select("key", "doc_id", "n_words", "text").join(runs, "key", "left")
        .select("doc_id", "n_words", "text", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"))
        .mapInArrow(collapse, f"doc_id long, n_words long, collapsed string, runs {RUNS}")
    )
    plain = source.mapInArrow(without, "doc_id long, n_words long, collapsed string").withColumn("runs", F.array().cast(RUNS))
    return plain.unionByName(tiled).select("doc_id", "n_words", "runs", "collapsed")
