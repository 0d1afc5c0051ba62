"""How the sources of a language differ in the words they use.

Tasks count the terms of their texts per (language, source) and combine them before the
shuffle. A language keeps the terms of enough of its documents; they are dealt by hash into
blocks of a bounded size and numbered within each. A group (language and source) then is,
per block, one array of term numbers in order and one of their counts.

Each unordered pair of groups is a task per block: the two groups' arrays are brought
together by a co-group and merged. Numbers of the shorter array are looked up in the longer
by galloping, each search from where the last one ended, which gives the terms of both; the rest of
either is priced against the other's share of a term it lacks, and the block's terms that
both lack count at once, without being looked at. To send an array less often, a task has
up to ``TOGETHER`` groups on each side. The blocks' sums add up to the divergence. The terms
that a group uses more than its language does need no pairs: a join with the kept terms and a
rank that is limited before the shuffle.

Shares are whole numbers, ``1 + floor(SCALE * (count + ADDED) / (total + ADDED * terms))``, and
all arithmetic on them is exact; totals of 9e15 and more are an error.

Defined results: null texts, languages and sources count as empty. A group without terms
is listed; in a language without kept terms all divergences are 0. Repeated rows are
documents of their own. Of a table without rows comes none. Other columns, also ones
named as the operator's own, are not looked at. Ties in rank fall to the smaller name by
UTF-8 bytes. Texts of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starlane.llm.shingles import LOWER
from starlane.llm.word_ids import slices, text_bytes
from starlane.session import fresh_path

LEAST_DOCS, ADDED, SCALE, TOP = 30, 5, 1_000_000_000, 50
BLOCK = 1 << 16  # kept terms of a block, about
TOGETHER = 16  # groups on each side of a pair task
TEXT = 8 << 20  # bytes of text counted at once
GREATEST = 9 * 10**15  # so that a remainder times 1000 fits into 64 bits

TERM = np.zeros(256, bool)
TERM[128:] = True
TERM[[*range(65, 91), *range(97, 123)]] = True


def terms(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of all texts in a row, A-Z lower-cased, and the text of each."""
    data, edges = text_bytes(texts)
    term = TERM[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[edges] = True
    starts = np.flatnonzero(term & (fresh[:-1] | ~np.concatenate([[False], term[:-1]])[:len(data)]))
    ends = np.flatnonzero(term & (fresh[1:] | ~np.concatenate([term[1:], [False]])[:len(data)])) + 1
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(LOWER[data[term]].tobytes()))
    return found.dictionary_encode(), np.searchsorted(edges, starts, "right") - 1


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.diff(sorted_values, prepend=sorted_values[:1] - 1))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and occurrences per language, source and term; without a term, the group's documents."""
    for batch in batches:
        for part in slices(batch, 2, TEXT):
            pairs = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True))
            groups = {pair: i for i, pair in enumerate(dict.fromkeys(pairs))}
            group_of = np.array([groups[p] for p in pairs], np.int64)
            coded, text = terms(part.column(2))
            code, n_terms = coded.indices.to_numpy().astype(np.int64), max(1, len(coded.dictionary))
            in_text = np.sort(text * n_terms + code)
            first = _runs(in_text)
            n = np.diff(np.append(first, len(in_text)))
            cell = group_of[in_text[first] // n_terms] * n_terms + in_text[first] % n_terms
            order = np.argsort(cell, kind="stable")
            cell, n = cell[order], n[order]
            at = _runs(cell)
            group = np.concatenate([cell[at] // n_terms, np.arange(len(groups))])
            which = pa.array(group)
            yield pa.RecordBatch.from_arrays([
                pa.array([g[0] for g in groups], pa.string()).take(which),
                pa.array([g[1] for g in groups], pa.string()).take(which),
                pa.concat_arrays([coded.dictionary.take(pa.array(cell[at] % n_terms)), pa.nulls(len(groups), pa.string())]),
                pa.array(np.concatenate([np.diff(np.append(at, len(cell))), np.bincount(group_of, minlength=len(groups))])),
                pa.array(np.concatenate([np.add.reduceat(n, at) if len(at) else n, np.zeros(len(groups), np.int64)])),
            ], names=["lang", "source", "term", "docs", "n"])


def _share(count: Column, total: Column, n_terms: Column) -> Column:
    """The share of a term, by long division in steps that fit into 64 bits."""
    whole = total + ADDED * n_terms
    rest, out = count + ADDED, F.lit(0).cast("long")
    for _ in range(3):
        out = out * 1000 + F.call_function("div", rest * 1000, whole)
        rest = (rest * 1000) % whole
    return out + 1


def shares(counts: np.ndarray, total: int, n_terms: int) -> np.ndarray:
    whole = total + ADDED * n_terms
    if whole >= GREATEST:
        raise OverflowError(f"{whole} is beyond exact arithmetic here")
    rest, out = counts.astype(np.int64) + ADDED, np.zeros(len(counts), np.int64)
    for _ in range(3):
        out = out * 1000 + rest * 1000 // whole
        rest = rest * 1000 % whole
    return out + 1


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common elements in either array; both in ascending order.

    The search for an element begins where the one before ended, and the step doubles
    until it is passed (numpy's search of a sorted list of keys keeps the lower bound).
    """
    if len(short) > len(long):
        there, here = gallop(long, short)
        return here, there
    at = np.searchsorted(long, short)
    both = at < len(long)
    both[both] = long[at[both]] == short[both]
    here = np.flatnonzero(both)
    return here, at[here]


class Group:
    """One group's terms of a block, with their shares."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, total: int, n_terms: int):
        self.ids = ids
        self.shares = shares(counts, total, n_terms)
        self.absent = int(shares(np.zeros(1), total, n_terms)[0]) if n_terms else 0


def divergence(a: Group, b: Group, block_terms: int) -> int:
    """What the terms of a block add to the divergence of two groups."""
    in_a, in_b = gallop(a.ids, b.ids)
    both = np.abs(a.shares[in_a] - b.shares[in_b]).sum()
    of_a, of_b = np.abs(a.shares - b.absent), np.abs(b.shares - a.absent)
    neither = block_terms - (len(a.ids) + len(b.ids) - len(in_a))
    one = of_a.sum() - of_a[in_a].sum() + of_b.sum() - of_b[in_b].sum()
    return int(both + one) + neither * abs(a.absent - b.absent)


def _groups(table: pa.Table) -> list[tuple[int, Group]]:
    out = []
    for row in range(table.num_rows):
        number, total, n_terms = (table[c][row].as_py() for c in ("number", "total", "n_terms"))
        ids, counts = (table[c][row].values.to_numpy(zero_copy_only=False) for c in ("ids", "counts"))
        out.append((number, Group(ids, counts, total, n_terms)))
    return out


def _price(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Each unordered pair of a group of the left with one of the right."""
    rows = []
    if left.num_rows and right.num_rows:
        lang, block_terms = left["lang"][0].as_py(), left["block_terms"][0].as_py()
        others = _groups(right)
        rows = [(lang, a, b, divergence(x, y, block_terms)) for a, x in _groups(left) for b, y in others if a < b]
    kinds = {"lang": pa.string(), "a": pa.int64(), "b": pa.int64(), "value": pa.int64()}
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(kinds.items(), columns, strict=True)})


def _stored(frame: DataFrame, name: str) -> DataFrame:
    """Written once, so that it is not computed again and the planner knows its size."""
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def audit(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
    least_docs: int = LEAST_DOCS, top: int = TOP,
) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: each other source of the language with its divergence. Part ``term``: the
    ``top`` terms whose share in the group is most above that in the language.
    """
    source = docs.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
        for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
    ])
    counts = _stored(
        source.mapInArrow(_count, "lang string, source string, term string, docs long, n long")
        .groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")),
        "term-counts",
    )
    known = (
        counts.filter("term IS NOT NULL").groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_count")).filter(F.col("docs") >= least_docs)
    )
    kept = _stored(known.select("lang", "term", "lang_count"), "kept-terms")
    groups = counts.filter("term IS NULL").select("lang", "source")
    langs = _stored(
        groups.select("lang").distinct().join(
            kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("lang_count").alias("lang_total")), "lang", "left"
        ).fillna(0, ["n_terms", "lang_total"])
        .withColumn("blocks", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n_terms") / BLOCK).cast("long"))),
        "languages",
    )
    numbered = kept.join(langs.select("lang", "blocks"), "lang").withColumn(
        "block", F.pmod(F.xxhash64("term"), "blocks")
    ).withColumn("id", F.row_number().over(W.partitionBy("lang", "block").orderBy("term")).cast("long"))
    held = _stored(
        counts.filter("term IS NOT NULL").join(_stored(numbered.drop("blocks"), "numbered-terms"), ["lang", "term"])
        .select("lang", "source", "block", "id", "term", "n", "lang_count"),
        "held-terms",
    )
    order = W.partitionBy("lang").orderBy("source")
    totals = _stored(
        groups.join(held.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .fillna(0, ["total"]).join(langs, "lang")
        .withColumn("number", F.row_number().over(order).cast("long") - 1)
        .withColumn("chunks", F.floor((F.count(F.lit(1)).over(W.partitionBy("lang")) - 1) / TOGETHER) + 1),
        "group-totals",
    )

    # Part term: no pairs.
    own = _share(F.col("n"), F.col("total"), F.col("n_terms"))
    common = _share(F.col("lang_count"), F.col("lang_total"), F.col("n_terms"))
    ranked = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    by_term = (
        held.join(totals.select("lang", "source", "total", "n_terms", "lang_total"), ["lang", "source"])
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (own - common).alias("value"))
        .filter("value > 0").withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    )

    # Part pair: the arrays of each group and block, also of those without terms.
    sizes = held.select("lang", "block", "id").groupBy("lang", "block").agg(F.max("id").alias("block_terms"))
    listed = held.groupBy("lang", "source", "block").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("found"))
    blocks = langs.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    empty = F.array().cast("array<struct<id: long, n: long>>")
    arrays = (
        totals.select("lang", "source", "number", "total", "n_terms", "chunks").join(blocks, "lang")
        .join(sizes, ["lang", "block"], "left").fillna(0, ["block_terms"])
        .join(listed, ["lang", "source", "block"], "left")
        .withColumn("found", F.coalesce("found", empty))
        .withColumn("chunk", F.floor(F.col("number") / TOGETHER))
    )
    columns = ["lang", "block", "number", "total", "n_terms", "block_terms", F.col("found.id").alias("ids"), F.col("found.n").alias("counts")]
    left = arrays.select(F.col("chunk").alias("i"), F.explode(F.sequence("chunk", F.col("chunks") - 1)).alias("j"), *columns)
    right = arrays.select(F.explode(F.sequence(F.lit(0).cast("long"), "chunk")).alias("i"), F.col("chunk").alias("j"), *columns)
    right = right.toDF(*right.columns)  # columns of its own
    task = ["lang", "block", "i", "j"]
    priced = _stored(
        left.groupBy(*task).cogroup(right.groupBy(*task)).applyInArrow(_price, "lang string, a long, b long, value long")
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")),
        "priced-pairs",
    )
    names = totals.select("lang", "source", "number")
    both = priced.unionByName(priced.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    by_pair = (
        both.join(names.withColumnRenamed("number", "a"), ["lang", "a"])
        .join(names.select("lang", F.col("source").alias("item"), F.col("number").alias("b")), ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
        .withColumn("rank", F.row_number().over(ranked))
    )
    return by_pair.unionByName(by_term)
