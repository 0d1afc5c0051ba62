"""The nearest known value of each unknown one, by edit distance, without comparing all pairs.

Two texts within ``k`` edits have most of their q-grams in common: at least n - k * q of n,
counted at the longer one, with ``Q - 1`` marks at either end. In any common order of q-grams they
then share one of the first k * q + 1 of each; rare ones come first, so few pairs meet. Only
pairs that share such a gram at places at most ``k`` apart are compared. Texts too short to
share a gram for sure meet by what is left of them after up to ``k`` deletions, which two texts
within ``k`` edits have in common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Q = 2
EDITS = 2
START, END = "\x01", "\x02"


def _grams(text: Column) -> Column:
    """Each q-gram with its place, and how often it stands before that: equal grams are told apart."""
    padded = F.concat(F.lit(START * (Q - 1)), text, F.lit(END * (Q - 1)))
    pieces = F.transform(F.sequence(F.lit(1), F.length(text) + Q - 1), lambda i: F.substr(padded, i, F.lit(Q)))
    return F.transform(pieces, lambda g, i: F.struct(
        g.alias("gram"), F.size(F.filter(F.slice(pieces, F.lit(1), i), lambda h: h == g)).alias("nth"), i.alias("place"),
    ))


def _left_over(text: Column, edits: int) -> Column:
    """What is left of a text after up to so many deletions."""
    found = F.array(text)
    for _ in range(edits):
        shorter = F.flatten(F.transform(found, lambda t: F.transform(
            F.filter(F.sequence(F.lit(0), F.length(t)), lambda i: i > 0),
            lambda i: F.concat(F.substr(t, F.lit(1), i - 1), F.substr(t, i + 1)),
        )))
        found = F.array_distinct(F.concat(found, shorter))
    return found


def _keys(texts: DataFrame, counts: DataFrame, edits: int) -> DataFrame:
    """The grams by which a text meets others: its rarest ones, or its left-overs if it is short."""
    first = edits * Q + 1
    size = F.length("text")
    grams = (
        texts.select("kind", "text", F.explode(_grams(F.col("text"))).alias("g")).select("kind", "text", "g.*")
        .join(counts, ["kind", "gram", "nth"], "left")
        .groupBy("kind", "text").agg(
            F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "nth", "place"))), 1, first).alias("g")
        )
        .select("kind", "text", F.explode("g").alias("g")).select("kind", "text", "g.gram", "g.nth", "g.place")
    )
    short = texts.filter(size + Q - 1 <= edits * Q).select(
        "kind", "text", F.explode(_left_over(F.col("text"), edits)).alias("gram"), F.lit(0).alias("nth"), F.lit(0).alias("place")
    )
    return grams.unionByName(short)


def nearest(unknown: DataFrame, known: DataFrame, edits: int = EDITS) -> DataFrame:
    """``kind, text, suggestion, edits`` for each distinct text of ``unknown`` that has a known one of its kind so near.

    Both have the columns ``kind`` and ``text``. Of several at the least distance the first by name
    is taken.
    """
    ours = unknown.select("kind", "text").filter("text IS NOT NULL").distinct()
    theirs = known.select("kind", "text").filter("text IS NOT NULL").distinct()
    counts = theirs.select("kind", F.explode(_grams(F.col("text"))).alias("g")).groupBy("kind", "g.gram", "g.nth").agg(
        F.count(F.lit(1)).alias("n")
    )
    left = _keys(ours, counts, edits).withColumnRenamed("place", "at")
    right = _keys(theirs, counts, edits).select("kind", "gram", "nth", "place", F.col("text").alias("suggestion"))
    met = left.join(right, ["kind", "gram", "nth"]).filter(
        (F.abs(F.col("at") - F.col("place")) <= edits) & (F.abs(F.length("text") - F.length("suggestion")) <= edits)
    )
    distance = F.levenshtein("text", "suggestion", edits)
    return (
        met.withColumn("edits", distance).filter("edits >= 0")
        .groupBy("kind", "text").agg(F.min(F.struct("edits", "suggestion")).alias("best"))
        .select("kind", "text", "best.suggestion", "best.edits")
    )
