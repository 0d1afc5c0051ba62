"""Nearest neighbours by largest inner product, with multi-index hashing of learned codes.

Vectors get one more component that makes all norms equal, so the largest inner product is
the smallest angle; principal axes, rotated so that signs lose least, turn them into codes
of up to 64 bits. The axes and the search radius are learned on a bounded sample
(``SAMPLE`` vectors, chosen by a hash of their ids); every vector is coded and indexed.

Codes are split into substrings of ``SUBSTRING`` bits, each with an index of its own from
substring to vectors. Within a Hamming radius ``r``, two codes with ``m`` substrings differ
by at most ``r // m`` bits in one of them, and by one less in one of the later ones once
the first ``r % m + 1`` have failed; probing all substrings in those reaches retrieves
every code within the radius. Codes retrieved are filtered by their full distance, and
those left are ranked by their original vectors in double precision.

The query set meets all rows in blocks: a block of vectors with a block of queries is one
unit of work, so no more than two blocks are ever together. Each unit returns its best
``k``; the best of those are the result. The radius is the smallest that keeps
``RECALL`` of the sample's true neighbours; recall against brute force is measured in the
tests. Queries that find fewer than ``k`` within it, as vectors do that lie apart where most
are in tight groups, are asked once more with a radius that covers all codes.

Defined results: vectors that are null, empty, zero, of another length than most of the
sample's, or hold null or non-finite components take no part, as query or candidate. A
null id takes no part. Rows of the query's own id are no candidates; other rows that
repeat an id are candidates each. Ties go to the smaller id. Fewer than ``k`` are
returned only where the table has fewer candidates. Of a table without rows comes none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlane.session import fresh_path

SAMPLE, RECALL = 8192, 0.98
SUBSTRING = 8
VECTORS, QUERIES = 4096, 2048


@dataclass
class Codes:
    """Axes (one column per bit), centre, the common norm, and the search radius."""

    dim: int
    norm: float
    centre: np.ndarray
    axes: np.ndarray
    radius: int = 0

    @property
    def substrings(self) -> int:
        return -(-self.axes.shape[1] // SUBSTRING)

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Unit vectors whose angles order as the inner products do."""
        if query:
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            return np.concatenate([unit, np.zeros((len(x), 1))], 1)
        rest = np.sqrt(np.maximum(1 - (x * x).sum(1, keepdims=True) / self.norm**2, 0))
        return np.concatenate([x / self.norm, rest], 1)

    def of(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Codes as rows of bytes."""
        return np.packbits((self.lifted(x, query) - self.centre) @ self.axes > 0, axis=1)


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda v: v != 0)


def _rotation(x: np.ndarray, bits: int, rounds: int = 30) -> np.ndarray:
    """Principal axes, rotated towards the corners of the cube."""
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    axes = axes[:bits].T
    y = x @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((y.shape[1],) * 2))
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(y @ turn > 0, 1.0, -1.0).T @ y)
        turn = (u @ v).T
    return axes @ turn


def learn(sample: np.ndarray, norm: float, rows: int, k: int) -> Codes:
    codes = Codes(sample.shape[1], norm, np.zeros(0), np.zeros((0, 0)))
    lifted = codes.lifted(sample, False)
    codes.centre = lifted.mean(0)
    codes.axes = _rotation(lifted - codes.centre, min(64, sample.shape[1]))
    bits = codes.axes.shape[1]
    if rows <= max(64, k + 1):
        codes.radius = bits
        return codes
    asked = sample[:256]
    scores = asked @ sample.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    true = np.argsort(-scores, axis=1)[:, :k]
    distance = np.bitwise_count(codes.of(asked, True)[:, None] ^ codes.of(sample, False)[true]).sum(2)
    codes.radius = int(np.quantile(distance, RECALL, method="higher"))
    return codes


def reaches(radius: int, substrings: int) -> list[int]:
    """How far to probe each substring so that no code within the radius is missed; -1: not at all."""
    each, more = divmod(radius, substrings)
    return [each if i <= more else each - 1 for i in range(substrings)]


class Index:
    """The substrings of one block's codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(c, kind="stable") for c in codes.T]
        self.sizes = [np.bincount(c, minlength=256) for c in codes.T]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code is within the radius."""
        found = np.zeros(len(self.codes), bool)
        for i, reach in enumerate(reaches(radius, len(code))):
            if reach >= 0:
                probed = np.bitwise_count(ALL_BYTES ^ code[i]) <= reach
                found[self.order[i][np.repeat(probed, self.sizes[i])]] = True
        rows = np.flatnonzero(found)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(1) <= radius]


ALL_BYTES = np.arange(256, dtype=np.uint8)


def _blocks(rows: DataFrame, dim: int, most: int) -> DataFrame:
    """``ids, vectors`` of up to ``most`` rows each, both binary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, held = [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([np.concatenate(ids).tobytes()]), pa.array([np.concatenate(vectors).tobytes()]),
            ], names=["ids", "vectors"])

        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                ids.append(part.column(0).to_numpy())
                vectors.append(part.column(1).flatten().to_numpy().astype("<f8"))
                held += part.num_rows
                if held >= most:
                    yield block()
                    ids, vectors, held = [], [], 0
        if held:
            yield block()

    return rows.filter(F.size("vector") == dim).select("id", "vector").mapInArrow(run, "ids binary, vectors binary")


def search(
    table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row that ``is_query`` tells."""
    spark = table.sparkSession
    rows = table.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    drawn = rows.select("id", "vector").orderBy(F.xxhash64("id", F.lit("axes")), "id").limit(SAMPLE).toArrow()
    if not drawn.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vectors = drawn["vector"].to_pylist()
    lengths = [len(v) for v in vectors]
    dim = max(set(lengths), key=lambda n: (lengths.count(n), n))
    sample = np.array([v for v in vectors if len(v) == dim])
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v))
    facts = rows.filter(F.size("vector") == dim).agg(
        F.max(norm).alias("norm"), F.count(F.lit(1)).alias("n"), F.sum(F.col("asks").cast("long")).alias("asks")
    ).first()
    codes = learn(sample, facts.norm, facts.n, k)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def unit(ids: bytes, vectors: bytes, q_ids: list, q_vectors: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
        own = np.frombuffer(ids, np.int64)
        x = np.frombuffer(vectors, "<f8").reshape(len(own), dim)
        q = q_vectors.reshape(len(q_ids), dim)
        index, asked_codes = Index(codes.of(x, False)), codes.of(q, True)
        out: list[tuple] = []
        for name, vector, code in zip(q_ids, q, asked_codes, strict=True):
            near = index.within(code, radius)
            near = near[own[near] != name]
            score = x[near] @ vector
            if len(near) > k:
                least = np.partition(score, len(score) - k)[len(score) - k]
                near, score = near[score >= least], score[score >= least]
            best = np.lexsort((own[near], -score))[:k]
            out.append((np.full(len(best), name, np.int64), own[near[best]], score[best]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])

    def nearest(asked: DataFrame, n: int, radius: int) -> DataFrame:
        """The best ``k`` within the radius for ``n`` rows ``id, vector``."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    one = batch.slice(row, 1)
                    yield from unit(
                        one.column(0)[0].as_py(), one.column(1)[0].as_py(),
                        one.column(2)[0].values.to_numpy().tolist(), one.column(3)[0].values.to_numpy(), radius,
                    )

        # Query blocks are numbered by a hash of the id, and met by every block of vectors.
        groups = max(1, -(-n // QUERIES))
        shares = max(1, parts // groups)
        queries = (
            asked.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups))).groupBy("group")
            .agg(F.collect_list(F.struct("id", "vector")).alias("all"))
            .select("group", F.transform("all", lambda q: q["id"]).alias("q_ids"), F.flatten(F.transform("all", lambda q: q["vector"])).alias("q_vectors"))
            .withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
        )
        blocks = (
            _blocks(rows, dim, VECTORS)
            .withColumn("share", F.pmod(F.xxhash64("ids"), F.lit(shares)).cast("int"))
            .withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
        )
        met = blocks.join(queries, ["group", "share"]).select("ids", "vectors", "q_ids", "q_vectors")
        found = met.mapInArrow(run, "query_id long, vec_id long, score double")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
            "query_id", "rank", "vec_id", "score"
        )

    def stored(frame: DataFrame, name: str) -> DataFrame:
        path = fresh_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    asked = rows.filter("asks").filter(F.size("vector") == dim).select("id", "vector")
    first = nearest(asked, facts.asks or 0, codes.radius)
    bits = codes.axes.shape[1]
    if codes.radius >= bits:
        return first
    first = stored(first, "nearest")
    whole = first.filter(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = stored(asked.join(whole, "id", "left_anti"), "short-of-neighbours")
    n = short.count()
    if not n:
        return first
    again = nearest(short, n, bits)
    return first.join(whole, F.col("query_id") == F.col("id"), "left_semi").unionByName(again)
