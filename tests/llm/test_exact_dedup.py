import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starlane.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        best = max((x for x in ids if x is not None), default=None)
        out.append((i, best, len(ids), i == best, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def some_rows(seed=1):
    rng = random.Random(seed)
    texts = ["", "a", "a.", "b" * 9000, "b" * 8999 + "c", "é ü\n" * 800, "x. " * 4000, "x. " * 4000 + "y"]
    texts += ["".join(rng.choices("ab. \n", k=rng.randrange(3000))) for _ in range(20)]
    rows = [(i, rng.choice(texts)) for i in range(120)]
    return rows + [(None, "a"), (None, "only"), (200, None), (201, "")]


@pytest.mark.parametrize("identify", [F.xxhash64, lambda c: F.length(c).cast("long"), lambda c: F.lit(1).cast("long")])
def test_equals_brute_force_whatever_the_identifiers(table, identify):
    rows = some_rows()
    found = exact_dedup.find_copies(table(rows), identify=lambda c: identify(c))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows)


def test_chunks_make_up_the_text(spark):
    texts = [t for _, t in some_rows() if t]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select("t", exact_dedup.chunks(F.col("t")).alias("c")).collect()
    assert all("".join(r.c) == r.t and max(map(len, r.c)) <= exact_dedup.MAX_CHUNK for r in rows)


def test_empty_table_and_repeated_rows(table):
    assert exact_dedup.find_copies(table([])).count() == 0
    assert exact_dedup.drop_copies(table([])).count() == 0
    docs = table([(1, "t"), (2, "t"), (3, None)], repeat=3)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert {r.kept for r in kept.collect()} == {"x"}
