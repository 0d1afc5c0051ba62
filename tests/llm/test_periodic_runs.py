"""Periodic runs against a search of every period."""

import hashlib
import random
import re
import time
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from starlane.llm import periodic_runs, queries


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(words):
    """(start, length, period) of all runs, by comparing words q apart for every q."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            alphabet = "abcdefgh"[:rng.randrange(1, 8)]
            root = rng.choices(alphabet, k=rng.choice([1, 1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 40]))
            stretch = root * rng.randrange(1, 12)
            stretch = stretch[:len(stretch) - rng.randrange(len(root))]
            if rng.random() < 0.3:
                stretch[rng.randrange(len(stretch))] = "x"
            parts += stretch + rng.choices("abcdefgh", k=rng.randrange(4))
        yield rng.choice([" ", "\n", " \t "]).join(parts)


ODD = [
    "", " ", "\n\n", "a", "a " * 23, "a " * 24, " a" * 25, "a b " * 12, "a b " * 11 + "a", "é 漢 " * 20, "a\x00b c " * 9,
    "x" * 100_000, "A a " * 20, "one two three four five six seven eight nine " * 3, "\x1c a " * 30,
]


def test_rows_equal_brute_force(table):
    rows = list(enumerate([*ODD, *texts(1, 400)])) + [(None, "b a " * 20), (9000, None)]
    found = periodic_runs.find_runs(table(rows, repeat=2)).collect()
    want = []
    for name, text in rows:
        words = words_of(text)
        runs = brute(words)
        want += [(name, len(words), runs, collapsed(words, runs))] * 2
    got = [(r.doc_id, r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert periodic_runs.find_runs(table([])).count() == 0


def test_small_tiles(table, monkeypatch):
    """Runs over many tiles are stitched."""
    monkeypatch.setattr(periodic_runs, "TILE", 16)
    rows = list(enumerate(texts(2, 200)))
    found = periodic_runs.find_runs(table(rows)).collect()
    assert {r.doc_id: [(x.start, x.length, x.period) for x in r.runs] for r in found} == {i: brute(words_of(t)) for i, t in rows}


def tiled(text):
    """All tiles of a text, with their sizes."""
    own = periodic_runs.Words(pa.array([text]))
    low, _, at = periodic_runs.cells(own.numbers, own.counts)
    return [
        (octave, base, places, numbers) for octave in sorted(set(low.tolist()))
        for base, places, numbers in periodic_runs.tiles(octave, at[low == octave], own.numbers)
    ]


def test_long_texts_take_near_linear_time_and_many_tiles():
    rng = random.Random(3)
    root = [f"w{rng.randrange(50)}" for _ in range(7000)]
    for text in (" ".join(["a"] * 100_000), " ".join((["a"] * 40 + ["b"]) * 2500), " ".join(root * 12)):
        begin = time.perf_counter()
        pieces = tiled(text)
        fragments = sum(len(x) for o, _, c, n in pieces for x in periodic_runs.solve(o, c, n).values())
        assert len(pieces) > 20 and fragments < 20_000
        assert time.perf_counter() - begin < 30


def test_long_run_of_a_long_period(table):
    rng = random.Random(4)
    root = [f"w{rng.randrange(9)}" for _ in range(9001)]
    words = ["start", *(root * 5)[:-17], "end"]
    row = periodic_runs.find_runs(table([(1, " ".join(words))])).collect()[0]
    assert [tuple(x) for x in row.runs if x.period > 100] == [(1, 9001 * 5 - 17, 9001)]
    assert len(words_of(row.collapsed)) <= 9003


def test_texts_without_repeats_are_not_staged():
    assert tiled(" ".join(map(str, range(5000)))) == []


@pytest.mark.parametrize("n", [0, 1, 2, 17, 200])
def test_z_function(n):
    x = np.random.default_rng(n).integers(0, 2, n).tolist()
    want = [0] + [next((k for k in range(n - i) if x[k] != x[i + k]), n - i) for i in range(1, n)]
    assert periodic_runs.z_function(x) == want[:n]


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.op11_periodic_runs(spark, sf_dir).collect()
    assert len(found) == len(docs)
    for r in found:
        words, h = words_of(docs[r.doc_id]), crc32(str(r.doc_id).encode())
        if h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(len(words))]
        runs = brute(words)
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        s, n, q = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period, r.exponent_milli) == (s, n, q, None if n is None else 1000 * n // q)
