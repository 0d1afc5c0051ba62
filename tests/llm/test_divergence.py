"""The divergence audit against whole numbers of Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from starlane.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least_docs, top):
    docs, groups = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = TERM.findall((text or "").translate(UPPER))
        docs[lang or ""].update(set(found))
        groups[lang or "", source or ""].update(found)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        sources = sorted(s for name, s in groups if name == lang)

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        own = {s: shares(groups[lang, s]) for s in sources}
        common = shares(sum((groups[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(own[s][t] - own[o][t]) for t in kept), o) for o in sources if o != s]
            more = [(own[s][t] - common[t], t) for t in kept if groups[lang, s][t] and own[s][t] > common[t]]
            for part, values, limit in (("pair", pairs, None), ("term", more, top)):
                values.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(values[:limit])]
    return sorted(out)


def frame(spark, rows):
    wide = [(i, *r, 1, "x", 2) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        wide, "doc_id long, lang string, source string, text string, n long, term string, total long"
    ).repartition(3)


def documents(seed, n):
    rng = random.Random(seed)
    words = ["a", "A", "bee", "Bee", "it's", "é", "É", "漢字", "x1y", "_z_", "\x7f", "über", "\x00nul\x00", "[q]"]
    for _ in range(n):
        text = rng.choice([" ", "\n", "-", "9"]).join(rng.choices(words, weights=range(1, 15), k=rng.randrange(12)))
        yield rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s3", "S", "é", None, ""]), rng.choice([text, text, text, "", None])


@pytest.mark.parametrize("least_docs", [1, 4, 10_000])
def test_rows_equal_brute_force(spark, least_docs):
    rows = [*documents(1, 300), ("only", "one", "a a a"), ("only", "none", None), ("only", "none", "9 9"), *[("en", "s1", "same text")] * 50]
    found = [tuple(r) for r in divergence.audit(frame(spark, rows), least_docs=least_docs, top=3).collect()]
    assert sorted(found) == brute(rows, least_docs, 3)


def test_many_blocks_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 3)
    monkeypatch.setattr(divergence, "TOGETHER", 2)
    rows = [*documents(2, 200), ("en", "long", "one two three " * 50_000)]
    found = [tuple(r) for r in divergence.audit(frame(spark, rows), least_docs=1).collect()]
    assert sorted(found) == brute(rows, 1, 50)


def test_one_group_and_no_rows(spark):
    assert [tuple(r) for r in divergence.audit(frame(spark, [("en", "s", "b a")]), least_docs=1).collect()] == []
    assert divergence.audit(frame(spark, [])).count() == 0


def test_shares_are_exact_and_never_overflow():
    counts = np.array([0, 1, 7, 10**12, 8 * 10**15])
    for total, n in ((8 * 10**15, 10), (10**15, 10**6), (4, 1), (0, 3)):
        few = counts[counts <= total]
        assert divergence.shares(few, total, n).tolist() == [1 + 10**9 * (int(c) + 5) // (total + 5 * n) for c in few]
    with pytest.raises(OverflowError):
        divergence.shares(counts, 9 * 10**15, 1)


def test_galloping():
    rng = np.random.default_rng(1)
    for n, m in ((0, 5), (5, 0), (3, 1000), (1000, 3), (50, 50)):
        a, b = (np.unique(rng.integers(0, 200, k)) for k in (n, m))
        here, there = divergence.gallop(a, b)
        assert a[here].tolist() == b[there].tolist() == sorted(set(a) & set(b))


def test_terms_of_texts_do_not_run_together():
    coded, text = divergence.terms(pa.array(["ab", "Cd e", None, "", "é1é"]))
    assert [(coded[i].as_py(), int(t)) for i, t in enumerate(text)] == [("ab", 0), ("cd", 1), ("e", 1), ("é", 4), ("é", 4)]
