"""The pipeline, stage by stage, against brute force on each stage's own input."""

import random

import public_tokenizers
import pytest
from test_exact_dedup import brute as exact_groups
from test_ngram_join import brute as near_groups
from test_tokens import check_pieces, ids_of
from tokenizers import Tokenizer

import corpus_pipeline
from starlane.llm import pii, toxicity
from starlane.session import fresh_path

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    rng = random.Random(11)
    syllables = ["an", "the", "in", "er", "on", "re", "at", "is", "ou", "ed", "sh", "ble"]
    rows, toxic = [], []
    for i in range(600):
        found = ["".join(rng.choices(syllables, k=rng.randrange(1, 5))) for _ in range(rng.randrange(40, 120))]
        if i % 5 == 0:
            found = [rng.choice(["scumbag", "wretch", "moronic", "vile"]) if rng.random() < 0.15 else w for w in found]
            toxic.append(i)
        if i % 7 == 0:
            found.insert(3, f"user{i % 70}@mail{i % 3}.example.com")
        rows.append((i, " ".join(found)))
    for i in range(600, 680):
        words = rows[rng.randrange(1, 500)][1].split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words)))
    rows += [(700, None), (701, ""), (702, ""), (None, "no id at all"), (703, rows[1][1]), (703, rows[1][1])]
    return rows, toxic


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    rows, toxic = documents()
    folder = str(tmp_path_factory.mktemp("sf"))
    wide = [(i, t, "en", f"src{n % 3}", len(t or "")) for n, (i, t) in enumerate(rows)]
    spark.createDataFrame(wide, COLUMNS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in set(toxic))) for i in range(600)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    tables = [spark.read.parquet(f"{folder}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, "stage")
        stage(spark, tables[-1], folder).write.parquet(path)
        tables.append(spark.read.parquet(path))
    return folder, tables


def pairs(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)


def test_all_but_the_last_return_the_columns_of_documents(stages):
    _, tables = stages
    assert all(t.columns == tables[0].columns for t in tables[:-1])


def test_toxic_documents_go_and_others_stay(spark, stages):
    folder, (docs, clean, *_) = stages
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scored = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    assert pairs(clean) == [p for p in pairs(docs) if not scored[p[0]]]
    _, toxic = documents()
    gone = {i for i, p in scored.items() if p}
    assert len(gone & set(toxic)) >= 0.9 * len(toxic)
    assert len({i for i in gone if i is not None and i < 600} - set(toxic)) <= 0.03 * 480


def test_one_of_equal_texts_stays(stages):
    _, (_, clean, once, *_) = stages
    rows = pairs(clean)
    keep = {(i, t) for i, t in rows if any(g[0] == i and g[3] and g[1] == i for g in exact_groups(rows) if g[0] == i)}
    best = {}
    for i, t in rows:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    assert {(i, t or "") for i, t in pairs(once)} == {(None if i < 0 else i, t) for t, i in best.items()}
    assert once.count() == len(best) and keep


def test_one_of_near_copies_stays(stages):
    _, (_, _, once, apart, *_) = stages
    rows = pairs(once)
    stay = {i for i, _, c in near_groups(rows) if i == c or i is None}
    assert pairs(apart) == [p for p in rows if p[0] in stay] and len(stay) < len(rows)


def test_private_data_are_replaced(stages):
    _, (_, _, _, apart, private, _) = stages
    before, after = dict(pairs(apart)), dict(pairs(private))
    assert before.keys() == after.keys()
    changed = {i for i in before if before[i] != after[i]}
    assert changed == {i for i, t in before.items() if t and "@" in t}
    assert all("example" not in after[i] for i in changed)
    assert {r.doc_id: r.n_chars for r in private.collect()} == {i: None if t is None else len(t) for i, t in after.items()}
    assert pii.anonymise(private, "other").count() == len(after)


def test_sequences_hold_every_document(stages):
    _, (*_, private, packed) = stages
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: [*ids_of(library, t), 1] for i, t in pairs(private)}
    check_pieces(packed.collect(), want, 2048)


def test_run_applies_all_stages(spark, stages):
    folder, (*_, packed) = stages
    again = corpus_pipeline.run(spark, folder)
    assert again.columns == packed.columns
    assert sorted((r.doc_id or -1, r.start, r.length) for r in again.collect()) == sorted((r.doc_id or -1, r.start, r.length) for r in packed.collect())
