"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from starlane.llm import piece_bpe
from starlane.llm.queries import op13_sentencepiece

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "\n", "a", " a", "a ", "a  b\t\n c", "a▁b", "▁", "<s>x</s>", "<0x0A>", "<unk>", "a\x00b", "漢字 12 é́ ﬁ 😀",
    "=" * 100, " " * 100, "ab" * 3000, "long word " * 9000, "x" * 40_000,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def coder():
    return piece_bpe.coder(piece_bpe.read_model(PATH))


def random_texts(library, seed, n):
    rng = random.Random(seed)
    alphabet = [" ", " ", "\n", ".", ",", "a", "b", "the", "é", "漢", "▁", "<s>", "😀", "́", "ﬁ", "--", "1", "\x00", "ти"]
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32_000)]
    for _ in range(n):
        yield "".join(rng.choices(alphabet, k=rng.randrange(40)))
        yield "".join(rng.choices(pieces, k=rng.randrange(8)))


def test_ids_equal_the_library(library, coder):
    texts = ODD + list(random_texts(library, 1, 3000)) + [" " * n for n in range(70)] + ["a" * n for n in range(70)]
    ids, counts = coder.documents(pa.array(texts))
    found = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert found == library.encode(texts, add_bos=True, add_eos=True)


def test_every_piece_alone_and_by_a_neighbour(library, coder):
    """Each piece's own text, and texts of two pieces with a common border, so that the search goes back."""
    rng = random.Random(2)
    pieces = sorted(coder.reached)
    texts = [p.replace("▁", " ") for p in pieces] + [
        (rng.choice(pieces) + rng.choice(pieces)).replace("▁", " ") for _ in range(20_000)
    ]
    ids, counts = coder.documents(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == library.encode(texts, add_bos=True, add_eos=True)


def test_memories_may_be_cleared(library, coder, monkeypatch):
    monkeypatch.setattr(piece_bpe, "PAIRS", 10)
    monkeypatch.setattr(piece_bpe, "WORDS", 5)
    texts = list(random_texts(library, 3, 50))
    for text in texts:
        assert coder.documents(pa.array([text]))[0].tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_rows(table, library):
    rows = list(enumerate(ODD)) + [(None, "no id"), (900, None)]
    found = piece_bpe.decode(piece_bpe.encode(table(rows, repeat=2), PATH), PATH).collect()
    want = []
    for name, text in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want += [(name, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids))] * 2
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in found), key=repr) == sorted(want, key=repr)
    at_once = piece_bpe.encode(table(rows, repeat=2), PATH, decoded=True).collect()
    assert sorted(map(tuple, at_once), key=repr) == sorted(map(tuple, found), key=repr)
    assert piece_bpe.decode(piece_bpe.encode(table([]), PATH), PATH).count() == 0
    assert piece_bpe.encode(table([]), PATH, decoded=True).count() == 0


def test_any_ids_are_decoded(spark, library):
    rng = random.Random(4)
    rows = [[rng.choice([0, 1, 2, 198, 3, 240, 130, 259, 28705, rng.randrange(32_000)]) for _ in range(rng.randrange(9))] for _ in range(300)]
    rows.append([])
    coded = spark.createDataFrame(
        [(i, len(r), bytearray(np.array(r, "<u4").tobytes())) for i, r in enumerate(rows)], "doc_id long, n_tokens long, ids binary"
    )
    found = {r.doc_id: r.decoded for r in piece_bpe.decode(coded, PATH).collect()}
    assert found == {i: library.decode(r) for i, r in enumerate(rows)}


def test_query(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = op13_sentencepiece(spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
