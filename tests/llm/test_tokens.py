import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starlane.llm import bpe, packing, range_coder, token_files
from starlane.session import fresh_path

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", " ", "a", "it's  A\n\nB.", "<|endoftext|>x <|startoftext|> y", "é́ ü", " x 　 漢字 12", "a.b,c. d\r\ne", "\x1c a\x85b"]


def rows(seed=1):
    rng = random.Random(seed)
    alphabet = [" ", " ", "\n", ".", ",", "a", "Bc", "é", "'s", "1", "<|endoftext|>", "́", "漢", "ß", "　"]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(150)] + ["long word " * 9000]
    return list(enumerate(texts)) + [(None, "no id"), (1000, None)]


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def digest(ids):
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_word_table_equals_the_library(table):
    library = Tokenizer.from_file(WORD)
    found = bpe.decode(bpe.encode(table(rows(), repeat=2), WORD), WORD).collect()
    want = []
    for name, text in rows():
        ids = ids_of(library, text)
        want += [(name, len(ids), digest(ids), library.decode(ids, skip_special_tokens=False))] * 2
    assert sorted(((r.doc_id, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), r.decoded) for r in found), key=repr) == sorted(want, key=repr)
    assert bpe.decode(bpe.encode(table([]), WORD), WORD).count() == 0


def test_files_give_back_what_was_written(spark, table):
    library = Tokenizer.from_file(BYTE)
    path = fresh_path(spark, "tokens")
    token_files.write(table(rows()), path, BYTE)
    found = token_files.read(spark, path).orderBy("start").collect()
    start = 0
    for r, (name, text) in zip(found, sorted(rows(), key=lambda r: -1 if r[0] is None else r[0]), strict=True):
        ids = [*ids_of(library, text), 2]
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids)) == (name, start, len(ids), np.array(ids, "<u4").tobytes())
        start += len(ids)
    path = fresh_path(spark, "tokens")
    token_files.write(table([]), path, BYTE)
    assert token_files.read(spark, path).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000, 30_000])
@pytest.mark.parametrize("alphabet", [1, 2, 300, 50_257])
def test_coder_round_trip(n, alphabet):
    rng = np.random.default_rng(n + alphabet)
    ids = np.minimum(rng.zipf(1.3, n) - 1, alphabet - 1).astype(np.uint32)
    block = range_coder.encode(ids)
    assert (range_coder.decode(block) == ids).all()
    if n:
        broken = bytearray(block)
        broken[-1] ^= 1
        with pytest.raises(ValueError):
            range_coder.decode(bytes(broken))


def test_coder_beats_plain_ids_on_text():
    library = Tokenizer.from_file(BYTE)
    ids = np.array(ids_of(library, "the model learns which id follows which, and the mix adapts. " * 800), np.uint32)
    assert len(range_coder.encode(ids)) < len(ids)


def check_pieces(pieces, documents, capacity):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert p.length > 0 and len(p.ids) == 4 * p.length
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for name, ids in documents.items():
        parts = sorted(by_doc[name], key=lambda p: p.start)
        assert [p.start for p in parts] == list(np.cumsum([0] + [p.length for p in parts])[:-1])
        assert b"".join(bytes(p.ids) for p in parts) == np.array(ids, "<u4").tobytes()
        assert {p.doc_tokens for p in parts} == {len(ids)}
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == list(np.cumsum([0] + [p.length for p in parts])[:-1])
        assert sum(p.length for p in parts) <= capacity
    return by_sequence


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pieces_cover_every_id_once(table, capacity):
    library = Tokenizer.from_file(WORD)
    docs = [(i, t) for i, t in rows() if i is not None]
    pieces = packing.pack(table(docs).coalesce(1), WORD, capacity=capacity).collect()
    sequences = check_pieces(pieces, {i: [*ids_of(library, t), 1] for i, t in docs}, capacity)
    total = sum(p.length for p in pieces)
    assert len(sequences) == -(-total // capacity)  # one shard: less than one sequence of padding
    assert packing.pack(table([]), WORD).count() == 0


def test_cheapest_sequence_first():
    # Three sequences: the long pieces are spread before the short ones fill up.
    pieces = packing.assign(np.array([60, 60, 60, 30, 30, 30, 10, 10, 10]), 100)
    by = {}
    for doc, _, n, seq, _ in pieces:
        by.setdefault(seq, []).append(n)
    assert sorted(map(sorted, by.values())) == [[10, 30, 60]] * 3
    assert packing.assign(np.array([250]), 100) == [(0, 0, 100, 0, 0), (0, 100, 100, 1, 0), (0, 200, 50, 2, 0)]


def test_null_id_is_kept(table):
    assert [(r.doc_id, r.n) for r in packing.pack(table([(None, "a"), (None, None)]), WORD).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()] == [(None, 3)]
    assert zlib.crc32(b"") == 0


def test_an_encoder_goes_before_work_that_needs_none():
    import pyarrow as pa

    from starlane.llm import ngram_join, word_ids

    word_ids.encoder(word_ids.read_spec(BYTE), word_ids.byte_level_cuts).pieces(["one", " two"])
    assert word_ids._encoders
    list(ngram_join._fresh_sets(iter([pa.record_batch([["one two"]], ["text"])]), 5))
    assert not word_ids._encoders


def test_a_word_before_a_stop_is_one_piece_with_the_word():
    import pyarrow as pa

    from starlane.llm import word_ids

    library, text = Tokenizer.from_file(BYTE), "a word. a word, a word it's. 'll. x<|endoftext|>.a.b, \n.c 1. 2,3 é. a..b"
    coder = word_ids.Encoder(word_ids.read_spec(BYTE), word_ids.byte_level_cuts)
    ids, _ = coder.texts(pa.array([text]))
    assert ids.tolist() == ids_of(library, text)
    assert " word" in coder.known and " word." not in coder.known
