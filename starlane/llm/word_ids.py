"""Texts to token ids inside a task: each distinct piece of text is encoded once.

A batch of texts is cut at places where the tokenizer is sure to cut too, so the ids of
a text are those of its pieces in a row. The pieces are dictionary-encoded, the
dictionary goes through the public ``tokenizers`` library (with a bounded memory of
earlier pieces), and the ids are laid out by position with array operations. Texts are
taken ``SLICE`` bytes at a time, so memory does not depend on a batch's row count; one
longer text makes a slice of its own.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

SLICE = 4 << 20
REMEMBERED, TOGETHER = 600_000, 50

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
STOP = np.zeros(256, bool)
STOP[[ord("."), ord(",")]] = True


def spaced_cuts(data: np.ndarray) -> np.ndarray:
    """Cut before a run of white space, and before a stop or comma behind a letter.

    For tokenizers that drop white space and part letters from other characters.
    """
    space = SPACE[data]
    return np.flatnonzero(space[1:] & ~space[:-1] | STOP[data[1:]] & LETTER[data[:-1]]) + 1


def byte_level_cuts(data: np.ndarray) -> np.ndarray:
    """Cut before a single space, and around a single line end, between plain characters, and
    before a stop or comma behind a letter.

    Plain are printable ASCII and the two-byte characters from U+00C0 on; none is white
    space. Wherever a neighbour is another character the text stays in one piece.
    """
    if len(data) < 3:
        return np.zeros(0, np.int64)
    plain = (data > 32) & (data < 127)
    two = (data >= 0xC3) & (data <= 0xDF)
    ends = plain.copy()  # a plain character ends at this byte
    ends[1:] |= two[:-1]
    starts = plain | two
    alone = np.zeros(len(data), bool)
    alone[1:-1] = ends[:-2] & starts[2:]
    line = alone & (data == 10)
    cut = alone & (data == 32) | line
    cut[1:] |= line[:-1]
    cut[1:] |= STOP[data[1:]] & LETTER[data[:-1]]
    return np.flatnonzero(cut)


class Encoder:
    """One tokenizer and its memory of pieces."""

    def __init__(self, spec: str, cuts: Callable[[np.ndarray], np.ndarray]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cuts = cuts
        # Pieces are encoded many at a time, parted by a special token: the library splits
        # texts at those first, so each piece gets the ids that it has alone.
        self.part_id, part = max(self.tokenizer.get_added_tokens_decoder().items())
        self.part = part.content
        self.known: dict[str, int] = {}
        self.ids: list[np.ndarray] = [np.zeros(0, np.uint32)]
        self.sizes: list[np.ndarray] = [np.zeros(0, np.int64)]

    def pieces(self, found: list[str]) -> np.ndarray:
        """The number of each piece in ``table``."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.ids, self.sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        known = self.known
        new = [p for p in found if p not in known]
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            coded = self.encode(part)
            known.update(zip(part, range(len(known), len(known) + len(part)), strict=True))
            self.sizes.append(coded[1])
            self.ids.append(coded[0])
        return np.fromiter(map(known.__getitem__, found), np.int64, len(found))

    def encode(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in a row, and how many each has."""
        special = [self.part in p for p in found]
        plain = ["" if s else p for p, s in zip(found, special, strict=True)]
        joined = [self.part.join(plain[i:i + TOGETHER]) + self.part for i in range(0, len(plain), TOGETHER)]
        coded = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in coded), np.uint32)
        ends = np.flatnonzero(ids == self.part_id)
        sizes = np.diff(ends, prepend=-1) - 1
        ids = np.delete(ids, ends)
        for i in np.flatnonzero(special):
            own = self.tokenizer.encode(found[i], add_special_tokens=False).ids
            at = int(sizes[:i].sum())
            ids = np.concatenate([ids[:at], np.array(own, np.uint32), ids[at:]])
            sizes[i] = len(own)
        return ids, sizes

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all known pieces in a row, and how many each has."""
        if len(self.ids) > 1:
            self.ids, self.sizes = [np.concatenate(self.ids)], [np.concatenate(self.sizes)]
        return self.ids[0], self.sizes[0]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has; null counts as empty."""
        data, edges = text_bytes(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        cut = np.zeros(len(data) + 1, bool)
        cut[self.cuts(data)] = True
        cut[edges] = True
        at = np.flatnonzero(cut)
        pieces = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data))
        coded = pieces.dictionary_encode()
        number = self.pieces(coded.dictionary.to_pylist())
        flat, sizes = self.table()
        first = (np.cumsum(sizes) - sizes)[number]
        code = coded.indices.to_numpy()
        n = sizes[number][code]
        ends = np.cumsum(n)
        ids = flat[np.repeat(first[code] - (ends - n), n) + np.arange(ends[-1])]
        before = np.concatenate([[0], ends])[np.searchsorted(at, edges)]
        return ids, np.diff(before)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each starts (one more for the end)."""
    texts = texts.fill_null("") if texts.null_count else texts
    large = pa.types.is_large_string(texts.type)
    if not (large or pa.types.is_string(texts.type)):
        texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    edges = np.frombuffer(offsets, np.int64 if large else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[edges[0]:edges[-1]], edges - edges[0]


def slices(batch: pa.RecordBatch, text: int, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``most`` bytes of text, or one row."""
    if not batch.num_rows:
        return
    sizes = np.diff(text_bytes(batch.column(text))[1])
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(at, to - at)
        at = to


_encoders: dict[tuple[int, str], Encoder] = {}


def encoder(spec: str, cuts: Callable[[np.ndarray], np.ndarray]) -> Encoder:
    """The worker's own encoder; it outlives a task."""
    key = (hash(spec), cuts.__name__)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(spec, cuts)
    return _encoders[key]


def forget() -> None:
    """Drops the encoder that an earlier stage has left in this worker (150 MB with its pieces), for tasks that need none."""
    if _encoders:
        _encoders.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def read_spec(path: str) -> str:
    """A tokenizer's description (1 to 2 MB), read on the driver and sent with the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()
