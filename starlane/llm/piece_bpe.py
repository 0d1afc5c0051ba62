"""SentencePiece merge-type (BPE) encoding by backtracking, and decoding.

Pieces of a merge-type model are ranked; the encoding that merging gives is the one
sequence of pieces in which each adjacent pair, merged anew from its characters, comes out
as that very pair. So it is searched for, not merged: an Aho-Corasick automaton over all
pieces finds the longest piece at each place of a word; the search takes the longest piece
that is compatible with the one before it, shorter ones after it, and goes back a piece
where none is left. A bit field marks the places from which no way leads on, so no place
fails twice and the work is linear in the word. The verdict on a pair of pieces is found by
re-merging their text once and remembered.

Texts are cut where no piece of the vocabulary holds the two neighbouring bytes in a row,
so nothing merges across a cut; each distinct word of a task is encoded once, as long as
the task's bounded memory lasts, and ids are laid out by position with array operations. There
is no shuffle. Characters without a piece become their UTF-8 bytes' pieces.

Defined results: null counts as empty; an empty text has the begin and end ids alone and
decodes to the empty text. Of a text in one piece, of any length, the same holds as of any
other. Repeated rows come out repeated, a null id is kept, of a table without rows comes
none. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.llm.word_ids import Encoder, slices

SPACE = "▁"  # how pieces write a space
WORDS, PAIRS = 200_000, 300_000  # words, and verdicts on pairs, that a worker remembers
TEXT = 2 << 20  # bytes of text encoded at once
TOGETHER = 1 << 18  # ids decoded at once


class Pieces:
    """The pieces of a model, as far as merging and laying out need them."""

    def __init__(self, model: bytes):
        self.library = library = sentencepiece.SentencePieceProcessor(model_proto=model)
        probe = " a  b\t▁ﬁ"
        if library.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("made for models that leave texts as they are, behind one leading space")
        ids = range(library.get_piece_size())
        self.texts = [library.id_to_piece(i) for i in ids]
        self.begin, self.end = library.bos_id(), library.eos_id()
        self.byte = {int(self.texts[i][3:5], 16): i for i in ids if library.is_byte(i)}
        own = [i for i in ids if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))]
        # Merging joins the pair of the highest score, the leftmost of several.
        self.score = {self.texts[i]: library.get_score(i) for i in own}
        self.id_of = {self.texts[i]: i for i in own}
        if {c for piece in self.score for c in piece} - self.score.keys() or len(self.byte) != 256:
            raise ValueError("made for models in which each character, and each byte, has a piece")

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, by merging."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = score.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def joined(self) -> np.ndarray:
        """Which two bytes stand in a row in some piece, or in one character; spaces as in texts."""
        out = np.zeros((256, 256), bool)
        for piece in self.score:
            data = np.frombuffer(piece.replace(SPACE, " ").encode(), np.uint8)
            out[data[:-1], data[1:]] = True
        out[:, 0x80:0xC0] = True
        return out

    def layout(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that each id stands for, in a row, and how many each has."""
        plain = [b"" if self.library.is_control(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(self.texts)]
        for value, i in self.byte.items():
            plain[i] = bytes([value])
        return np.frombuffer(b"".join(plain), np.uint8), np.array([len(p) for p in plain], np.int64)


class Backtracker(Encoder):
    """Words to ids, and the words a task has met."""

    def __init__(self, model: bytes):
        self.model = model_pieces = Pieces(model)
        joined = model_pieces.joined()
        self.cuts = lambda data: np.flatnonzero(~joined[data[:-1], data[1:]]) + 1
        self.known: dict[str, int] = {}
        self.ids: list[np.ndarray] = [np.zeros(0, np.uint32)]
        self.sizes: list[np.ndarray] = [np.zeros(0, np.int64)]
        # A piece that merging its own text does not give is never reached.
        self.reached = {p for p in model_pieces.score if model_pieces.merged(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for piece in self.reached:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.shorter = {p: self._prefix(p) for p in self.reached}
        self.verdicts: dict[tuple[str, str], bool] = {}

    def _prefix(self, piece: str) -> str | None:
        """The longest other piece that ``piece`` begins with."""
        return next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.reached), None)

    def compatible(self, left: str, right: str) -> bool:
        known = self.verdicts.get((left, right))
        if known is None:
            if len(self.verdicts) > PAIRS:
                self.verdicts.clear()
            known = self.verdicts[left, right] = self.model.merged(left + right) == [left, right]
        return known

    def word(self, text: str) -> list[str]:
        """The pieces of a text of characters that have pieces."""
        end = len(text)
        longest: list[str] = [""] * end
        for at, piece in self.automaton.iter(text):  # by where they end, so longer ones come later
            longest[at - len(piece) + 1] = piece
        compatible, shorter = self.verdicts, self.shorter
        open_places = bytearray(b"\1") * (end + 1)
        found: list[str] = []
        place, piece = 0, longest[0] if end else None
        while place < end:
            last = found[-1] if found else None
            while piece is not None:
                if open_places[place + len(piece)]:
                    fits = last is None or compatible.get((last, piece))
                    if fits is None:
                        fits = self.compatible(last, piece)
                    if fits:
                        break
                piece = shorter[piece]
            if piece is not None:
                found.append(piece)
                place += len(piece)
                piece = longest[place] if place < end else None
            elif last is None:
                raise RuntimeError(f"no encoding of {text!r}")
            else:
                open_places[place] = 0
                found.pop()
                place -= len(last)
                piece = shorter[last]
        return found

    def pieces(self, found: list[str]) -> np.ndarray:
        if len(self.known) > WORDS:
            self.known.clear()
            self.ids, self.sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        return super().pieces(found)

    def encode(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each has."""
        id_of, byte, score = self.model.id_of, self.model.byte, self.model.score
        ids: list[int] = []
        sizes = np.zeros(len(found), np.int64)
        before = 0
        for k, text in enumerate(found):
            text = text.replace(" ", SPACE)
            if text in self.reached:
                ids.append(id_of[text])
            elif all(map(score.__contains__, text)):
                ids.extend(map(id_of.__getitem__, self.word(text)))
            else:
                start = 0
                for at, character in enumerate(text):
                    if character not in score:  # merges with nothing
                        ids.extend(map(id_of.__getitem__, self.word(text[start:at])))
                        ids.extend(map(byte.__getitem__, character.encode()))
                        start = at + 1
                ids.extend(map(id_of.__getitem__, self.word(text[start:])))
            sizes[k] = len(ids) - before
            before = len(ids)
        return np.array(ids, np.uint32), sizes

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, with begin and end ids, and how many each text has."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")
        some = pc.greater(pc.binary_length(texts), 0)
        spaced = pc.if_else(some, pc.binary_join_element_wise("", texts, " "), texts)
        ids, counts = self.texts(spaced)
        ends = np.cumsum(counts + 2)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
        inner = np.ones(len(out), bool)
        inner[ends - 1] = inner[ends - counts - 2] = False
        out[ends - counts - 2], out[ends - 1] = self.model.begin, self.model.end
        out[inner] = ids
        return out, counts + 2


_coders: dict[int, Backtracker] = {}


def coder(model: bytes) -> Backtracker:
    """The worker's own coder; it outlives a task."""
    key = hash(model)
    if key not in _coders:
        _coders.clear()
        _coders[key] = Backtracker(model)
    return _coders[key]


def read_model(path: str) -> bytes:
    """A model (half a megabyte), read on the driver and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


class Decoder:
    """Ids to texts, many at once."""

    def __init__(self, pieces: Pieces):
        self.library = pieces.library
        self.flat, self.sizes = pieces.layout()
        self.first = np.cumsum(self.sizes) - self.sizes

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> Iterator[str]:
        """The text of each run of ``counts`` ids, without the first piece's leading space."""
        stops = np.cumsum(counts)
        starts = stops - counts
        at = 0
        while at < len(counts):
            to = max(at + 1, int(np.searchsorted(stops, starts[at] + TOGETHER, "right")))
            some = ids[starts[at]:stops[to - 1]]
            n = self.sizes[some]
            ends = np.cumsum(n)
            whole = self.flat[np.repeat(self.first[some] - (ends - n), n) + np.arange(n.sum())].tobytes()
            edges = np.concatenate([[0], ends])[np.concatenate([[0], stops[at:to] - starts[at]])].tolist()
            unknown = (some == self.library.unk_id()).any()
            for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False), at):
                try:
                    if unknown:
                        raise UnicodeError
                    yield whole[a + whole.startswith(b" ", a, b):b].decode()
                except UnicodeError:
                    yield self.library.decode(ids[starts[k]:stops[k]].tolist())
            at = to


def encode(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """``doc_id, n_tokens, ids`` by the model at this path; ``ids`` holds little-endian unsigned 32-bit integers.

    With ``decoded`` the column of ``decode`` too, by the task that has the ids.
    """
    data = read_model(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(data)
        decoder = Decoder(own.model)
        for batch in batches:
            for part in slices(batch, 1, TEXT):
                ids, counts = own.documents(part.column(1))
                ends = 4 * np.cumsum(counts)
                flat = ids.astype("<u4").tobytes()
                rows = [flat[a:b] for a, b in zip((ends - 4 * counts).tolist(), ends.tolist(), strict=True)]
                columns = {"doc_id": part.column(0), "n_tokens": pa.array(counts), "ids": pa.array(rows, pa.binary())}
                if decoded:
                    columns["decoded"] = pa.array(decoder.texts(ids, counts), pa.string())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_tokens long, ids binary" + ", decoded string" * decoded)


def decode(coded: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` with ``decoded``: the text of the pieces, without the first one's leading space.

    Control ids stand for nothing. The library decodes texts with its unknown id, or with bytes that make no UTF-8.
    """
    data = read_model(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Pieces(data))
        for batch in batches:
            own = [np.frombuffer(x, "<u4") for x in batch.column(2).to_pylist()]
            counts = np.array([len(x) for x in own], np.int64)
            ids = np.concatenate(own) if own else np.zeros(0, np.uint32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoder.texts(ids, counts), pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"]
            )

    return coded.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
