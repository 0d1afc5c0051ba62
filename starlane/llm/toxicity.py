"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled texts: one on windows of ordinary
texts, one on passages of toxic texts; the toxic side is compressed with both together,
so that ordinary words cost the same on either side. A text is cut into windows of whole
words of about ``WINDOW`` bytes, each window is compressed with either side, and the
difference in length is its distance. A text's distances (their mean and sum over some
bounds, and the largest) go through a logistic curve fitted on further labelled texts.

Toxic texts are mostly ordinary words. Passages for the toxic dictionary are therefore
words with a telling stem: one that follows many different words in toxic texts and, in
proportion, far fewer in ordinary ones. How many is enough is what ordinary texts,
posing as toxic, reach by chance. Counting different neighbours instead of texts keeps
copies of one text from making its words look telling. The dictionary's size is the one
of ``SIZES`` that parts the calibration texts best.

Labels are learned from a bounded sample, which the driver holds: at most ``MOST_TOXIC``
and ``MOST_ORDINARY`` rows of at most ``MOST_CHARS`` characters, chosen by a hash of
their ids. Scoring reads whole texts of any length.

Defined results: a null or empty text gets the score of a text without windows. Without
labelled rows of both kinds no model exists, and every score is 1.0 if only toxic ones
are known, else 0.0. Repeated rows are scored alike; a null id is kept and counts as not
held out. Of a table without rows comes none. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.llm.word_ids import forget, slices

WINDOW, LEVEL = 48, 3
BASE = 64 << 10
SIZES = (6 << 10, 5 << 10, 10 << 10)
STEMS = (4, 5, 6)
MOST_TOXIC, MOST_ORDINARY, MOST_CHARS = 2000, 5000, 32_768


@dataclass
class Model:
    """Dictionaries of the two sides, and the logistic curve over a text's features."""

    ordinary: bytes = b""
    toxic: bytes = b""
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    constant: float | None = None  # the score of every text when there is nothing to learn from


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@lru_cache(maxsize=8)
def _compressor(content: bytes) -> zs.ZstdCompressor:
    known = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
    how = zs.ZstdCompressionParameters.from_level(
        LEVEL, dict_size=len(content), source_size=WINDOW, min_match=4, write_content_size=False,
        write_checksum=False, write_dict_id=False, format=zs.FORMAT_ZSTD1_MAGICLESS,
    )
    known.precompute_compress(compression_params=how)
    return zs.ZstdCompressor(dict_data=known, compression_params=how)


def _plain(text: str) -> bytes:
    """Lower-case words with one space around each."""
    return f" {' '.join(text.lower().split())} ".encode(errors="replace")


def windows(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of windows of whole words, each with the spaces around it."""
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    starts = spaces[:-1]
    if not len(starts) or len(text) <= 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(starts // WINDOW, prepend=-1))
    at = starts[first]
    return at, np.append(at[1:], spaces[-1]) + 1 - at


def distances(texts: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The distance of every window, and how many windows each text has."""
    cut = [windows(t) for t in texts]
    counts = np.array([len(a) for a, _ in cut], np.int64)
    if not counts.sum():
        return np.zeros(0), counts
    before = np.cumsum([0, *map(len, texts)][:-1])
    segments = np.stack([
        np.concatenate([a + b for (a, _), b in zip(cut, before, strict=True)]),
        np.concatenate([n for _, n in cut]),
    ], 1).astype("<u8")
    data = zs.BufferWithSegments(b"".join(texts), segments.tobytes())

    def lengths(content: bytes) -> np.ndarray:
        out = _compressor(content).multi_compress_to_buffer(data, threads=0)
        return np.fromiter(map(len, out), np.int64, len(out))

    return (lengths(model.ordinary) - lengths(model.toxic)).astype(float), counts


def features(texts: list[bytes], model: Model) -> np.ndarray:
    d, counts = distances(texts, model)
    has = counts > 0
    starts = (np.cumsum(counts) - counts)[has]

    def whole(values: np.ndarray, reduce: np.ufunc) -> np.ndarray:
        out = np.zeros(len(texts))
        if len(starts):
            out[has] = reduce.reduceat(values, starts)
        return out

    over = {k: whole(np.maximum(d - k, 0), np.add) for k in (0, 1, 2, 3, 4)}
    n = np.maximum(counts, 1)
    columns = [np.log1p(20 * over[k] / n) for k in (0, 1, 2, 3, 4)]
    columns += [np.log1p(over[k]) for k in (2, 4)] + [whole(d, np.maximum) / 4, np.log1p(counts)]
    return np.stack(columns, 1)


def scores(texts: list[bytes], model: Model) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    z = (features(texts, model) - model.mean) / model.spread
    return 1 / (1 + np.exp(-np.clip(z @ model.weights[1:] + model.weights[0], -40, 40)))


def _stem_counts(texts: list[str]) -> Counter[str]:
    """Each stem with the number of different words before it."""
    pairs = set()
    for text in texts:
        before = ""
        for word in text.lower().split():
            for n in STEMS:
                if len(word) >= n:
                    pairs.add((word[:n], before))
            before = word
    return Counter(stem for stem, _ in pairs)


def _telling(toxic: list[str], ordinary: list[str], control: list[str]) -> set[str]:
    common = _stem_counts(ordinary)

    def stands_out(texts: list[str]) -> Counter[str]:
        return Counter({
            s: c for s, c in _stem_counts(texts).items()
            if c / max(1, len(texts)) > 15 * (common[s] + 0.5) / len(ordinary)
        })

    by_chance = max(stands_out(control).values(), default=0)
    return {s for s, c in stands_out(toxic).items() if c > max(by_chance, 2)}


def _train(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    try:
        return zs.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zs.ZstdError:
        return b"".join(samples)[-size:]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the first for the constant) by Newton's method, with a small ridge."""
    x = np.concatenate([np.ones((len(x), 1)), x], 1)
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6, *[1e-1] * (x.shape[1] - 1)])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -4, 4)
    return w


def _parted(x: np.ndarray, y: np.ndarray) -> float:
    """How well a column orders the labels (area under the curve)."""
    values, place, n = np.unique(x, return_inverse=True, return_counts=True)
    rank = (np.cumsum(n) - (n - 1) / 2)[place]
    pos = int(y.sum())
    return (rank[y == 1].sum() - pos * (pos + 1) / 2) / max(1, pos * (len(y) - pos))


def learn(toxic: list[str], ordinary: list[str]) -> Model:
    """A model from labelled texts; every second one calibrates."""
    if not toxic or not ordinary:
        return Model(constant=1.0 if toxic else 0.0)
    fit_t, fit_o = toxic[::2], ordinary[::2]
    cal_t, cal_o = toxic[1::2] or toxic, ordinary[1::2] or ordinary
    telling = _telling(fit_t, fit_o, cal_o[: len(fit_t)])
    found = [w for t in fit_t for w in t.lower().split() if any(w[:n] in telling for n in STEMS)]
    often = Counter(found)
    found = [w for w in found if often[w] > 1] or [w for t in fit_t for w in t.lower().split()]
    shuffle = np.random.default_rng(0)
    shuffle.shuffle(found)
    passages = [f" {' '.join(found[i:i + 8])} ".encode(errors="replace") for i in range(0, len(found), 8)]
    plain = []
    for text in map(_plain, fit_o):
        at, n = windows(text)
        for i in shuffle.permutation(len(at))[:24]:
            plain.append(text[at[i]:at[i] + n[i]])
    shuffle.shuffle(plain)
    base = _train(BASE, plain)
    texts = [_plain(t) for t in (*cal_t, *cal_o)]
    y = np.array([1.0] * len(cal_t) + [0.0] * len(cal_o))
    tried = []
    for size in SIZES:
        model = Model(base, _train(size, passages) + base)
        x = features(texts, model)
        tried.append((max(_parted(c, y) for c in x.T), -size, model, x))
    _, _, model, x = max(tried, key=lambda t: t[:2])
    model.mean, model.spread = x.mean(0), x.std(0) + 1e-6
    model.weights = _logistic((x - model.mean) / model.spread, y)
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learns from labelled rows that are not held out; ``labels`` holds ids and ``toxic``."""
    known = labels.select(F.col(id_col).alias("id"), F.col("toxic").alias("label")).filter(
        F.col("id").isNotNull() & ~held_out("id")
    )
    draw = F.xxhash64(F.col("id"), F.lit("toxicity"))

    def sample(label: int, most: int) -> list[str]:
        chosen = known.filter(F.col("label") == label).select("id").distinct().orderBy(draw, "id").limit(most)
        rows = (
            docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .filter(F.length("text").between(1, MOST_CHARS))
            .join(F.broadcast(chosen), "id")  # at most ``most`` ids
            .groupBy("id").agg(F.min("text").alias("text"))
            .orderBy(draw, "id").select("text")
        )
        return [r.text for r in rows.toLocalIterator()]

    return learn(sample(1, MOST_TOXIC), sample(0, MOST_ORDINARY))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row."""
    scored = _with_score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def reject(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that are not predicted toxic, with all their columns."""
    row = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return _with_score(row, model).filter("score < 0.5").select("row.*")


def _with_score(rows: DataFrame, model: Model) -> DataFrame:
    """Two columns, the second a text; the text's place is taken by its score."""
    first = rows.schema.fields[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for part in slices(batch, 1):
                texts = [_plain(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores(texts, model), pa.float64())], names=[first.name, "score"]
                )

    return rows.mapInArrow(run, T.StructType([first, T.StructField("score", T.DoubleType())]))
