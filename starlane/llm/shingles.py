"""Word shingles of texts as 64-bit hashes, with array operations over many texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from starlane.llm.word_ids import SPACE, text_bytes

SLICE = 2 << 20  # bytes of text to work on at once; each takes about 60 bytes of memory
U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=2)
def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word (A-Z lower-cased, between white space), and how many words each text has."""
    data, edges = text_bytes(texts)
    if not len(data):
        return np.zeros(0, U), np.zeros(len(texts), np.int64)
    word = ~SPACE[data]
    inner = edges[1:-1][edges[1:-1] < len(data)]
    fresh = np.zeros(len(data), bool)  # a text starts here
    fresh[0] = True
    fresh[inner] = True
    starts = np.flatnonzero(word & (fresh | ~np.concatenate([[False], word[:-1]])))
    last = np.concatenate([~word[1:] | fresh[1:], [True]])
    ends = np.flatnonzero(word & last) + 1
    size = max(1 << 20, 1 << int(len(data)).bit_length())
    total = np.concatenate([np.zeros(1, U), np.cumsum((LOWER[data].astype(U) + U(1)) * _powers(BASE, size)[: len(data)])])
    hashes = (total[ends] - total[starts]) * _powers(BASE_INVERSE, size)[starts]
    hashes = mix(hashes + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))
    return hashes, np.diff(np.searchsorted(starts, edges))


def shingle_sets(texts: pa.Array, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text in ascending order, and how many each text has.

    A text with fewer words has its whole sequence as its one shingle; one without words
    has none.
    """
    hashes, counts = word_hashes(texts)
    first = np.cumsum(counts) - counts
    found, owner = [], []
    for n in range(1, words + 1):
        at_texts = np.flatnonzero(counts >= words if n == words else counts == n)
        if n == words:
            at = np.concatenate([np.arange(len(hashes)), [0]])[:-1]
            text = np.repeat(np.arange(len(counts)), counts)
            at = at[(at + words <= (first + counts)[text])] if len(hashes) else at
            own = text[at]
        else:
            at, own = first[at_texts], at_texts
        value = np.full(len(at), U(n), U) * U(0xA0761D6478BD642F)
        for k in range(n):
            value = mix(value + hashes[at + k] * U(2 * k + 1))
        found.append(value)
        owner.append(own)
    value, own = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((value, own))
    value, own = value[order], own[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (own[1:] != own[:-1])
    return value[keep], np.bincount(own[keep], minlength=len(counts))


def set_ids(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One hash for each set, whatever the order of its members; 0 for the empty set."""
    out = np.zeros(len(counts), U)
    has = counts > 0
    if len(values):
        sums = np.add.reduceat(mix(values ^ U(0x5851F42D4C957F2D)), (np.cumsum(counts) - counts)[has])
        out[has] = mix(sums + counts[has].astype(U))
    return out


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype(U).view(np.int64)
