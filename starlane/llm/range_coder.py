"""A range coder for blocks of token ids with adaptive mixed predictions.

Three models predict each id: how often ids occur (order 0), which id last followed the
one before (order 1), and which last followed the two before (order 2). The last two come
with a confidence, the length of their recent success. The mix of the three for each pair
of confidences adapts to how well each has done; it divides the coder's range between the
order-2 id, the order-1 id, and all ids by their counts.

A block starts with nothing learned and is decoded alone. Its ids lie in lanes, each a run
of the block, that are coded side by side and learn into the same models after each step:
one array operation serves all lanes. A lane is a range coder of its own, with a range of
48 bits and words of 16 bits; carries are settled when the block ends.

Layout: magic, numbers of ids, ids a lane, and the alphabet's size, check sum of the ids,
check sum of what follows; the number of words of each lane; all words, lane by lane.
"""

from __future__ import annotations

import struct
from zlib import crc32

import numpy as np

MAGIC = b"CMRC"
HEAD = struct.Struct("<4sIIIII")
LANES, SHORTEST = 8192, 64
U = np.uint64
LOW32, LIMIT, FULL = U(0xFFFFFFFF), U(1 << 32), U((1 << 48) - 1)
SURE = 15
SLOTS = 1 << 18
MIX = 1 << 16
TOP = 1 << 22


class Models:
    """What both sides have learned so far."""

    def __init__(self, alphabet: int):
        self.counts = np.ones(alphabet, np.int64)
        self.next1 = np.zeros(alphabet, np.int32)
        self.sure1 = np.zeros(alphabet, np.int8)
        self.next2 = np.zeros(SLOTS, np.int32)
        self.sure2 = np.zeros(SLOTS, np.int8)
        # Successes of order 2, order 1 and order 0 by confidences, and whether the first two agree.
        self.wins = np.ones((2 * (SURE + 1) ** 2, 3), np.int64)
        self.step = 0
        self.fresh: list[np.ndarray] = []
        self.refresh()

    def refresh(self) -> None:
        """Tables for the next steps, from all that was learned; often at first, then less."""
        if self.fresh:
            self.counts += 32 * np.bincount(np.concatenate(self.fresh), minlength=len(self.counts))
            self.fresh = []
        while self.counts.sum() > TOP:
            self.counts = (self.counts + 1) >> 1
        self.cumulative = np.concatenate([[0], np.cumsum(self.counts)]).astype(U)
        share = self.wins / self.wins.sum(1, keepdims=True)
        first = np.maximum(1, (share[:, 0] * (MIX - 4)).astype(np.int64))
        second = np.maximum(1, (share[:, 1] * (MIX - 4)).astype(np.int64))
        self.starts = np.stack([np.zeros_like(first), first, first + second], 1).astype(U)
        self.sizes = np.stack([first, second, MIX - first - second], 1).astype(U)
        self.due = self.step + min(16, max(1, self.step))

    def predict(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, ...]:
        slot = ((two * 40503 + one * 9973) ^ (two >> 3)) & (SLOTS - 1)
        id2, id1 = self.next2[slot], self.next1[one]
        mix = (self.sure2[slot].astype(np.int64) * (SURE + 1) + self.sure1[one]) * 2 + (id1 == id2)
        return slot, id2, id1, mix

    def learn(self, ids: np.ndarray, one: np.ndarray, seen: tuple[np.ndarray, ...], won: np.ndarray) -> None:
        slot, id2, id1, mix = seen
        self.wins += 8 * np.bincount(mix * 3 + won, minlength=self.wins.size).reshape(self.wins.shape)
        for table, sure, at, guess in ((self.next2, self.sure2, slot, id2), (self.next1, self.sure1, one, id1)):
            right, old = guess == ids, sure[at]
            sure[at] = np.where(right, np.minimum(old + 1, SURE), old >> 1)
            table[at] = np.where(right | (old > 1), guess, ids)
        self.fresh.append(ids)
        self.step += 1
        if self.step >= self.due:
            if self.wins.max() > 1 << 24:
                self.wins = (self.wins + 1) >> 1
            self.refresh()


def _lanes(n: int) -> int:
    """Ids a lane."""
    return max(SHORTEST, -(-n // LANES))


def _steps(n: int, length: int):
    """For each step, how many lanes have an id left; only the last lane may be shorter."""
    lanes, last = -(-n // length), n - (-(-n // length) - 1) * length
    return ((t, lanes if t < last else lanes - 1) for t in range(length if lanes > 1 else last))


def encode(ids: np.ndarray) -> bytes:
    """A block; ids are below 2**31."""
    n, length = len(ids), _lanes(len(ids))
    lanes = -(-n // length)
    alphabet = int(ids.max()) + 1 if n else 1
    grid = np.zeros(lanes * length, np.int64)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, length).T)
    low, size = np.zeros(lanes, U), np.full(lanes, FULL, U)
    room = 3 * length + 8
    out, at = np.zeros(lanes * room, np.uint32), np.arange(lanes) * room
    first_word = at.copy()

    def narrow(rows, start: np.ndarray, share: np.ndarray, total: int | np.uint64) -> None:
        part = size[rows] // U(total)
        low[rows] += part * start
        size[rows] = part * share
        while len(short := np.flatnonzero(size < LIMIT)):
            out[at[short]] = low[short] >> U(32)
            at[short] += 1
            low[short] = (low[short] & LOW32) << U(16)
            size[short] <<= U(16)

    models = Models(alphabet)
    one = two = np.zeros(lanes, np.int64)
    for t, k in _steps(n, length):
        now = grid[t, :k]
        seen = models.predict(one[:k], two[:k])
        won = np.where(seen[1] == now, 0, np.where(seen[2] == now, 1, 2))
        mix = seen[3]
        narrow(slice(0, k), models.starts[mix, won], models.sizes[mix, won], MIX)
        if len(rest := np.flatnonzero(won == 2)):
            symbol = now[rest]
            start = models.cumulative[symbol]
            narrow(rest, start, models.cumulative[symbol + 1] - start, models.cumulative[-1])
        models.learn(now, one[:k], seen, won)
        one, two = np.concatenate([now, one[k:]]), one
    for _ in range(3):
        out[at] = low >> U(32)
        at += 1
        low = (low & LOW32) << U(16)
    counts = at - first_word
    words = out.reshape(lanes, room) if lanes else out.reshape(0, room)
    for i in range(int(counts.max(initial=0)) - 1, 0, -1):  # carries, from the last word on
        words[:, i - 1] += words[:, i] >> 16
        words[:, i] &= 0xFFFF
    body = counts.astype("<u4").tobytes() + words[np.arange(room) < counts[:, None]].astype("<u2").tobytes()
    return HEAD.pack(MAGIC, n, length, alphabet, crc32(ids.astype("<u4").tobytes()), crc32(body)) + body


def decode(block: bytes) -> np.ndarray:
    """The block's ids; an error if the block is damaged."""
    magic, n, length, alphabet, sum_ids, sum_body = HEAD.unpack_from(block)
    body = block[HEAD.size:]
    if magic != MAGIC or crc32(body) != sum_body:
        raise ValueError("damaged block")
    lanes = -(-n // length)
    counts = np.frombuffer(body, "<u4", lanes).astype(np.int64)
    words = np.concatenate([np.frombuffer(body, "<u2", offset=4 * lanes), np.zeros(4, np.uint16)]).astype(U)
    at = np.cumsum(counts) - counts
    code = (words[at] << U(32)) | (words[at + 1] << U(16)) | words[at + 2] if lanes else np.zeros(0, U)
    at += 3
    size = np.full(lanes, FULL, U)

    def narrow(rows, part: np.ndarray, start: np.ndarray, share: np.ndarray) -> None:
        code[rows] -= part * start
        size[rows] = part * share
        while len(short := np.flatnonzero(size < LIMIT)):
            code[short] = (code[short] << U(16)) | words[at[short]]
            at[short] += 1
            size[short] <<= U(16)

    models = Models(alphabet)
    grid = np.zeros((length, lanes), np.int64)
    one = two = np.zeros(lanes, np.int64)
    for t, k in _steps(n, length):
        seen = models.predict(one[:k], two[:k])
        _, id2, id1, mix = seen
        part = size[:k] // U(MIX)
        value = code[:k] // part
        bounds = models.starts[mix]
        won = (value >= bounds[:, 1]).astype(np.int64) + (value >= bounds[:, 2])
        narrow(slice(0, k), part, bounds[np.arange(k), won], models.sizes[mix, won])
        now = np.where(won == 0, id2, id1).astype(np.int64)
        if len(rest := np.flatnonzero(won == 2)):
            part = size[rest] // models.cumulative[-1]
            value = np.minimum(code[rest] // part, models.cumulative[-1] - U(1))
            symbol = np.searchsorted(models.cumulative, value, "right") - 1
            start = models.cumulative[symbol]
            narrow(rest, part, start, models.cumulative[symbol + 1] - start)
            now[rest] = symbol
        grid[t, :k] = now
        models.learn(now, one[:k], seen, won)
        one, two = np.concatenate([now, one[k:]]), one
    ids = grid.T.ravel()[:n]
    if crc32(ids.astype("<u4").tobytes()) != sum_ids:
        raise ValueError("damaged block")
    return ids.astype(np.uint32)
