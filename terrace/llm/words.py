"""Word boundaries and word hashes of whole batches of text, in numpy.

Both word classes used by the operators can be told from single UTF-8 bytes,
so a batch is cut into words without decoding it.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np

# A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# [^\x20\x09-\x0D]
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

# [^\x00-\x2F\x3A-\x60\x7B-\x7F], after lower-casing: digits, a-z and every byte beyond ASCII
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

SEPARATOR = 0x20

HASH_BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64


class Words(NamedTuple):
    low: np.ndarray  # lower-cased bytes
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # behind its last byte
    first: np.ndarray  # words of row i: first[i] to first[i + 1]


def cut(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
    """Maximal runs of bytes of ``kind`` inside each row."""
    low = LOWER[data]
    inside = kind[low]
    if not len(low):
        none = np.empty(0, np.int64)
        return Words(low, none, none, np.zeros(len(offsets), np.int64))
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < len(low)]
    opens[begins] = inside[begins]
    ends = offsets[1:][offsets[1:] > 0] - 1
    closes[ends] = inside[ends]
    start = np.flatnonzero(opens)
    return Words(low, start, np.flatnonzero(closes) + 1, np.searchsorted(start, offsets))


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        factors = np.full(HASH_BLOCK + 1, base & (2**64 - 1), np.uint64)
        factors[0] = 1
        out.append(np.multiply.accumulate(factors))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash (a bijection, so equal inputs are the only equal outputs)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _polynomial(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sum of (byte + 1) * base^(place in the word), for words inside ``low``, of one block at most."""
    power, inverse = _powers()
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[: len(low)], out=sums[1:])
    return (sums[end] - sums[start]) * inverse[start]


def hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    low, start, end, _ = words
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = int(np.searchsorted(end, start[i] + HASH_BLOCK, "right"))
        if j > i:
            at = start[i]
            out[i:j] = _polynomial(low[at : end[j - 1]], start[i:j] - at, end[i:j] - at)
        else:  # one word longer than a block
            j, total, scale = i + 1, 0, 1
            step = pow(_BASE, HASH_BLOCK, 1 << 64)
            for at in range(int(start[i]), int(end[i]), HASH_BLOCK):
                part = low[at : min(at + HASH_BLOCK, int(end[i]))]
                one = _polynomial(part, np.array([0]), np.array([len(part)]))[0]
                total, scale = total + int(one) * scale, scale * step % (1 << 64)
            out[i] = total % (1 << 64)
        i = j
    return mix(out)


def hash_of(word: bytes) -> int:
    """The hash of one word (already lower-cased)."""
    data = np.frombuffer(word, np.uint8)
    return int(hashes(Words(data, np.array([0]), np.array([len(data)]), np.array([0, 1])))[0])


class HashIndex:
    """Places of 64-bit hashes in a fixed list, for whole arrays; -1 where absent.

    Open addressing in a table of twice the size at least, probed for all
    queries together.
    """

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, np.uint64)
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2))) + 1)
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.place = np.full(1 << bits, -1, np.int32)
        self.key = np.zeros(1 << bits, np.uint64)
        todo = np.arange(len(keys))
        slot = (keys >> self.shift).astype(np.int64)
        while len(todo):
            free = self.place[slot] < 0
            winner, at = np.unique(slot[free], return_index=True)
            self.place[winner] = todo[free][at]
            self.key[winner] = keys[todo[free][at]]
            lost = np.ones(len(todo), bool)
            lost[np.flatnonzero(free)[at]] = False
            todo, slot = todo[lost], (slot[lost] + 1) & self.mask

    def find(self, queries: np.ndarray) -> np.ndarray:
        slot = (queries >> self.shift).astype(np.int64)
        out = self.place[slot]
        other = np.flatnonzero((out >= 0) & (self.key[slot] != queries))
        while len(other):
            slot[other] = (slot[other] + 1) & self.mask
            out[other] = self.place[slot[other]]
            other = other[(out[other] >= 0) & (self.key[slot[other]] != queries[other])]
        return out


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters in lower case, with one separator for each run of other bytes; and the rows' new offsets.

    A-Z and Latin-1 capitals become lower case, bytes beyond ASCII otherwise
    stay as they are, and all other ASCII bytes separate.
    """
    if not len(data):
        return data, offsets
    low = data.copy()
    low[(low >= 65) & (low <= 90)] += 32
    before = np.r_[np.uint8(0), data[:-1]]
    low[(before == 0xC3) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 0x20
    other = (low < 0x80) & ((low < 97) | (low > 122))
    low[other] = SEPARATOR
    keep = np.ones(len(low), bool)
    keep[1:] = ~(other[1:] & other[:-1])
    return low[keep], np.r_[0, np.cumsum(keep)][offsets]
