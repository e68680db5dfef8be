"""Vectorised hashing of words and byte windows, with wrap-around 64-bit arithmetic.

Words are hashed eight bytes at a time, each step mixing all bits, so that no pattern of the text makes two words
alike. ``Windows`` is a sum of byte values times powers: cheap for any ranges, but structured
texts can be built that collide, so it may only choose candidates or name runs that are compared later.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import blake2b

import numpy as np

_RATE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_RATE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mix(x: np.ndarray) -> np.ndarray:
    return _mix(np.array(x, np.uint64))


#: A wide value for each byte, so that texts of few different letters still differ in all bits.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


@lru_cache(maxsize=1)
def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """RATE**i and RATE**-i for i below ``size``."""
    up, down = np.full(size, _RATE, np.uint64), np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    return up, down


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables of at least n entries; the usual size is kept, a larger one only while in use."""
    usual = 1 << 21
    return _tables(usual) if n <= usual else _tables.__wrapped__(n)


class Windows:
    """Hashes of any byte ranges of one text, from one running sum."""

    def __init__(self, data: np.ndarray):
        up, self._down = _power_tables(len(data) + 1)
        self._sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[:len(data)], out=self._sum[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of data[start:end] for each pair; equal bytes give equal hashes."""
        h = (self._sum[ends] - self._sum[starts]) * self._down[starts]
        h += (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        return _mix(h)

    def all(self, length: int) -> np.ndarray:
        """Hash of every window of ``length`` bytes."""
        n = len(self._sum) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        h = (self._sum[length:] - self._sum[:n]) * self._down[:n]
        h += np.uint64(length * 0xA24BAED4963EE407 & (1 << 64) - 1)
        return _mix(h)


def letter_classes(pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Tables for bytes: A-Z to a-z, and whether the byte is part of a word.

    ``space``: words are what stands between ASCII white space; ``alnum``: runs of ASCII
    letters, digits and bytes of other characters.
    """
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    inside = np.ones(256, bool)
    if pattern == "space":
        inside[[32, 9, 10, 11, 12, 13]] = False
    elif pattern == "alnum":
        inside[0x00:0x30] = inside[0x3A:0x61] = inside[0x7B:0x80] = False
    else:
        raise ValueError(pattern)
    return lower, inside


#: Bytes up to which a word is hashed lane by lane; a longer one by a digest of its own.
LANE_BYTES = 256


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    size = ends - starts
    out = mix((size + 1).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", padded.tobytes(), 0, (1,))  # the eight bytes from each place on
    left = np.flatnonzero(size <= LANE_BYTES)
    at = 0
    while len(left):
        rest = size[left] - at
        lane = lanes[starts[left] + at]
        unused = np.clip(8 - rest, 0, 8).astype(np.uint64) * np.uint64(8)
        lane = np.where(rest >= 8, lane, lane & ((np.uint64(1) << (np.uint64(64) - unused) % np.uint64(64)) - np.uint64(1)))
        out[left] = mix((out[left] ^ lane) * np.uint64(0x9FB21C651E98DF25) + np.uint64(at + 1))
        at += 8
        left = left[size[left] > at]
    for k in np.flatnonzero(size > LANE_BYTES).tolist():
        out[k] = int.from_bytes(blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=8).digest(), "little")
    return out


class Words:
    """Words of a run of texts.

    ``starts`` and ``ends`` are byte places in the run, ``hashes`` one value per word,
    ``first`` the n + 1 word numbers at which the texts begin.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, pattern: str):
        lower, inside = letter_classes(pattern)
        low = lower[data]
        mask = inside[low]
        begins = mask.copy()
        begins[1:] &= ~mask[:-1]
        at = offsets[:-1][offsets[:-1] < len(data)]
        begins[at] = mask[at]
        closes = mask.copy()
        closes[:-1] &= ~mask[1:]
        last = offsets[1:][(offsets[1:] > 0)] - 1
        closes[last] = mask[last]
        self.low = low
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        self.hashes = word_hashes(low, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, offsets)


def sequence_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One value for each run of n words, in their order."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total += hashes[k:k + count] * np.uint64((0x2545F4914F6CDD1D * (2 * k + 1) + 2 * k) & (1 << 64) - 1 | 1)
    return _mix(total)
