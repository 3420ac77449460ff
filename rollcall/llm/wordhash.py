"""Hashes of words and word sequences for whole Arrow columns at once.

A word's hash is a polynomial over its bytes, taken from running sums; so a
column of texts costs a few passes over its bytes and no loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from rollcall.llm.support import by_value

by_value(__name__)

# Bytes worked on at once; a longer text stands alone.
CHUNK = 300_000
BASE = 0x9E3779B97F4A7C15 | 1


def random_words(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, n, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowered() -> np.ndarray:
    """Byte table that lower-cases A to Z."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and where each text begins; NULL is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    begins = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[begins[0] : begins[-1]], begins - begins[0]


def pieces(begins: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes."""
    at, n = 0, len(begins) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(begins, begins[at] + size, side="right")) - 1)
        yield at, min(stop, n)
        at = stop


class Hasher:
    """Polynomial hashes of byte ranges of a chunk; powers are kept between chunks."""

    def __init__(self):
        self.letters = random_words(7, 256)
        self.inverse = np.uint64(pow(BASE, -1, 2**64))
        self.powers = np.ones(1, np.uint64)
        self.backs = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, CHUNK + 1)
            steps = np.full(size, BASE, dtype=np.uint64)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)
            steps[1:] = self.inverse
            self.backs = np.multiply.accumulate(steps)

    def ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Mixed hash of data[start:end] for each range; ``data`` is lower-cased before."""
        self.grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.letters[data] * self.powers[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.backs[starts] + (ends - starts).astype(np.uint64))
