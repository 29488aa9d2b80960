"""Vectorised word hashing over the UTF-8 bytes of a batch of texts.

Hashing per word in Python costs about a microsecond; here a whole batch costs a few
passes of numpy over its bytes, whatever the number of different words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

BATCH_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
#: ASCII bytes other than letters and digits; bytes of longer characters count as letters.
MARKS = np.ones(256, bool)
MARKS[128:] = False
MARKS[[c for c in range(128) if chr(c).isalnum()]] = False

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for ``i`` below ``n``."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(max(n, BATCH_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of a batch in order. ``first[d]`` is the index of the first word of text ``d``.

    ``data`` has a space before each text and one at the end.
    """

    data: np.ndarray
    sums: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return self.spans(self.start, self.end)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte spans; equal bytes give equal hashes wherever they stand."""
        _, inverse = powers(len(self.data) + 1)
        total = (self.sums[end] - self.sums[start]) * inverse[start]
        return mix(total + (end - start).astype(np.uint64))


def words(texts: list[bytes], separators: np.ndarray = WHITE) -> Words:
    """Words of ``texts``: the longest runs of bytes that are no ``separators``."""
    joined = b" ".join([b"", *texts, b""])
    data = np.frombuffer(joined, np.uint8)
    n = len(data)
    power, _ = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = ~separators[data]
    edges = np.diff(inside)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return Words(data, sums, start, end, np.searchsorted(start, bounds(texts)))


def bounds(texts: list[bytes]) -> np.ndarray:
    """Where each text begins in ``Words.data``, and where one more would."""
    offsets = np.ones(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    offsets[1:] += 1
    return offsets


def batches(items: Iterable[tuple], text_at: int, most: int = BATCH_BYTES) -> Iterator[list[tuple]]:
    """Groups of rows with about ``most`` bytes of text; a longer text makes its own group."""
    group: list[tuple] = []
    size = 0
    for item in items:
        group.append(item)
        size += len(item[text_at]) + 1
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group
