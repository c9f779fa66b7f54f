"""Words of many texts at once, as numpy arrays.

A word is a run of bytes other than space and the control characters 9 to 13.
Hashes are 64 bits wide; where a wrong match would matter, words themselves are compared.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

SEPARATORS = bytes([32, *range(9, 14)])
_BASE = 0x9E3779B97F4A7C15 | 1
_WORD = 2**64 - 1


def table(members: bytes) -> np.ndarray:
    """True at the bytes given."""
    found = np.zeros(256, bool)
    found[list(members)] = True
    return found


IS_SEPARATOR = table(SEPARATORS)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


_largest = [1 << 10]


def powers(items: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for as many items at least."""
    _largest[0] = max(_largest[0], 1 << int(items).bit_length())
    return _powers(_largest[0])


def forget() -> None:
    """Give up the powers, which are as many as the longest text so far has items."""
    _largest[0] = 1 << 10
    _powers.cache_clear()


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:

    def up_to(base: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps)

    return up_to(_BASE), up_to(pow(_BASE, -1, 2**64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; equal bytes have equal hashes."""
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=sums[1:])
    spans = (sums[ends] - sums[starts]) * down[starts]
    return mix(spans + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    data: np.ndarray  # the texts with a space after each
    doc_starts: np.ndarray  # in bytes, one more than there are documents
    starts: np.ndarray
    ends: np.ndarray
    doc_words: np.ndarray  # first word of each document, one more

    @property
    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.doc_words) - 1), np.diff(self.doc_words))

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def split(texts: list[bytes], lower: bool = False) -> Words:
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = ~IS_SEPARATOR[data]
    steps = np.diff(inside)
    starts = np.flatnonzero(steps == 1)
    ends = np.flatnonzero(steps == -1)
    doc_starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(text) + 1 for text in texts], out=doc_starts[1:])
    return Words(data, doc_starts, starts, ends, np.searchsorted(starts, doc_starts))


def sums_by_doc(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between neighbouring bounds."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return np.diff(sums[bounds])


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` neighbouring items."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, np.uint64)
    for step in range(width):
        out = out * np.uint64(_BASE) + hashes[step : step + n]
    return mix(out)
