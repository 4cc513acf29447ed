"""Words, their hashes and rolling window hashes of many texts at once, in numpy.

A word is a run of bytes other than the six ASCII white-space characters (space and 0x09 to
0x0D). All functions work on the UTF-8 bytes of whole texts; nothing is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U64 = np.uint64
_BASES = (_U64(0x9E3779B97F4A7C15), _U64(0xC2B2AE3D27D4EB4F))
_BYTES = np.random.default_rng(20).integers(1, 2**64, 256, dtype=np.uint64) | _U64(1)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, *range(9, 14)]] = False


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all bits."""
    h = (h ^ (h >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U64(27))) * _U64(0x94D049BB133111EB)
    return h ^ (h >> _U64(31))


@lru_cache(maxsize=None)
def _powers(base: int, log2: int) -> np.ndarray:
    out = np.full(1 << log2, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base**0`` to ``base**(n-1)`` modulo 2**64."""
    return _powers(int(base), max(int(n), 2).bit_length())[:n]


class Texts:
    """Whole texts as one byte array with the places of their words.

    ``data`` bytes, ``offsets`` where each text begins (one more than texts), ``starts`` and
    ``ends`` of the words, ``first`` the number of words before each text (one more than texts).
    """

    def __init__(self, column: pa.Array) -> None:
        column = column.cast(pa.large_binary()).fill_null(b"")
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = raw[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        inside = np.concatenate([_IS_WORD[self.data], [False]])
        begins = inside[:-1].copy()
        begins[1:] &= ~inside[:-2]
        edge = self.offsets[:-1][self.offsets[:-1] < len(self.data)]
        begins[edge] |= inside[edge]
        finish = inside[:-1] & ~inside[1:]
        edge = edge[edge > 0] - 1
        finish[edge] |= inside[edge]
        self.inside = inside[:-1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.n_words)

    def count(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text the mask holds for."""
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def hashes(self, fold: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word; ``fold`` maps bytes first, as for lower case."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        begin = self.starts[0]
        span = np.diff(np.append(self.starts, len(self.data)))
        place = np.arange(len(self.data) - begin) - np.repeat(self.starts - begin, span)
        table = _BYTES if fold is None else _BYTES[fold]
        value = table[self.data[begin:]] * powers(_BASES[0], span.max())[place]
        value[~self.inside[begin:]] = 0
        h = np.add.reduceat(value, self.starts - begin)
        return mix(h ^ (self.ends - self.starts).astype(np.uint64) * _BASES[1])

    def windows(self, hashes: np.ndarray, width: int, second: bool = False) -> np.ndarray:
        """A hash of each ``width`` words in a row, by their first word.

        The last ``width - 1`` places stand for nothing; :meth:`whole` tells which windows lie
        within one text.
        """
        n = len(hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        base = _BASES[1 if second else 0]
        total = np.concatenate([[_U64(0)], np.cumsum(hashes * powers(base, len(hashes)))])
        inverse = powers(_U64(pow(int(base), -1, 2**64)), n)
        return mix((total[width:] - total[:-width]) * inverse)

    def whole(self, width: int) -> np.ndarray:
        """Which windows of ``width`` words lie within one text."""
        n = max(len(self.starts) - width + 1, 0)
        left = np.repeat(self.first[1:], self.n_words)[:n] - np.arange(n)
        return left >= width


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Cut rows into runs of about ``limit`` bytes (one row at least), to bound memory."""
    size = np.diff(np.frombuffer(
        column.cast(pa.large_binary()).buffers()[1], np.int64
    )[column.offset : column.offset + len(column) + 1]) if len(column) else np.zeros(0, np.int64)
    total, begin = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > begin and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if len(size):
        yield begin, len(size)


LOWER = np.arange(256)
LOWER[65:91] += 32


def spread(start: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` places are within ``width`` from one of the given starts."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, np.minimum(start + width, n), -1)
    return np.cumsum(edge[:-1]) > 0


def runs(mask: np.ndarray) -> np.ndarray:
    """First and last-plus-one of each run of true values, flat in one array."""
    return np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]])))
