"""Word boundaries and word hashes of whole Arrow text columns in numpy, without a Python step per word.

Words are runs of bytes other than space and 0x09-0x0D, as in the pattern ``[^\\x20\\x09-\\x0D]+``.
A word's hash is a polynomial over random byte values modulo 2^64, finished with a bijective
mixer. Hashes of word sequences are polynomials over word hashes, so every window of a column
costs a few vector operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes that one vectorised step handles; a longer text takes several steps.
STEP = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose output bits depend on all input bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null counts as the empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def row_slices(offsets: np.ndarray, most: int = STEP) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` bytes together, or one longer row."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1)
        yield low, min(high, rows)
        low = high


class Words:
    """Words of a range of rows: ``hashes``, ``starts`` and ``ends`` (bytes), and ``bounds``, the first word of each row."""

    def __init__(self, hashes, starts, ends, bounds):
        self.hashes, self.starts, self.ends, self.bounds = hashes, starts, ends, bounds


class WordHasher:
    def __init__(self, lower: bool = False, seed: int = 0x5EED):
        rng = np.random.default_rng(seed)
        values = rng.integers(1, 2**63, 256, dtype=np.uint64) | U(1)
        if lower:
            values[65:91] = values[97:123]
        self.values = values
        base = U(0x9E3779B97F4A7C15)
        inverse = U(pow(int(base), -1, 2**64))
        size = 2 * STEP
        self.power = np.cumprod(np.concatenate([[U(1)], np.full(size, base, U)]), dtype=U)
        self.inverse = np.cumprod(np.concatenate([[U(1)], np.full(size, inverse, U)]), dtype=U)
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True

    def words(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        """``offsets`` bound the rows in ``data``; positions in the result count from the first of them."""
        first, end = int(offsets[0]), int(offsets[-1])
        cuts = offsets - first
        found = []
        at = 0
        while at < end - first:
            stop = min(at + STEP, end - first)
            if stop < end - first:  # never inside a word, however long
                stop = self._next_cut(data[first:end], cuts, stop)
            found.append(self._part(data[first + at : first + stop], at, cuts))
            at = stop
        hashes, starts, ends = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (
            np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64))
        return Words(hashes, starts, ends, np.searchsorted(starts, cuts))

    def _next_cut(self, data: np.ndarray, cuts: np.ndarray, stop: int) -> int:
        border = int(cuts[np.searchsorted(cuts, stop)])
        for at in range(stop, border, 65536):
            blank = np.flatnonzero(self.space[data[at : min(at + 65536, border)]])
            if len(blank):
                return at + int(blank[0])
        return border

    def _part(self, part: np.ndarray, at: int, cuts: np.ndarray):
        dark = ~self.space[part]
        lead = np.empty(len(part) + 1, bool)
        lead[0] = lead[-1] = True  # a word begins at a dark byte after a blank or a row's border
        lead[1:-1] = ~dark[:-1]
        inner = cuts[np.searchsorted(cuts, at) : np.searchsorted(cuts, at + len(part), side="right")] - at
        lead[inner] = True
        starts = np.flatnonzero(dark & lead[:-1])
        tail = np.empty(len(part), bool)
        tail[:-1] = ~dark[1:]
        tail[-1] = True
        tail[inner[inner > 0] - 1] = True
        ends = np.flatnonzero(dark & tail) + 1
        if len(part) <= len(self.power) - 1:
            summed = np.empty(len(part) + 1, U)
            summed[0] = 0
            np.cumsum(self.values[part] * self.power[: len(part)], out=summed[1:])
            hashes = (summed[ends] - summed[starts]) * self.inverse[starts]
        else:  # one word longer than a step
            hashes = np.array([self._long(part[a:b]) for a, b in zip(starts, ends, strict=True)], U)
        return mix(hashes), starts + at, ends + at

    def _long(self, word: np.ndarray) -> np.uint64:
        total, scale = 0, 1
        for a in range(0, len(word), STEP):
            piece = word[a : a + STEP]
            total += int(np.sum(self.values[piece] * self.power[: len(piece)], dtype=U)) * scale
            scale = scale * int(self.power[len(piece)]) % 2**64
        return U(total % 2**64)


def windows(hashes: np.ndarray, size: int, factor: int) -> np.ndarray:
    """The hash of ``size`` consecutive words from every word that has as many after it."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, U)
    length = 1
    powers = hashes  # hash of ``length`` words from each position, doubled until it is long enough
    result, done = None, 0
    scale = factor
    while True:
        if size & length:
            if result is None:
                result, done = powers, length
            else:
                usable = min(len(result), len(powers) - done)
                result = result[:usable] * U(scale) + powers[done : done + usable]
                done += length
        if length * 2 > size:
            break
        powers = powers[: len(powers) - length] * U(scale) + powers[length:]
        scale = scale * scale % 2**64
        length *= 2
    return mix(result[:count])
