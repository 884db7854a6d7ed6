"""Words, word hashes and shingles of many texts at once, as numpy arrays over their UTF-8 bytes.

For use inside Arrow tasks. A batch of texts is cut into pieces of bounded size, so the arrays stay
small whatever the batch. Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``; all of these are
ASCII, so bytes and code points agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 18
_SEED = 20_240_229

IS_WHITE = np.zeros(256, bool)
IS_WHITE[[0x20, 9, 10, 11, 12, 13]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32


class Piece(NamedTuple):
    """Texts ``begin`` to ``end`` of a batch: their bytes, and where each text starts in them."""

    begin: int
    end: int
    data: np.ndarray
    offsets: np.ndarray


def pieces(texts: pa.Array, most: int = PIECE_BYTES) -> Iterator[Piece]:
    """The batch in pieces of at most ``most`` bytes, or one text. Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, place, content = texts.buffers()
    if not len(texts):
        return
    all_offsets = np.frombuffer(place, np.int64 if wide else np.int32)
    all_offsets = all_offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    begin, n = 0, len(texts)
    while begin < n:
        end = int(np.searchsorted(all_offsets, all_offsets[begin] + most, "right")) - 1
        end = min(n, max(end, begin + 1))
        first, last = all_offsets[begin], all_offsets[end]
        yield Piece(begin, end, data[first:last], all_offsets[begin : end + 1] - first)
        begin = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and per text the number of words before it (n + 1)."""
    inside = np.zeros(len(data) + 1, bool)
    np.logical_not(IS_WHITE[data], out=inside[:-1])
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before)
    after = inside.copy()
    after[offsets] = False
    # A word ends where the next byte is white or belongs to the next text.
    ends = np.flatnonzero(inside[:-1] & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rolling:
    """Fast hashes of all strings of one width, modulo 2^64: to choose and to group, not to tell
    whether strings are equal."""

    def __init__(self) -> None:
        draw = np.random.default_rng(_SEED)
        self.values = draw.integers(1, 2**64, 256, dtype=np.uint64)
        self.base = int(draw.integers(2**40, 2**63)) | 1
        self.power = self.inverse = np.ones(0, np.uint64)

    def strings(self, data: np.ndarray, width: int) -> np.ndarray:
        if len(data) >= len(self.power):
            n = max(len(data) + 1, 2 * len(self.power), 1 << 16)
            for name, base in (("power", self.base), ("inverse", pow(self.base, -1, 2**64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.power[: len(data)], out=sums[1:])
        return mix((sums[width:] - sums[:-width]) * self.inverse[: len(data) - width + 1])


PRIME = (1 << 61) - 1
_SEGMENT = 1 << 22
_U = np.uint64


def _modulo(x: np.ndarray) -> np.ndarray:
    """``x`` modulo ``PRIME``."""
    x = (x & _U(PRIME)) + (x >> _U(61))
    return np.where(x >= _U(PRIME), x - _U(PRIME), x)


def times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``x * y`` modulo ``PRIME`` of numbers below it."""
    x_high, x_low = x >> _U(31), x & _U((1 << 31) - 1)
    y_high, y_low = y >> _U(31), y & _U((1 << 31) - 1)
    middle = x_high * y_low + x_low * y_high
    low = x_low * y_low + ((middle & _U((1 << 30) - 1)) << _U(31))
    return _modulo(_modulo(low) + (x_high * y_high << _U(1)) + (middle >> _U(30)))


class Sums(NamedTuple):
    """Prefix sums of a polynomial, in two halves of its powers' bits."""

    low: np.ndarray
    high: np.ndarray

    def at(self, i: np.ndarray) -> np.ndarray:
        high = _modulo(self.high[i])
        shifted = (high >> _U(29)) + ((high & _U((1 << 29) - 1)) << _U(32))
        return _modulo(_modulo(shifted) + _modulo(self.low[i]))


class Hasher:
    """64-bit hashes of byte ranges and of word sequences; equal in every task.

    Ranges are hashed by a polynomial modulo the prime 2^61 - 1: modulo 2^64 there are texts, such as
    the Thue-Morse word and its complement, that differ and agree for every odd base.
    """

    def __init__(self) -> None:
        draw = np.random.default_rng(_SEED)
        self.base = int(draw.integers(2**40, PRIME))
        self.factors = draw.integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n <= len(self.power):
            return
        n = max(n, 2 * len(self.power), 1 << 16)
        for name, base in (("power", self.base), ("inverse", pow(self.base, -1, PRIME))):
            known = getattr(self, name)
            while len(known) < n:
                step = np.full(len(known), pow(base, len(known), PRIME), np.uint64)
                known = np.concatenate((known, times(known, step)))
            setattr(self, name, known[:n].copy())

    def prefix_sums(self, data: np.ndarray) -> Sums:
        """What ``spans`` needs to hash ranges of ``data``."""
        n = len(data)
        self._grow(n + 1)
        values, halves = data + _U(1), []
        for part in (self.power[:n] & _U(0xFFFFFFFF), self.power[:n] >> _U(32)):
            sums = np.zeros(n + 1, np.uint64)
            for low in range(0, n, _SEGMENT):  # reduced now and then, so that sums stay below 2^64
                here = slice(low, low + _SEGMENT)
                sums[low + 1 : low + 1 + _SEGMENT] = np.cumsum(values[here] * part[here])
                if low:
                    sums[low + 1 : low + 1 + _SEGMENT] += _modulo(sums[low : low + 1])
            halves.append(sums)
        return Sums(*halves)

    def spans(self, sums: Sums, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ``data[start:end]``; ranges of zeros of different lengths differ too."""
        difference = _modulo(sums.at(ends) + _U(PRIME) - sums.at(starts))
        return mix(times(difference, self.inverse[starts]))

    def ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ``data[start:end]``, all non-empty."""
        return self.spans(self.prefix_sums(data), starts, ends)

    def windows(self, words: np.ndarray, width: int) -> np.ndarray:
        """Hashes of all runs of ``width`` consecutive word hashes."""
        n = len(words) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        total = np.full(n, width, np.uint64)
        for j in range(width):
            total += words[j : j + n] * self.factors[j % 64]
            if width > 64 and j % 64 == 63:
                total = mix(total)
        return mix(total)

    def shingle_sets(self, piece: Piece, width: int) -> Iterator[np.ndarray]:
        """Per text the sorted distinct hashes of its ``width``-word shingles, A-Z lower-cased; of
        the whole sequence where it has fewer words; none where it has none."""
        data = TO_LOWER[piece.data]
        starts, ends, first = word_bounds(data, piece.offsets)
        words = self.ranges(data, starts, ends)
        full = self.windows(words, width)
        for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
            if high - low >= width:
                yield np.unique(full[low : high - width + 1])
            elif high > low:
                yield self.windows(words[low:high], high - low)
            else:
                yield np.zeros(0, np.uint64)
