"""Words of Arrow string columns as numpy arrays, without a Python string per word.

Every function takes the bytes of a whole batch and the offsets of its texts. Null is an empty text.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 20240229
SPAN = 1 << 18  # bytes hashed at a time, which bounds the memory of a task
MULTIPLIER = 0x9E3779B97F4A7C15

# The bytes of white space (blank and U+0009 to U+000D), and the bytes of A-Z.
WHITE = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
CAPITALS = range(0x41, 0x5B)

NOT_WHITE = np.ones(256, dtype=bool)
NOT_WHITE[WHITE] = False

# Word bytes of the overlap rule: 0-9, a-z (capitals are folded) and all that is not ASCII.
ALNUM_OR_WIDE = np.zeros(256, dtype=bool)
ALNUM_OR_WIDE[0x30:0x3A] = ALNUM_OR_WIDE[0x41:0x5B] = ALNUM_OR_WIDE[0x61:0x7B] = ALNUM_OR_WIDE[0x80:] = True

_random = np.random.Generator(np.random.PCG64(SEED))
BYTE_VALUES = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[CAPITALS] = BYTE_VALUES[[c + 32 for c in CAPITALS]]
FOLD = np.arange(256, dtype=np.uint8)
FOLD[CAPITALS] += 32
PLACE_VALUES = _random.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets at which each begins."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and the number of words before each text (one more than texts)."""
    inside = word_byte[data]
    breaks = np.zeros(len(data) + 1, dtype=bool)
    breaks[offsets] = True
    breaks[:-1] |= ~inside
    breaks[1:] |= ~inside
    # A break before byte i: i begins a text, or it or its left neighbour is outside a word.
    starts = np.flatnonzero(inside & breaks[:-1])
    stops = np.flatnonzero(inside & breaks[1:]) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over all output bits."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


_POWERS = _powers(MULTIPLIER, SPAN)
_INVERSE_MULTIPLIER = pow(MULTIPLIER, -1, 1 << 64)
_INVERSE = _powers(_INVERSE_MULTIPLIER, SPAN)


class Rolling:
    """Hashes of any stretches of some bytes from one running sum."""

    def __init__(self, data: np.ndarray, values: np.ndarray):
        n = len(data)
        self.inverse = _INVERSE if n < SPAN else _powers(_INVERSE_MULTIPLIER, n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values[data] * (_POWERS if n <= SPAN else _powers(MULTIPLIER, n))[:n], out=self.sums[1:])

    def stretches(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """A number per stretch, equal for equal bytes."""
        raw = (self.sums[stops] - self.sums[starts]) * self.inverse[starts]
        return mix(raw + (stops - starts).astype(np.uint64) * np.uint64(MULTIPLIER))

    def windows(self, size: int) -> np.ndarray:
        """A number per window of ``size`` bytes."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.inverse[:n]) if n > 0 else self.sums[:0]


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A 64-bit number per word from the values of its bytes; equal words get equal numbers."""
    out = np.empty(len(starts), dtype=np.uint64)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(stops, starts[low] + SPAN - 1, side="right")))
        begin, end = int(starts[low]), int(stops[high - 1])
        rolling = Rolling(data[begin:end], values)
        out[low:high] = rolling.stretches(starts[low:high] - begin, stops[low:high] - begin)
        low = high
    return out


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """A number per window of ``size`` consecutive words; empty if there are fewer words."""
    n = len(words) - size + 1
    if n <= 0:
        return words[:0]
    total = words[:n] * PLACE_VALUES[0]
    for place in range(1, size):
        total += words[place : place + n] * PLACE_VALUES[place]
    return mix(total)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The sorted distinct windows of a text; with fewer words the whole sequence is the only one."""
    if 0 < len(words) < size:
        return windows(words, len(words)) + np.uint64(len(words))
    return np.unique(windows(words, size))


def slices(column: pa.Array, limit: int = 1 << 22) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive parts of a column of about ``limit`` bytes, at least one text each, and their first row."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    totals = np.concatenate([[0], np.cumsum(lengths)])
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(totals, totals[low] + limit, side="right")) - 1)
        yield low, column.slice(low, high - low)
        low = high
