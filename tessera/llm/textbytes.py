"""Vectorised work on the UTF-8 bytes of an Arrow batch of texts.

A batch's texts lie one behind the other in a single buffer; words, hashes and
windows are computed on that buffer with numpy, never in a Python loop per
word.  Hashes are 64-bit polynomials of randomised byte values, kept as prefix
sums, so the hash of any span costs two look-ups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MULT = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULT, -1, 1 << 64)
_BYTE = (np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
         * np.uint64(2) + np.uint64(1))

#: ASCII upper case to lower case; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: White space of the contracts: space and \x09-\x0D.
IS_WHITE = np.zeros(256, bool)
IS_WHITE[[32, 9, 10, 11, 12, 13]] = True
#: Letters, digits and every byte of a non-ASCII character.
IS_WORDY = np.zeros(256, bool)
IS_WORDY[48:58] = IS_WORDY[65:91] = IS_WORDY[97:123] = IS_WORDY[128:] = True


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets (one more than rows); null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = 1 << 20):
    """(first row, rows) of runs of about *most* bytes; a longer text alone."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > most:
            yield start, i - start
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths) - start


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, out=out)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class SpanHash:
    """Prefix sums over a buffer: the hash of any span [a, b)."""

    def __init__(self, raw: np.ndarray):
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * powers(_MULT, len(raw))[:-1], out=self.sums[1:])
        self.back = powers(_INVERSE, len(raw))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((self.sums[b] - self.sums[a]) * self.back[a])

    def every(self, n: int) -> np.ndarray:
        """Hashes of all spans of length *n* (by first byte)."""
        if len(self.sums) <= n:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[n:] - self.sums[:-n]) * self.back[:len(self.sums) - n])


def spans(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes with ``inside[byte]`` that do not cross texts:
    first byte, end, and the number of runs in each text."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets) - 1, np.int64)
    mark = inside[raw]
    first = mark.copy()
    first[1:] &= ~mark[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(raw)]
    first[edges] = mark[edges]
    last = mark.copy()
    last[:-1] &= ~mark[1:]
    before = edges[edges > 0] - 1
    last[before] = mark[before]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    per_text = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, per_text
