"""Text columns as byte arrays: words and their 64-bit hashes without a Python loop over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes that end a word: space and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (one-to-one)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: One 64-bit number for each byte value.
BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64))
#: That of each byte value, A-Z lower-cased.
LOWER_CODE = BYTE_CODE[LOWER]
_powers = np.ones(1, np.uint64)
#: INVERSE ** at, below this length from a table.
TABLED = 1 << 18
with np.errstate(over="ignore"):
    _tabled = np.cumprod(np.full(TABLED, INVERSE, np.uint64)) * BASE


def _up_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.full(n * 5 // 4, BASE, np.uint64)) * INVERSE
    return _powers[:n]


def _inverse_powers(at: np.ndarray) -> np.ndarray:
    """INVERSE ** at, from the table or by squaring; ``at`` rises."""
    if not len(at) or at[-1] < TABLED:
        return _tabled[at]
    out, factor, rest = np.ones(len(at), np.uint64), INVERSE, at.astype(np.uint64)
    with np.errstate(over="ignore"):
        while rest.any():
            out = np.where(rest & np.uint64(1), out * factor, out)
            factor, rest = factor * factor, rest >> np.uint64(1)
    return out


def text_bytes(column: pa.Array) -> list[np.ndarray | None]:
    """A view of the UTF-8 bytes of each text, without copies; None for null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return []
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return [body[a:b] if ok else None for a, b, ok in zip(ends[:-1], ends[1:], valid, strict=True)]


def word_hashes(text: np.ndarray) -> np.ndarray:
    """Hashes of the words of one text (see SPACE), A-Z lower-cased, in order."""
    if not len(text):
        return np.zeros(0, np.uint64)
    space = np.ones(len(text) + 2, bool)
    space[1:-1] = SPACE[text]
    edges = np.flatnonzero(space[1:] != space[:-1])  # start, end, start, ..
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(text) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(LOWER_CODE[text] * _up_to(len(text)), out=sums[1:])
        return mix((sums[ends] - sums[starts]) * _inverse_powers(starts))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    k = min(size, len(words))
    with np.errstate(over="ignore"):
        out = np.full(len(words) - k + 1, k, np.uint64)
        for i in range(k):
            out = mix(out * BASE + words[i : len(words) - k + 1 + i])
    return np.unique(out)
