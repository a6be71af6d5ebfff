"""Words of many texts at once: numpy over the bytes of an Arrow column, no loop over words.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r, the same as ``[^\\x20\\x09-\\x0D]+`` on
the text, since UTF-8 never uses those bytes inside a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(1 << 12, _STEP)]), dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64 (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, _STEP)]), dtype=np.uint64)
    return _powers


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 places where they begin and end; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, ends, data = texts.buffers()
    at = np.frombuffer(ends, np.int64, len(texts) + texts.offset + 1)[texts.offset :] if ends else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), at


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Sub-batches with at most so many bytes of text (a longer text comes alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = buffers(batch.column(batch.schema.get_field_index(column)))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(at, at[a] + most, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b


def word_table(data: np.ndarray, at: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of every word; words of text d are those from first[d] to first[d + 1].

    ``lower`` hashes A-Z as a-z.
    """
    byte = _BYTE_LOWER if lower else _BYTE
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    a, end = int(at[0]), int(at[-1])
    while a < end:
        b = min(a + PIECE, end)
        if b < end:
            stop = int(at[np.searchsorted(at, b)])
            if stop - b > PIECE:  # inside a long text: cut at white space
                while b < stop and not (near := SPACE[data[b : min(b + 4096, stop)]]).any():
                    b = min(b + 4096, stop)
                stop = b + int(near.argmax()) if b < stop else stop
            b = stop
        seg = data[a:b]
        is_word = ~SPACE[seg]
        inner = at[np.searchsorted(at, a, "right") : np.searchsorted(at, b, "left")] - a
        before = np.zeros(len(seg) + 1, bool)
        before[1:] = is_word
        before[inner] = False
        starts = np.flatnonzero(is_word & ~before[:-1])
        if len(starts):
            after = np.zeros(len(seg) + 1, bool)
            after[:-1] = is_word
            after[inner] = False
            ends = np.flatnonzero(is_word & ~after[1:]) + 1
            size = ends - starts
            packed = np.cumsum(size) - size
            place = np.arange(int(packed[-1] + size[-1])) - np.repeat(packed, size)
            value = byte[seg[is_word]] * _power(int(size.max()))[place]
            h = np.add.reduceat(value, packed) + size.astype(np.uint64)
            found.append((starts + a, ends + a, mix(h)))
        a = b
    if found:
        start, stop, h = (np.concatenate(x) for x in zip(*found, strict=True))
    else:
        start, stop, h = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return start, stop, h, np.searchsorted(start, at, "left")


_LANES = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n consecutive words (n at most 64), also across texts: the caller leaves those out."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    total = h[: len(h) - n + 1] * _LANES[0]
    for j in range(1, n):
        total = total + h[j : len(h) - n + 1 + j] * _LANES[j]
    return mix(total)
