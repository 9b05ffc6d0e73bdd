"""Words and their hashes, for whole Arrow columns at once (numpy)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
SHINGLE = 5
#: Bytes of text that are hashed at a time; a longer document is taken alone.
BLOCK_BYTES = 1 << 21

_random = np.random.default_rng(20240607)
_LETTER = _random.integers(0, 1 << 64, 256, dtype=np.uint64)
_LETTER[65:91] = _LETTER[97:123]  # A-Z count as a-z
#: Bytes that part words: white space; or all of ASCII but letters and digits.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LETTERS = np.ones(256, bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_BASE = int(_random.integers(0, 1 << 62)) * 8 + 3
_STEP = _random.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        n = max(n, BLOCK_BYTES + 1)
        steps = np.full(n, _BASE, np.uint64)
        steps[0] = 1
        back = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        back[0] = 1
        _powers, _inverse = np.multiply.accumulate(steps), np.multiply.accumulate(back)
    return _powers, _inverse


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end, and where each begins (one more: the end). Null is empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset :][: len(column) + 1]
    at = at.astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows of about BLOCK_BYTES."""
    flat, at = utf8(column)
    row = 0
    while row < len(at) - 1:
        end = max(row + 1, int(np.searchsorted(at, at[row] + BLOCK_BYTES, "right")) - 1)
        yield row, end, flat[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def words(flat: np.ndarray, at: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z lower-cased) in order, and the index of each document's first word."""
    if not len(flat):
        return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    inside = ~gap[flat]
    first = np.zeros(len(flat) + 1, bool)
    first[at] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power, inverse = _power_tables(len(flat))
    total = np.empty(len(flat) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_LETTER[flat] * power[: len(flat)], out=total[1:])
    h = (total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)
    return mix(h), np.searchsorted(s, at)


def shingles(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its runs of five words); fewer words count as one run."""
    for first, end, flat, at in blocks(column):
        h, w = words(flat, at)
        runs = np.zeros(max(0, len(h) - SHINGLE + 1), np.uint64)
        for k in range(SHINGLE if len(runs) else 0):
            runs += h[k : k + len(runs)] * _STEP[k]
        runs = mix(runs)
        for row in range(first, end):
            a, b = w[row - first], w[row - first + 1]
            if b - a >= SHINGLE:
                yield row, np.unique(runs[a : b - SHINGLE + 1])
            elif b > a:
                short = (h[a:b] * _STEP[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                yield row, mix(np.array([short], np.uint64))
            else:
                yield row, np.empty(0, np.uint64)
