"""Words of many texts at once: numpy over the bytes of Arrow string columns.

A word's hash is the sum of a random value per byte times a power of an odd
number (its place in the chunk), brought back to place 0 and mixed; equal words
have equal hashes wherever they stand, and two different words meet with a
chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RATE = 0x9E3779B97F4A7C15 | 1
_RATE_INVERSE = pow(_RATE, -1, 1 << 64)
#: Bytes of text handled at once (a longer text is a chunk of its own).
CHUNK = 1 << 21


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = _lower_table()
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK, 1 << max(0, n - 1).bit_length())
    if size not in _powers:
        def run(rate: int) -> np.ndarray:
            steps = np.full(size, rate, np.uint64)
            steps[0] = 1
            return np.cumprod(steps)
        _powers.clear()
        _powers[size] = run(_RATE), run(_RATE_INVERSE)
    return _powers[size]


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, bytes) of runs of rows of up to CHUNK bytes; offsets start at 0.  Nulls are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1)
        yield row, offsets[row:end + 1] - offsets[row], data[offsets[row]:offsets[end]]
        row = end


def spans(offsets: np.ndarray, data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the maximal runs of bytes of ``is_word`` in each row of a chunk."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    cut = np.zeros(len(data) + 1, bool)  # a row's first byte never continues a word
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of bytes (lower-case them first, if case is not to matter)."""
    up, down = _power_tables(len(data))
    summed = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[:len(data)], out=summed[1:])
    return mixed((summed[ends] - summed[starts]) * down[starts] ^ (ends - starts).astype(np.uint64))
