"""Vectorised word and shingle hashes over Arrow string columns.

A column's UTF-8 buffer is hashed in place: every byte gets a fixed random
64-bit code, a running sum of ``code * base^position`` gives each word's hash
from two array lookups, and shingles combine the mixed hashes of neighbouring
words.  Work is done on slices of about ``SLICE_BYTES``, so memory does not
depend on the batch; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_M64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_RNG = np.random.default_rng(20240229)
_CODE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = [int(x) | 1 for x in _RNG.integers(1, 1 << 62, 16, dtype=np.uint64)]

#: Separators of the word rule ``[^\x20\x09-\x0D]+``.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
#: Separators of the word rule "runs of ASCII letters, ASCII digits and non-ASCII characters".
NOT_ALNUM = bytes(b for b in range(128) if not chr(b).isalnum())


def byte_codes(separators: bytes, fold_case: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(is-word table, code table) by byte; ``fold_case`` gives A-Z the codes of a-z."""
    code = _CODE.copy()
    if fold_case:
        code[65:91] = code[97:123]
    word = np.ones(256, dtype=bool)
    word[list(separators)] = False
    return word, code


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (all output bits depend on all input bits)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = pow(_BASE, -1, 1 << 64)
            self.up, self.down = (self._row(b, n) for b in (_BASE, inverse))
        return self.up, self.down

    @staticmethod
    def _row(base: int, n: int) -> np.ndarray:
        out = np.ones(n, dtype=np.uint64)
        done, factor = 1, base & _M64
        while done < n:  # doubling: out[done + i] = out[i] * base^done
            m = min(done, n - done)
            out[done:done + m] = out[:m] * np.uint64(factor)
            done, factor = done + m, factor * factor & _M64
        return out


_POWERS = _Powers()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as the empty text."""
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold about ``limit`` bytes together, one row at least."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """S with S[i] = sum of codes[j] * base^j over j < i (modulo 2^64)."""
    out = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * _POWERS.get(len(codes) + 1)[0][:len(codes)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free hash of the codes in [start, end), not yet mixed."""
    return (sums[end] - sums[start]) * _POWERS.get(len(sums))[1][start]


def shift_left(sums: np.ndarray) -> np.ndarray:
    """Sums of codes that move one place to the left."""
    return sums * _POWERS.get(2)[1][1]


def to_origin(sums: np.ndarray, start: int) -> np.ndarray:
    """Position-free form of sums whose first code stands at ``start``."""
    return sums * _POWERS.get(start + 1)[1][start]


def words(data: np.ndarray, offsets: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash, first) of the words of the texts data[offsets[i]:offsets[i+1]].

    Positions count from offsets[0]; text i has the words first[i]:first[i+1].
    """
    is_word, code = tables
    lo = int(offsets[0])
    data = data[lo:int(offsets[-1])]
    inside = is_word[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # a word never spans two texts
    edge[(offsets - lo)] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    # the length goes in too: equal sums of different lengths stay apart
    h = mix(span_hash(prefix_sums(code[data]), start, end) + (end - start).astype(np.uint64))
    return start, end, h, np.searchsorted(start, offsets - lo)


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` neighbouring word hashes (order matters)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, _STEP[width % len(_STEP)], dtype=np.uint64)
    for j in range(width):
        out = out * np.uint64(_STEP[0]) + h[j:j + n]
    return mix(out)


def text_shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Shingles of one text; with fewer words than ``width`` the whole sequence is one."""
    return shingles(h, min(width, len(h))) if len(h) else np.zeros(0, dtype=np.uint64)


def shingle_sets(column: pa.Array, tables, width: int) -> Iterator[np.ndarray]:
    """Per text of a string column: its distinct shingles in ascending order."""
    data, offsets = text_buffer(column)
    for a, b in slices(offsets):
        _, _, h, first = words(data, offsets[a:b + 1], tables)
        for i in range(b - a):
            yield np.unique(text_shingles(h[first[i]:first[i + 1]], width))
