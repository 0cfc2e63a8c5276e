"""Vectorised word spans and word hashes over Arrow string columns.

Everything works on the raw UTF-8 bytes of a run of rows, so a batch costs a few NumPy passes
instead of a Python loop per word. Memory is bounded: rows are taken in runs of about
``CHUNK_BYTES`` (a longer text is a run of its own) and hashes are computed ``BLOCK_BYTES`` at
a time.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
BLOCK_BYTES = 1 << 20
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
#: Lower-cases A-Z and leaves every other byte alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a:b + 1] = True
    return out


#: Words are runs of anything but space and the control characters 9 to 13.
NOT_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: Words are runs of ASCII letters and digits and of any non-ASCII character.
ALNUM = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def string_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    n = len(arr)
    offs = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]]
    return buf, offs - offs[0]


def runs(arr: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of about ``max_bytes``."""
    buf, offs = string_buffers(arr)
    n, a = len(offs) - 1, 0
    while a < n:
        b = int(np.searchsorted(offs, offs[a] + max_bytes, side="right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b, buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        a = b


def word_spans(buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets per row): maximal runs of word bytes; no word crosses a row."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    w = is_word[buf]
    first = w.copy()
    first[1:] &= ~w[:-1]
    last = w.copy()
    last[:-1] &= ~w[1:]
    cut = offs[(offs > 0) & (offs < n)]
    first[cut] = w[cut]
    last[cut - 1] = w[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: a bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@functools.lru_cache(maxsize=4)
def byte_table(fold_case: bool) -> np.ndarray:
    t = mix(np.arange(1, 257, dtype=np.uint64) * U(_BASE))
    return t[LOWER] if fold_case else t


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        n = max(n, BLOCK_BYTES + 4096)
        inv = pow(_BASE, -1, 1 << 64)
        for k, base in enumerate((_BASE, inv)):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool = True) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: a polynomial over random byte values modulo
    2^64, from one prefix sum, then mixed. Equal bytes give equal hashes wherever they stand."""
    table = byte_table(fold_case)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, base + BLOCK_BYTES)))
        top = int(ends[j - 1])
        p, inv = _powers(top - base + 1)
        s = np.zeros(top - base + 1, np.uint64)
        np.cumsum(table[buf[base:top]] * p[:top - base], out=s[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((s[b] - s[a]) * inv[a] + (b - a).astype(np.uint64) * U(0xD6E8FEB86659FD93))
        i = j
    return out


def rows_of(offs: np.ndarray) -> np.ndarray:
    """Row number of each element, from per-row offsets."""
    return np.repeat(np.arange(len(offs) - 1), np.diff(offs))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive word hashes (order matters), length len(h) - k + 1."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    m = len(h) - k + 1
    acc = np.full(m, U(k), np.uint64)
    for j in range(k):
        acc = mix(acc * U(0xFF51AFD7ED558CCD) + h[j:j + m])
    return acc
