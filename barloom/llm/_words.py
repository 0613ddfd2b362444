"""Vectorised word hashing over the UTF-8 bytes of Arrow text columns.

Words are runs of digits, letters and all non-ASCII characters; A-Z count as a-z. On UTF-8 bytes that
is a 256-entry mask, so a whole batch is cut and hashed by numpy without a Python loop over words."""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK = 1 << 20

_BYTE = np.arange(256)
WORD = ((_BYTE >= 48) & (_BYTE <= 57)) | ((_BYTE >= 97) & (_BYTE <= 122)) | ((_BYTE >= 65) & (_BYTE <= 90)) | (_BYTE >= 128)
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)


def frugal(run: Callable, forget: Callable = lambda: None) -> Callable:
    """A task's function over batches that hands back at its end what it has freed: Python workers live on and keep it, beside those of later stages. `forget` drops first what the task has learned."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            forget()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # not every C library has it
                ctypes.CDLL(None).malloc_trim(0)

    return whole


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64's constants)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_VALUE = mix((_BYTE.astype(U) + U(1)) * U(0x9E3779B97F4A7C15))
_BASE, _INVERSE = 0xD1342543DE82EF95, pow(0xD1342543DE82EF95, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the rolling hash's base and of its inverse modulo 2^64."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK + (CHUNK >> 1))
        grown = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, dtype=U)
            p[0] = 1
            grown.append(np.multiply.accumulate(p))
        have = _powers[0] = (grown[0], grown[1])
    return have


def prefix_hash(data: np.ndarray, values: np.ndarray = _VALUE) -> np.ndarray:
    """Prefix sums whose differences, scaled by the inverse power, are hashes of any substring."""
    p, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=U)
    np.cumsum(values[data] * p[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inverse = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(U) * U(0x9E3779B97F4A7C15))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column without copying; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    if len(column) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0] : o[-1]], o - o[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about limit bytes each; a longer row is a range by itself."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = j


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word, and for each row the index of its first word (one more entry at the end)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, U), z, z, np.zeros(len(offsets), np.int64)
    w = WORD[data]
    edge = np.empty(n + 1, bool)
    edge[0], edge[n] = w[0], w[-1]
    edge[1:n] = w[1:] != w[:-1]
    at = offsets[1:-1]
    at = np.unique(at[(at > 0) & (at < n)])  # empty rows repeat a place
    both = at[w[at] & w[at - 1]]  # a word ends and another begins where rows meet
    cuts = np.flatnonzero(edge)
    if len(both):
        cuts = np.sort(np.concatenate([cuts, both, both]))
    start, end = cuts[0::2], cuts[1::2]
    prefix = prefix_hash(LOWER[data])
    return span_hash(prefix, start, end), start, end, np.searchsorted(start, offsets)


def grams(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of size consecutive words, at each word that begins so many (rows are not told apart)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.zeros(n, dtype=U)
    for j in range(size):
        out = out * U(0x9E3779B97F4A7C15) + h[j : j + n]
    return mix(out)
