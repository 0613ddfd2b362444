"""Content-chosen anchors of all windows of a fixed number of bytes, and digests of byte ranges."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

from barloom.llm._words import CHUNK, U, chunks, prefix_hash, span_hash

#: Bytes of the k-gram at an anchor; a window of `length` bytes has length - GRAM + 1 of them.
GRAM = 48
#: Low bits of a hash that hold a position while the least one is sought.
PLACE = 24


def pieces(offsets: np.ndarray, length: int, limit: int = CHUNK) -> Iterator[tuple[int, int, int, int]]:
    """Row ranges of about limit bytes each and the bytes of each; a longer row comes in pieces that overlap by length - 1 bytes, so each of its windows is in one."""
    for i, j in chunks(offsets, limit):
        if j - i > 1 or offsets[j] - offsets[i] <= limit:
            yield i, j, int(offsets[i]), int(offsets[j])
            continue
        for at in range(int(offsets[i]), int(offsets[j]) - length + 1, limit):
            yield i, j, at, min(at + limit + length - 1, int(offsets[j]))


def digests(data: np.ndarray, start: np.ndarray, end: np.ndarray, place: np.ndarray, secret: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A keyed 128-bit digest of each byte range and its place, as two numbers: it stands for the bytes, and without the secret nobody can write texts whose digests agree."""
    held, keyed = memoryview(np.ascontiguousarray(data)), hashlib.blake2b(key=secret, digest_size=16)
    got = bytearray()
    for a, b, at in zip(start.tolist(), end.tolist(), place.tolist(), strict=True):
        one = keyed.copy()
        one.update(at.to_bytes(8, "little", signed=True))
        one.update(held[a:b])
        got += one.digest()
    both = np.frombuffer(bytes(got), U).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """For every window of `length` bytes within a row, the anchor is the leftmost of its k-grams with the least hash.

    Equal windows have their anchors at equal offsets. Returned for each run of windows of one row with one
    anchor: key (hash of the k-gram, which only brings runs together), row, anchor, first and last window start, as
    positions in data. A longer text comes in pieces (see `pieces`)."""
    if len(data) >> PLACE:
        raise ValueError(f"{len(data)} bytes at once; positions have {PLACE} bits")
    empty = np.zeros(0, np.int64)
    n = len(data)
    if n < length:
        return np.zeros(0, U), empty, empty, empty, empty
    prefix = prefix_hash(data)
    at = np.arange(n - gram + 1)
    h = span_hash(prefix, at, at + gram)
    packed = (h & ~U((1 << PLACE) - 1)) | at.astype(U)
    width = length - gram + 1
    have = 1  # least of `have` consecutive values, doubled while it fits
    low = packed
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    rest = width - have
    low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
    anchor = (low & U((1 << PLACE) - 1)).astype(np.int64)
    starts = np.arange(len(anchor))
    row = np.searchsorted(offsets, starts, side="right") - 1
    inside = starts + length <= offsets[row + 1]
    change = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]) & inside
    first = np.flatnonzero(change)
    # a run ends where the anchor or the row changes or the row has no further window
    stop = np.flatnonzero(np.concatenate([(anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | ~inside[1:], [True]]) & inside)
    a = anchor[first]
    return h[a], row[first], a, first, stop
