"""Vectorised text helpers for tasks that read Arrow batches of strings.

A batch of texts is one byte buffer plus offsets, so splitting into words and
hashing every word takes a fixed number of numpy passes over the bytes.  The
buffer is walked in slices of whole texts (``SLICE_BYTES`` at a time, one text
at least), which bounds the memory of a task whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# words of letters and digits only: ASCII alphanumerics and all bytes of other characters
_PLAIN = np.ones(256, dtype=bool)
_PLAIN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_POWERS = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64): spreads every input bit over the word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, n at least."""
    if len(_POWERS["up"]) < n:
        size = 1 << int(n - 1).bit_length()
        for key, step in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, step, dtype=np.uint64)
            steps[0] = 1
            _POWERS[key] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


@dataclass
class Words:
    """Words of consecutive texts: byte range, text index and 64-bit hash."""

    data: np.ndarray    # bytes of the slice (lower-cased when asked)
    first: int          # index of the slice's first text in the batch
    n_texts: int
    start: np.ndarray   # of each word, in data
    end: np.ndarray
    text: np.ndarray    # index of each word's text within the slice
    hash: np.ndarray
    count: np.ndarray   # words of each text
    bounds: np.ndarray  # byte offset of each text in data, and the end


def byte_slices(texts: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets) for runs of whole texts; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if n == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    bufs = texts.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int64 if wide else np.int32)[texts.offset: texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + slice_bytes, side="right")) - 1)
        j = min(j, n)
        yield i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def words(texts: pa.Array, lower: bool = True, slice_bytes: int = SLICE_BYTES, plain: bool = False) -> Iterator[Words]:
    """Words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased if asked) of each text.

    ``plain``: runs of ASCII letters, digits and characters beyond ASCII instead.
    """
    between = _PLAIN if plain else _SPACE
    for first, data, bounds in byte_slices(texts, slice_bytes):
        if lower:
            data = _LOWER[data]
        n_texts = len(bounds) - 1
        inside = ~between[data]
        before = np.empty_like(inside)
        after = np.empty_like(inside)
        if len(data):
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
            edges = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
            before[edges] = False
            after[edges - 1] = False
        start = np.flatnonzero(inside & ~before)
        end = np.flatnonzero(inside & ~after) + 1
        up, down = _powers(len(data) + 1)
        run = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=run[1:])
        hashes = mix((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))
        text = np.searchsorted(bounds, start, side="right") - 1
        yield Words(data, first, n_texts, start, end, text, hashes,
                    np.bincount(text, minlength=n_texts).astype(np.int64), bounds)


def spans_hash(w: Words, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of other byte ranges of the slice, as ``words`` hashes words."""
    up, down = _powers(len(w.data) + 1)
    run = np.zeros(len(w.data) + 1, dtype=np.uint64)
    np.cumsum((w.data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=run[1:])
    return mix((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive word hashes (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[j:j + n]
    return mix(out)
