"""Words and shingles of Arrow string columns as flat numpy arrays.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, with A-Z
lower-cased; both rules are safe on UTF-8 bytes. All functions work on slices of
a bounded number of bytes (one document at least), whatever the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection of 64-bit values."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        m = max(n, SLICE_BYTES) + 1
        _POWERS.clear()
        for base in (_BASE, _INVERSE):
            p = np.full(m, base, _U)
            p[0] = 1
            _POWERS.append(np.cumprod(p, dtype=_U))
    return _POWERS[0], _POWERS[1]


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of the documents ``first`` to ``first + n_docs`` of a batch."""

    first: int
    n_docs: int
    data: np.ndarray  # bytes, as given
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # bounds[i]:bounds[i + 1] are document i's words

    @property
    def doc(self) -> np.ndarray:
        """For each word the index of its document in this slice."""
        return np.repeat(np.arange(self.n_docs), np.diff(self.bounds))

    def hashes(self, fold: bool = True) -> np.ndarray:
        """A 64-bit hash of each word, lower-cased if ``fold``."""
        lower = self.data + (((self.data >= 65) & (self.data <= 90)) * np.uint8(32)) if fold else self.data
        up, down = _powers(len(lower))
        total = np.zeros(len(lower) + 1, _U)
        np.cumsum((lower.astype(_U) + _U(1)) * up[: len(lower)], out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def word_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Words]:
    """Cut a string column into slices of about ``limit`` bytes and find their words."""
    data, offsets = string_buffers(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(n, max(at + 1, end))
        raw, cut = data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
        before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = cut[1:-1]
        before[edges[edges < len(raw)]] = False
        after[edges[edges > 0] - 1] = False
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        yield Words(at, end - at, raw, starts, ends, np.searchsorted(starts, cut))
        at = end


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles and the bounds of each document's.

    A document with 1 to k-1 words has one shingle, its whole sequence.
    """
    sizes = np.diff(bounds)
    n = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    out = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(out[-1]) - np.repeat(out[:-1] - bounds[:-1], n)
    value = np.zeros(len(at), _U)
    left = np.repeat(np.minimum(sizes, k), n)
    for j in range(k):
        word = hashes[np.minimum(at + j, max(len(hashes) - 1, 0))] if len(hashes) else value
        value = mix(value * _U(0x2545F4914F6CDD1D) + np.where(j < left, word, _U(0)) + _U(j + 1))
    return value, out


def distinct_sets(values: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """Each document's distinct values, sorted."""
    for i in range(len(bounds) - 1):
        yield np.unique(values[bounds[i] : bounds[i + 1]])
