"""Whole texts as UTF-8 bytes in numpy: words, windows of words and their hashes.

Used inside Arrow functions. Texts lie end to end in one byte array, so a batch is handled by
vector operations instead of a loop over words. Memory is about 50 bytes per byte of a slice;
a slice holds whole texts and passes ``SLICE`` only where a single text is longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 20  # bytes of text handled at once

SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
NOT_SPACE = ~SPACES
# Digits, letters and every byte of a non-ASCII character.
ALPHANUMERIC = np.array(
    [b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256)]
)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 2**64, 256, dtype=np.uint64)
_BASES = {"byte": 0x9E3779B97F4A7C15, "word": 0xC2B2AE3D27D4EB4F, "check": 0xD6E8FEB86659FD93}
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base and of its inverse, modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size, b = max(n, 1 << 20), _BASES[base]
        steps = [np.full(size, x, np.uint64) for x in (b, pow(b, -1, 1 << 64))]
        for x in steps:
            x[0] = 1
        known = tuple(np.cumprod(x, dtype=np.uint64) for x in steps)
        if n <= 1 << 23:
            _powers[base] = known
    return known[0][:n], known[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class Texts(NamedTuple):
    data: np.ndarray  # bytes of all texts, end to end
    at: np.ndarray  # where each text begins, and the end


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The texts of an Arrow column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if not len(column):
        return Texts(np.empty(0, np.uint8), np.zeros(1, np.int64))
    kind = np.int64 if column.type in (pa.large_string(), pa.large_binary()) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return Texts(raw[at[0] : at[-1]], at - at[0])


def slices(texts: Texts, limit: int = SLICE) -> Iterator[tuple[int, int, Texts]]:
    """Runs of whole texts of about ``limit`` bytes: first row, row after the last, their texts."""
    n, i = len(texts.at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(texts.at, texts.at[i] + limit, "right")) - 1)
        j = min(j, n)
        at = texts.at[i : j + 1]
        yield i, j, Texts(texts.data[at[0] : at[-1]], at - at[0])
        i = j


class Words(NamedTuple):
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after its last
    first: np.ndarray  # number of the first word of each text, and the number of words
    hash: np.ndarray  # 64 bits of its bytes

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def spans(texts: Texts, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest runs of the bytes marked by ``inside``, never over the end of a text."""
    data, at = texts
    if not len(data):
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(at), np.int64)
    member = inside[data]
    border = np.zeros(len(data) + 1, bool)
    border[at] = True
    opens = member.copy()
    opens[1:] &= ~member[:-1] | border[1:-1]
    closes = member
    closes[:-1] &= ~member[1:] | border[1:-1]
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) + 1, np.searchsorted(start, at)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges."""
    power, inverse = powers("byte", len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:-1], out=sums[1:])
    return mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def words(texts: Texts, inside: np.ndarray = NOT_SPACE) -> Words:
    start, end, first = spans(texts, inside)
    return Words(start, end, first, hashes(texts.data, start, end))


def lowered(texts: Texts) -> Texts:
    return Texts(LOWER[texts.data], texts.at)


def ranges(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: str = "word") -> np.ndarray:
    """64-bit hashes of ranges of a sequence of 64-bit values."""
    power, inverse = powers(base, len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * power[:-1], out=sums[1:])
    return mixed((sums[hi] - sums[lo]) * inverse[lo] + (hi - lo).astype(np.uint64))


def windows(w: Words, k: int, base: str = "word") -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words at which a window of ``k`` words of one text starts, and its hash."""
    last = np.repeat(w.first[1:], w.counts)
    lo = np.flatnonzero(np.arange(len(w.hash)) + k <= last)
    return lo, ranges(w.hash, lo, lo + k, base)


def sums_by_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the values between neighbouring places of ``at``."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[at])


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts keys (stable), and where each run of equal keys begins in it."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(keys) else np.empty(0, np.int64)


def lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """A list column from its values end to end and the length of each list."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)
