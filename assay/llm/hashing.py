"""Vectorised word and shingle hashes over Arrow string arrays.

A word is a maximal run of bytes outside the six ASCII white-space bytes; A-Z
count as a-z. Hashes are 64 bits wide and the same in every process.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Words of more chunks of eight bytes than this are hashed one by one.
LONG_WORD = 64
#: Shingles of a row beyond which it is sorted by itself.
SORTED_ALONE = 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def string_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n + 1 offsets) of a string array; a null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.string())
    arr = pc.fill_null(arr, "").cast(pa.large_string())
    _, offs, data = arr.buffers()
    o = np.frombuffer(offs, np.int64)[arr.offset : arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None and o[-1] > o[0] else np.zeros(0, np.uint8)
    return raw, o - o[0]


def chunks(arr: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes, one row at least, so that memory stays bounded."""
    _, o = string_bytes(arr)
    lo, n = 0, len(o) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(o, o[lo] + size, "right")) - 1)
        yield lo, hi
        lo = hi


def word_spans(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and n + 1 offsets of the rows into the words."""
    inside = ~_SPACE[raw]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = offs[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    start[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, offs)


def range_hash(lowered: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hash of each byte range [s, e): eight bytes at a time are mixed in, so that ranges of up to eight bytes never
    collide with others of their length, and longer ones only by chance. The few very long ones go through BLAKE2b."""
    size = e - s
    h = mix(size.astype(np.uint64) * _U(0xD6E8FEB86659FD93) + _U(0x2545F4914F6CDD1D))
    padded = np.concatenate([lowered, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(lowered) + 1,), "<u8", padded, 0, (1,))
    short = size <= 8 * LONG_WORD
    left = np.flatnonzero(short & (size > 0))
    for k in range(LONG_WORD):
        if not len(left):
            break
        rest = size[left] - 8 * k
        chunk = eight[s[left] + 8 * k]
        cut = rest < 8
        chunk = np.where(cut, chunk & ((_U(1) << (np.minimum(rest, 7).astype(np.uint64) * _U(8))) - _U(1)), chunk)
        h[left] = mix(h[left] ^ chunk) + _U(0x9E3779B97F4A7C15)
        left = left[rest > 8]
    for i in np.flatnonzero(~short):
        h[i] = np.frombuffer(hashlib.blake2b(lowered[s[i] : e[i]].tobytes(), digest_size=8).digest(), "<u8")[0]
    return h


def word_hashes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, offs = string_bytes(arr)
    s, e, at = word_spans(raw, offs)
    return range_hash(_LOWER[raw], s, e), at


def lowered(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def shingle_sets(arr: pa.Array, width: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted within the row; their row numbers; n + 1 offsets.

    A row of one to ``width`` - 1 words has its whole sequence as its only shingle; one without words has none.
    """
    h, at = word_hashes(arr)
    n_words = np.diff(at)
    n = len(n_words)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | _U(1)
    whole = n_words >= width
    counts = np.where(whole, n_words - width + 1, n_words > 0)
    starts = np.concatenate(([0], np.cumsum(counts)))
    row = np.repeat(np.arange(n), counts)
    val = np.empty(len(row), np.uint64)
    full = np.flatnonzero(whole[row])
    value = np.zeros(max(len(h) - width + 1, 0), np.uint64)
    for k in range(width):
        value += h[k : k + len(value)] * factors[k]
    val[full] = mix(value[full + (at[:-1] - starts[:-1])[row[full]]])
    for m in range(1, width):
        short = np.flatnonzero(n_words == m)
        value = np.full(len(short), _U(0x1234567 * m), np.uint64)
        for k in range(m):
            value += h[at[short] + k] * factors[k]
        val[starts[short]] = mix(value + _U(m))
    # a row's values lie side by side: long rows are sorted where they lie, the short ones all at once
    long = counts > SORTED_ALONE
    for lo, hi in zip(starts[:-1][long].tolist(), starts[1:][long].tolist(), strict=True):
        val[lo:hi].sort()
    rest = np.flatnonzero(((counts > 1) & ~long)[row])
    val[rest] = val[rest][np.lexsort((val[rest], row[rest]))]
    if len(row):
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (val[1:] != val[:-1])
        row, val = row[first], val[first]
    return val, row, np.searchsorted(row, np.arange(n + 1))
