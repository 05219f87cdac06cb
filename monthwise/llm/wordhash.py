"""Words and word shingles of whole texts, vectorised over the bytes of an Arrow batch.

A word is a maximal run of characters other than ``\\x20 \\x09-\\x0D``.  Those are
all single bytes in UTF-8, so the byte view gives the same words as the text.
Every word gets a 64-bit hash of its bytes, and shingles combine word hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20          # texts are hashed in slices of about this many bytes

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_SEP = np.zeros(256, dtype=bool)
_SEP[[32, 9, 10, 11, 12, 13]] = True
# A second word notion for classifiers: runs of letters and digits (any byte beyond ASCII counts).
_NOT_ALNUM = np.ones(256, dtype=bool)
_NOT_ALNUM[48:58] = _NOT_ALNUM[65:91] = _NOT_ALNUM[97:123] = _NOT_ALNUM[128:] = False
_MUL = 0x9E3779B97F4A7C15 | 3
_INV = pow(_MUL, -1, 1 << 64)
_POW: dict[str, np.ndarray] = {}


def _powers(kind: str, base: int, n: int) -> np.ndarray:
    have = _POW.get(kind)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.full(size, base & (2**64 - 1), dtype=np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(have)
        if size <= 8 * SLICE_BYTES:      # a huge single text does not stay in memory
            _POW[kind] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64's)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def hash_words(data: np.ndarray, ends: np.ndarray, lower: bool, alnum: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in ``data`` (bytes; text i ends at ``ends[i]``)
    and, per text, the index after its last word."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    word = ~(_NOT_ALNUM if alnum else _SEP)[data]
    first = np.zeros(len(data) + 1, dtype=bool)       # a text starts here
    first[ends] = True
    first[0] = True
    prev = np.empty(len(data), dtype=bool)
    prev[0] = False
    prev[1:] = word[:-1]
    start = np.flatnonzero(word & (~prev | first[:-1]))
    nxt = np.empty(len(data), dtype=bool)
    nxt[-1] = False
    nxt[:-1] = word[1:]
    stop = np.flatnonzero(word & (~nxt | first[1:])) + 1
    with np.errstate(over="ignore"):
        val = (_LOWER if lower else _BYTE)[data] * _powers("m", _MUL, len(data) + 1)[:len(data)]
        run = np.empty(len(data) + 1, dtype=np.uint64)
        run[0] = 0
        np.cumsum(val, out=run[1:])
        h = (run[stop] - run[start]) * _powers("i", _INV, len(data) + 1)[start]
        h = mix(h + (stop - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    return h, np.searchsorted(start, ends)


def text_slices(column: pa.Array):
    """Yield (first row, data bytes, ends) over runs of rows of about SLICE_BYTES.
    Null texts count as empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    buf = column.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + SLICE_BYTES, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, data[off[lo]:off[hi]], off[lo + 1:hi + 1] - off[lo]
        lo = hi


def shingle_sets(column: pa.Array, k: int, lower: bool = True):
    """Per text the sorted distinct hashes of its k-word shingles; a text of fewer
    words has its whole word sequence as the one shingle; no words, no shingles."""
    mults = [pow(_MUL, 7 * j + 1, 1 << 64) | 1 for j in range(k)]
    for _, data, ends in text_slices(column):
        h, last = hash_words(data, ends, lower)
        m = max(0, len(h) - k + 1)
        with np.errstate(over="ignore"):
            sh = np.zeros(m, dtype=np.uint64)
            for j in range(k):
                sh += h[j:j + m] * _U(mults[j])
            sh = mix(sh)
        lo = 0
        for hi in last.tolist():
            if hi - lo >= k:
                one = sh[lo:hi - k + 1]
                one = np.sort(one)
                keep = np.empty(len(one), dtype=bool)
                keep[0] = True
                np.not_equal(one[1:], one[:-1], out=keep[1:])
                yield one[keep]
            elif hi > lo:
                with np.errstate(over="ignore"):
                    x = _U(hi - lo)
                    for j in range(lo, hi):
                        x = mix(np.array([x * _U(_MUL) + h[j]]))[0]
                yield np.array([x], dtype=np.uint64)
            else:
                yield np.zeros(0, np.uint64)
            lo = hi
