"""Vectorised text helpers for Arrow batches: slices of bounded size, word and pre-token boundaries, 64-bit hashes.

Everything works on the flat UTF-8 buffer of many documents at once. A slice holds whole documents; only a document that
is longer than the slice limit gets a slice of its own, so memory is bounded by the limit or by the longest document.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_rng = np.random.default_rng(20240229)
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LETTER, NUMBER, SPACE, OTHER = range(4)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, document offsets) of consecutive row ranges; null texts are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


@functools.lru_cache(maxsize=1)
def _powers(log2: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << log2
    inverse = pow(_MULTIPLIER, -1, 2**64)
    out = []
    for base in (_MULTIPLIER, inverse):
        p = np.ones(n, np.uint64)
        k = 1
        while k < n:  # doubling
            p[k:2 * k] = p[:k] * np.uint64(pow(base, k, 2**64))
            k *= 2
        out.append(p)
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for many spans, from one prefix sum."""
    n = len(data)
    power, inverse = _powers(max(20, int(n).bit_length()))
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * power[:n], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words `[^ \\t-\\r]+` with A-Z in lower case, and the index of each document's first word."""
    low = _LOWER[data]
    inside = ~_SPACE[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True  # words do not cross documents
    cut = np.flatnonzero(edge)
    keep = inside[cut[:-1]] if len(data) else np.zeros(0, bool)
    start, end = cut[:-1][keep], cut[1:][keep]
    return span_hashes(low, start, end), np.searchsorted(start, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes sorted within each document, index of each document's first one).

    A document with fewer words than `size` has its whole word sequence as its only shingle, one without words none."""
    n = len(hashes)
    weight = [np.uint64(pow(_MULTIPLIER, 7 * k + 3, 2**64)) for k in range(size)]
    rolled = np.zeros(max(0, n - size + 1), np.uint64)
    for k in range(size):
        rolled += hashes[k:n - size + 1 + k] * weight[k]
    rolled = mix(rolled)
    parts, counts = [], []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            own = np.unique(rolled[a:b - size + 1])
        elif b > a:
            whole = np.uint64(b - a)
            own = mix(np.sum(hashes[a:b] * np.array(weight[:b - a]), keepdims=True) + whole)
        else:
            own = np.zeros(0, np.uint64)
        parts.append(own)
        counts.append(len(own))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


@functools.lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    out = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        c = unicodedata.category(chr(cp))[0]
        if c == "L":
            out[cp] = LETTER
        elif c == "N":
            out[cp] = NUMBER
    # fixed values: the code points of Unicode's White_Space property
    out[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return out


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, byte position of each and of the end) of valid UTF-8."""
    cp = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    return cp, np.append(at, len(data))


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte position where each pre-token starts, index of each document's first one): what the public pattern
    `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+` matches, found from runs of one class."""
    cp, at = code_points(data)
    n = len(cp)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cls = char_classes()[cp]
    doc = np.searchsorted(at, offsets)  # document starts in code points
    run = np.ones(n + 1, bool)
    run[1:-1] = cls[1:] != cls[:-1]
    run[doc] = True
    begin = np.flatnonzero(run)
    begin, stop = begin[:-1], begin[1:]
    first = np.zeros(n + 1, bool)
    first[doc] = True
    kind = cls[begin]
    start = run.copy()
    white = kind == SPACE
    inner = white & ~first[stop]
    start[stop[inner] - 1] = True  # the last white character stands alone or joins what follows
    joined = ~white & ~first[begin]
    joined[joined] = cp[begin[joined] - 1] == 0x20
    start[begin[joined]] = False
    # contractions: a lone apostrophe that no space precedes, then letters of the same document
    lone = (kind == OTHER) & (stop - begin == 1) & (cp[begin] == 0x27) & ~joined & ~first[stop]
    i = begin[lone]
    i = i[cls[i + 1] == LETTER]
    c1 = cp[i + 1]
    one = np.isin(c1, [ord(c) for c in "stmd"])
    start[i[one] + 1] = False
    start[i[one] + 2] |= True
    j = i[~one]
    j = j[(j + 2 < n)]
    j = j[~first[j + 2]]
    pair = cp[j + 1].astype(np.uint64) << np.uint64(32) | cp[j + 2]
    two = j[np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]
    start[two + 1] = False
    start[two + 3] |= True
    start[n] = True
    begins = np.flatnonzero(start[:n])
    return at[begins], np.searchsorted(at[begins], offsets)
