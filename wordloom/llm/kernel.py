"""Vectorised word and shingle hashing over UTF-8 bytes (numpy, inside Spark tasks).

A word is a maximal run of bytes that are not separators. Separators are ASCII,
so byte positions never split a code point. Word hashes are polynomial sums
modulo 2^64, read off one prefix sum per chunk; a final mix spreads the bits.
Texts are taken in chunks of bounded size, so memory does not depend on the
number of rows in an Arrow batch (one text is never split).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

CHUNK_BYTES = 1 << 19
SHINGLE_WORDS = 5

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_Q = np.uint64(0xD6E8FEB86659FD93)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_powers: list[np.ndarray] = []


def white_space() -> np.ndarray:
    """Separators of ``[^\\x20\\x09-\\x0D]+`` words."""
    t = np.zeros(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


def not_letters() -> np.ndarray:
    """Separators where a word is ASCII letters and digits, or non-ASCII text."""
    t = np.ones(256, bool)
    t[128:] = False
    for a, b in (("0", "9"), ("A", "Z"), ("a", "z")):
        t[ord(a): ord(b) + 1] = False
    return t


def _values() -> np.ndarray:
    """A random-looking 64-bit value per byte, A-Z as a-z."""
    low = np.arange(256)
    low[65:91] += 32
    return mix(low.astype(np.uint64) + np.uint64(0x51ED270B))


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h = h ^ (h >> np.uint64(29))
    h = h * _M2
    return h ^ (h >> np.uint64(32))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = max(n, CHUNK_BYTES * 2)
        tables = []
        for base in (_P, _P_INV):
            t = np.full(n, base, np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers[:] = tables
    return _powers


def chunks(texts: Sequence[str | None], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first row, end row, joined UTF-8 bytes, row offsets) over all texts; null counts as empty."""
    first, parts, total = 0, [], 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if t else b""
        parts.append(b)
        total += len(b)
        if total >= size:
            yield first, i + 1, b"".join(parts), _offsets(parts)
            first, parts, total = i + 1, [], 0
    if parts:
        yield first, first + len(parts), b"".join(parts), _offsets(parts)


def _offsets(parts: list[bytes]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])


VALUES = _values()


def words(data: bytes, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, its row, its start byte) in text order."""
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~separators[raw]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begin[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    s, e = np.flatnonzero(begin), np.flatnonzero(end)
    power, inverse = _power_tables(n)
    total = np.cumsum(VALUES[raw] * power[:n], dtype=np.uint64)
    h = total[e] - np.where(s > 0, total[np.maximum(s - 1, 0)], np.uint64(0))
    row = np.searchsorted(offsets, s, side="right") - 1
    return mix(h * inverse[s] + (e - s).astype(np.uint64)), row, s


def combine(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every window of ``k`` consecutive words (rows not separated)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        out = out * _Q + h[j: len(h) - k + 1 + j]
    return mix(out + np.uint64(k))


def shingle_sets(texts: Sequence[str | None], k: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct hashes of its ``k``-word windows.

    A text of 1 to ``k - 1`` words has one window, the whole sequence; a text
    without words, an empty text and null have none.
    """
    separators = white_space()
    for first, last, data, offsets in chunks(texts):
        h, row, _ = words(data, offsets, separators)
        bounds = np.searchsorted(row, np.arange(last - first + 1))
        w = combine(h, k)
        for i in range(last - first):
            a, b = int(bounds[i]), int(bounds[i + 1])
            if b - a >= k:
                x = np.sort(w[a: b - k + 1])
                keep = np.empty(len(x), bool)
                keep[0] = True
                np.not_equal(x[1:], x[:-1], out=keep[1:])
                yield x[keep]
            elif b > a:
                yield combine(h[a:b], b - a)
            else:
                yield np.zeros(0, np.uint64)
