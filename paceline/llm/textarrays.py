"""Words, word hashes and shingles of UTF-8 text as numpy arrays, for many documents at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)
_BASE = U(0xD6E8FEB86659FD93)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUE = mix((np.arange(1, 257, dtype=np.uint64)) * _ODD)[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _upto(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 19)
        for k, b in ((0, _BASE), (1, _INVERSE)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def groups(sizes: list[int], limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of about `limit` bytes together; a longer text stands alone."""
    a = total = 0
    for i, n in enumerate(sizes):
        if i > a and total + n > limit:
            yield a, i
            a, total = i, 0
        total += n + 1
    if a < len(sizes):
        yield a, len(sizes)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (runs of non-blank bytes, A-Z lowered) and the index of the text it is in."""
    data = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
    blank = _SPACE[data]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    p, q = _upto(len(data) + 1)
    c = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * p[: len(data)], out=c[1:])
    h = mix((c[ends] - c[starts]) * q[starts] + (ends - starts).astype(np.uint64) * _ODD)
    edges = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return h, np.searchsorted(edges, starts, side="right") - 1


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of `k` words, by the position of its first word."""
    out = np.zeros(max(len(h) - k + 1, 0), np.uint64)
    for j in range(k):
        out = mix(out + h[j : j + len(out)] + _ODD)
    return out


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct k-word shingles of each text; with fewer words, the whole sequence as one."""
    h, of = word_hashes(texts)
    bounds = np.searchsorted(of, np.arange(len(texts) + 1))
    all_of = shingles(h, k)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(all_of[a : b - k + 1]))
        elif b > a:
            out.append(shingles(np.concatenate([h[a:b], np.array([b - a], np.uint64)]), int(b - a) + 1))
        else:
            out.append(np.empty(0, np.uint64))
    return out
