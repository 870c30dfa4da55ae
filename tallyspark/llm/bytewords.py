"""Vectorised word and shingle hashes of many texts at once (numpy, inside tasks).

A word is a maximal run of ASCII letters and digits and of bytes >= 0x80
(A-Z lower-cased); everything else separates words.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_LOWER = np.zeros(256, np.uint8)
for _b in range(256):
    if 48 <= _b <= 57 or 97 <= _b <= 122 or _b >= 128:
        _LOWER[_b] = _b
    elif 65 <= _b <= 90:
        _LOWER[_b] = _b + 32
BASE = 0x9E3779B97F4A7C15 | 1
SHINGLE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if "p" not in cache or len(cache["p"]) < n:
        m = max(n, 1 << 20)
        for k, b in (("p", BASE), ("q", pow(BASE, -1, 1 << 64))):
            f = np.full(m, b, np.uint64)
            f[0] = 1
            cache[k] = np.cumprod(f, dtype=np.uint64)
    return cache["p"], cache["q"]


def words(texts: list[bytes], cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words of each text), words in text order."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    raw = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)] if texts else np.zeros(0, np.uint8)
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    p, q = powers(n + 1, cache)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(raw * p[:n], out=total[1:])
    inside = np.zeros(n + 1, np.int8)
    inside[1:] = raw != 0
    edge = np.diff(inside)
    starts = np.flatnonzero(edge == 1)
    ends = np.flatnonzero(edge == -1)  # the last byte is a separator
    h = mix((total[ends] - total[starts]) * q[starts] + U(1))
    at = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))
    return h, np.diff(at)


def shingles(texts: list[bytes], cache: dict, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, number of shingles of each text) in text order, with repeats.

    A text of fewer than ``width`` words (but at least one) is one shingle of all its words.
    """
    h, counts = words(texts, cache)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    k = U(0xD6E8FEB86659FD93)
    n = len(h)
    if n == 0:
        return np.zeros(0, np.uint64), counts
    acc = h.copy()
    for j in range(1, width):
        nxt = np.zeros(n, np.uint64)
        nxt[: max(n - j, 0)] = h[j:]
        acc = acc * k + nxt
    left = np.repeat(first + counts, counts) - np.arange(n)  # words from here to the text's end
    take = left >= width
    out_n = np.maximum(counts - width + 1, 0)
    for d in np.flatnonzero((counts > 0) & (counts < width)):
        s, v = first[d], 0
        for x in h[s : s + counts[d]].tolist():
            v = (v * 0xD6E8FEB86659FD93 + x + 0x51) & 0xFFFFFFFFFFFFFFFF
        acc[s] = v
        take[s] = True
        out_n[d] = 1
    return mix(acc[take]), out_n


def bag(texts: list[bytes], cache: dict, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (text index, shingle, multiplicity), grouped by text index."""
    sh, n = shingles(texts, cache, width)
    doc = np.repeat(np.arange(len(texts)), n)
    order = np.argsort(mix(sh ^ mix(doc.astype(np.uint64) + U(77))), kind="stable")
    sh, doc = sh[order], doc[order]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.concatenate((at, [len(sh)])))
    sh, doc = sh[at], doc[at]
    by = np.argsort(doc, kind="stable")
    return doc[by], sh[by], weight[by]
