"""Word and shingle sets of whole texts, as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z lower-cased (UTF-8 bytes)."""
    return text.encode("utf-8").lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and odd multipliers)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def sequences(h: np.ndarray, k: int) -> np.ndarray:
    """One hash per window of ``k`` consecutive entries; all entries as one
    window if there are fewer."""
    k = min(k, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        out = mix(out + h[j:len(h) - k + 1 + j] + _ODD)
    return out


def word_shingles(text: str | None, k: int = 5) -> np.ndarray:
    """Distinct ``k``-word shingles; a shorter text is one shingle, no word: none."""
    w = words(text)
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    return np.unique(sequences(h, k))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
