"""Hashes of words and word n-grams, and local sampling of positions."""

from __future__ import annotations

import numpy as np


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(29))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, as UTF-8; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def gram_hashes(words: list[bytes], k: int) -> np.ndarray:
    """64-bit hash of the k words from each position on; of fewer words, the
    one gram that they form; of none, nothing."""
    from xxhash import xxh3_64_intdigest

    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    width = min(k, n)
    s = np.zeros(n - width + 1, dtype=np.uint64)
    for j in range(width):
        s = mix(s + h[j:n - width + 1 + j])
    return s


def sliding(v: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) over each window of ``width`` values."""
    done, out = 1, v
    while done * 2 <= width:
        out = op(out[:len(out) - done], out[done:])
        done *= 2
    rest = width - done
    return op(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(f: np.ndarray, width: int) -> np.ndarray:
    """Positions whose value is lowest in one of the windows of ``width``
    positions around them; none if there is no whole window.  Equal stretches
    have equal anchors."""
    if len(f) < width:
        return np.empty(0, dtype=np.int64)
    low = sliding(f, width, np.minimum)
    pad = np.zeros(width - 1, dtype=np.uint64)
    return np.flatnonzero(sliding(np.concatenate([pad, low, pad]), width, np.maximum) == f)
