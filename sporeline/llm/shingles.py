"""Word sequences of whole batches of texts as numpy arrays."""

from __future__ import annotations

import re

import numpy as np
import xxhash

_WORD = re.compile(r"[^\W_]+|\x00")
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordIds(dict):
    """63-bit hash of each word, kept for the words met so far (emptied when it grows past ``most``)."""

    def __init__(self, most: int = 2_000_000):
        super().__init__({"\x00": 0})
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) > self.most:
            self.clear()
            self["\x00"] = 0
        v = self[word] = (xxhash.xxh3_64_intdigest(word) >> 1) | 1
        return v


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x + _M1
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def word_ids(texts: list[str], ids: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words of the texts, lower-cased, one after another, and where each text begins and ends."""
    joined = "\x00".join(t.replace("\x00", " ") for t in texts).lower()
    words = _WORD.findall(joined + "\x00")
    flat = np.fromiter(map(ids.__getitem__, words), np.int64, len(words)).view(np.uint64)
    cut = np.flatnonzero(flat == 0)
    ends = cut - np.arange(len(cut))
    return np.delete(flat, cut), np.concatenate([[0], ends]).astype(np.int64)


def shingle_hashes(texts: list[str], k: int, ids: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word sequences of each text (repeats kept) and their bounds.

    A text with fewer than ``k`` words, but at least one, has one sequence: all its words.
    """
    flat, at = word_ids(texts, ids)
    n = np.diff(at)
    if not len(flat):
        return flat, np.zeros(len(texts) + 1, np.int64)
    h = mix(flat)
    whole = len(flat) - k + 1
    seq = np.zeros(max(0, whole), np.uint64)
    for j in range(k if whole > 0 else 0):
        seq = mix(seq) + h[j : j + whole] if j else h[:whole].copy()
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(bounds[-1], np.uint64)
    long = n >= k
    if long.any():
        take = np.repeat(at[:-1][long] - bounds[:-1][long], count[long])
        where = np.repeat(long, count)
        out[where] = seq[np.flatnonzero(where) + take]
    for i in np.flatnonzero((n > 0) & ~long):
        v = np.uint64(n[i])
        for x in h[at[i] : at[i + 1]]:
            v = (mix(np.array([v])) + x)[0]
        out[bounds[i]] = v
    return mix(out), bounds
