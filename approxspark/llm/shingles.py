"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

#: Words whose hashes a task remembers, at about 130 bytes each; beyond that the table is emptied.
TABLE = 500_000
_M1, _M2, _P = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _Hashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's runs of ``width`` words (a shorter text: all its words as one).

    A-Z count as lower case; words are [^\\x20\\x09-\\x0D]+; without words the set is empty.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_hashes) > TABLE:
        _hashes.clear()
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    k = min(width, len(h))
    s = h[:n] + np.uint64(k)
    for i in range(1, k):
        s = s * _P + h[i : i + n]
    return np.unique(mixed(s))


def forget() -> None:
    """Empty the table of words: a task is done, and its worker may go on to another stage."""
    _hashes.clear()


class Sets:
    """Shingle sets of nodes, a bounded number of shingles at a time."""

    def __init__(self, width: int, bound: int = 1_000_000) -> None:
        self.width, self.bound, self.held = width, bound, 0
        self.known: dict[int, np.ndarray] = {}

    def of(self, node: int, text: str) -> np.ndarray:
        """The set of ``text``; an empty one if it isn't the node's (another row's text under the same id)."""
        if node not in self.known:
            s = shingle_set(text, self.width)
            if set_id(s) != node:
                return s[:0]
            if self.held + len(s) > self.bound:
                self.known.clear()
                self.held = 0
            self.known[node] = s
            self.held += len(s)
        return self.known[node]


def set_id(s: np.ndarray) -> int | None:
    """64 bits of a cryptographic digest of the whole set, as a signed long; None for an empty set."""
    return int.from_bytes(hashlib.blake2b(s.astype("<u8").tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None
