"""Word shingles as 64-bit fingerprints, in numpy.

Words are runs of characters other than ASCII white space, A-Z lower-cased.  A word
is hashed once per worker (the table is bounded), a shingle mixes its words' hashes.
"""

from __future__ import annotations

import numpy as np
import xxhash

SIZE = 5
WORD_TABLE = 250_000

_ODD = np.random.default_rng(20240611).integers(1 << 62, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordTable(dict):
    """Hash of each word; emptied when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_TABLE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


WORDS = WordTable()


def forget_words() -> None:
    WORDS.clear()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(text: str | None, fold: bool = True) -> list[bytes]:
    """Words of a text; bytes.split() parts at 0x20 and 0x09-0x0D only, bytes.lower() changes A-Z only."""
    raw = (text or "").encode()
    return (raw.lower() if fold else raw).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))


#: The first bytes of eight, by how many.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
LONG_WORD = 64


def hashed_words(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of a text, as ``bytes.split()`` parts it: a 64-bit hash of each, and where it begins and ends.

    Words are hashed side by side, eight bytes a step; the hash is another than that of ``word_hashes``.
    """
    text = np.frombuffer(raw, np.uint8)
    gap = ((text == 0x20) | (text - np.uint8(9) < 5)).view(np.int8)
    edge = np.diff(gap, prepend=np.int8(1), append=np.int8(1))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    size = end - begin
    eight = np.ndarray(len(raw), "<u8", raw + bytes(8), strides=(1,))  # the eight bytes from each place on
    h = mix((eight[begin] & _FIRST[np.minimum(size, 8)]) + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    at, k = np.flatnonzero(size > 8), 8
    while len(at) and k < LONG_WORD:
        h[at] = mix(h[at] * np.uint64(0xD6E8FEB86659FD93) + (eight[begin[at] + k] & _FIRST[np.minimum(size[at] - k, 8)]))
        k += 8
        at = at[size[at] > k]
    for i in at.tolist():
        h[i] = xxhash.xxh64_intdigest(raw[begin[i] : end[i]])
    return h, begin, end


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A fingerprint for each run of ``size`` words, in order."""
    n = len(hashes) - size + 1
    total = np.zeros(max(n, 0), np.uint64)
    for j in range(size if n > 0 else 0):
        total += hashes[j : j + n] * _ODD[j]
    return mix(total + np.uint64(size))


def shingle_set(text: str | None, size: int = SIZE) -> np.ndarray:
    """Sorted distinct shingles; a text of fewer words is one shingle, one of none has none."""
    h = word_hashes(split_words(text))
    if not len(h):
        return h
    return np.unique(windows(h, min(size, len(h))))
