"""Weighted word-shingle sets of texts, in numpy blocks.

Words are the lower-cased text's runs without white space; a shingle is
``WORDS`` consecutive words, weighted by how often it occurs.  A text with
fewer words is one shingle of all its words; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
#: UTF-8 bytes handled at once; a longer text is a block of its own.
BLOCK = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK + 4096)
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


def blocks(texts: list[str | None]) -> Iterator[tuple[list[int], list[list[str]]]]:
    """(index of each text, its words) for about BLOCK bytes at a time."""
    index, held, size = [], [], 0
    for k, text in enumerate(texts):
        words = (text or "").lower().split()
        index.append(k)
        held.append(words)
        size += len(text or "")
        if size >= BLOCK:
            yield index, held
            index, held, size = [], [], 0
    if held:
        yield index, held


def word_hashes(joined: bytes) -> np.ndarray:
    """One hash per blank-separated word of ``joined`` (which holds at least one word)."""
    codes = np.frombuffer(joined, np.uint8)
    blank = codes == 32
    powers, inverse = _powers(len(codes) + 1)
    upto = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mixed(codes.astype(np.uint64) + np.uint64(1)) * powers[: len(codes)], out=upto[1:])
    ends = np.append(np.flatnonzero(blank), len(codes))
    starts = np.concatenate([[0], ends[:-1] + 1])
    return mixed((upto[ends] - upto[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def weighted(held: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, shingle, weight) of the distinct shingles of each word list, by owner and shingle."""
    counts = np.array([len(w) for w in held], np.int64)
    if not counts.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = word_hashes(" ".join(" ".join(w) for w in held if w).encode("utf-8", "replace"))
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    owner = np.repeat(np.arange(len(held)), counts)
    place = np.arange(len(words)) - starts[owner]
    full = np.flatnonzero(place + WORDS <= counts[owner])
    h = np.full(len(full), np.uint64(WORDS))
    for k in range(WORDS):
        h = h * np.uint64(_BASE) + words[full + k]
    owners, hashes = [owner[full]], [mixed(h)]
    for k in short:  # at most WORDS - 1 words each
        one = counts[k : k + 1].astype(np.uint64)
        for at in range(starts[k], starts[k] + counts[k]):
            one = one * np.uint64(_BASE) + words[at : at + 1]
        owners.append(np.array([k]))
        hashes.append(mixed(one))
    owner, h = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    return owner[at], h[at], np.diff(np.append(at, len(h)))


def occurrences(shingle: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The multiset as a sorted set: the k-th occurrence of a shingle is an element of its own."""
    each = np.repeat(shingle, weight)
    nth = np.arange(len(each)) - np.repeat(np.cumsum(weight) - weight, weight)
    return np.sort(np.where(nth == 0, each, mixed(each + nth.astype(np.uint64) * np.uint64(_BASE))))
