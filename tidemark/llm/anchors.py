"""Content-defined anchors of byte strings.

Every window of ``WINDOW`` bytes has one anchor: the smallest hash among its
``GRAM``-byte substrings (the leftmost on a tie).  Equal windows have equal
anchors at equal places, so a window whose anchor hash occurs once in all
texts is not repeated.  Consecutive windows mostly share their anchor; there
is about one anchor per hundred bytes.
"""

from __future__ import annotations

import numpy as np

WINDOW = 400
GRAM = 200
#: Windows handled at once.
CHUNK = 1 << 19
_INDEX_BITS = np.uint64(20)
_INDEX = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15
_TABLES: list[np.ndarray] = []


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _tables() -> list[np.ndarray]:
    """Hash of each byte value; powers of the base and of its inverse."""
    if not _TABLES:
        size = CHUNK + WINDOW + 1
        made = [mixed(np.arange(1, 257, dtype=np.uint64))]
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        _TABLES[:] = made
    return _TABLES


def gram_hashes(codes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` bytes at each place of at most CHUNK + WINDOW bytes."""
    byte, power, inverse = _tables()
    upto = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(byte[codes] * power[: len(codes)], out=upto[1:])
    return mixed((upto[gram:] - upto[:-gram]) * inverse[: len(codes) - gram + 1])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values (prefix and suffix minima of blocks)."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    block = padded.reshape(-1, width)
    prefix = np.minimum.accumulate(block, axis=1).ravel()
    suffix = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[: n - width + 1], prefix[width - 1 : n])


def anchors(body: bytes, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first window) of each anchor, in order; an anchor's windows end before the next one's first."""
    codes = np.frombuffer(body, np.uint8)
    hashes, starts, last = [], [], -1
    for at in range(0, len(codes) - window + 1, CHUNK):
        part = codes[at : at + CHUNK + window - 1]
        h = gram_hashes(part, gram)
        low = window_minima((h & ~_INDEX) | np.arange(len(h), dtype=np.uint64), window - gram + 1)
        place = (low & _INDEX).astype(np.int64)
        new = np.flatnonzero(place[1:] != place[:-1]) + 1
        first = np.concatenate([[0], new]) if place[0] + at != last else new
        hashes.append(h[place[first]])
        starts.append(first + at)
        last = place[-1] + at
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def runs_of(chosen: np.ndarray, cut: np.ndarray | None = None) -> list[tuple[int, int]]:
    """(first, last + 1) of the runs of consecutive indices in sorted ``chosen``; ``cut[i]`` ends a run after index i."""
    if not len(chosen):
        return []
    breaks = np.diff(chosen) != 1
    if cut is not None:
        breaks |= cut[chosen[:-1]]
    at = np.flatnonzero(breaks) + 1
    first = np.concatenate([[0], at])
    last = np.append(at, len(chosen)) - 1
    return list(zip(chosen[first].tolist(), (chosen[last] + 1).tolist()))
