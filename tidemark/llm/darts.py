"""DartMinHash signatures of weighted sets.

Every element's weight axis is cut into the regions [0, 1), [1, 2), [2, 4), ...
Into each region a hash-seeded Poisson process throws darts: their ranks are
sums of exponential gaps whose rate is the region's width, each with a height
inside the region and one of ``K`` coordinates.  A dart below the element's
weight hits.  The earliest hit of each coordinate is a weighted min-hash: two
sets agree in a coordinate with probability sum(min) / sum(max) of their
weights.  About ``K ln K + 2 K`` darts per set suffice, however many elements
it has: ranks are looked at up to a limit that shrinks with the total weight,
and the limit is doubled for the few sets that still miss a coordinate.
"""

from __future__ import annotations

import math

import numpy as np

from tidemark.llm.shingles import mixed

K = 144
BANDS = 24
ROWS = K // BANDS
_GAP = np.uint64(0xD6E8FEB86659FD93)
_UNIT = 1.0 / (1 << 53)


def _unit(h: np.ndarray) -> np.ndarray:
    """(0, 1] from a hash."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1.0) * _UNIT


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """n x k dart identifiers; rows of owners without elements are 0.

    ``owner`` (0 .. n-1), ``element`` (uint64 hash) and ``weight`` (> 0) are parallel.
    """
    rank = np.full(n * k, np.inf)
    found = np.zeros(n * k, np.uint64)
    total = np.bincount(owner, weights=weight, minlength=n)
    wanted = np.flatnonzero(total > 0)
    # Regions: (element, level) with the region's floor below the weight.
    levels = np.where(weight <= 1, 1, 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64))
    which = np.repeat(np.arange(len(owner)), levels)
    level = np.arange(len(which)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1.0))
    width = np.where(level == 0, 1.0, low)
    seed = mixed(element[which] + level.astype(np.uint64) * _GAP)
    limit = np.zeros(n)
    limit[wanted] = (k * math.log(k) + 2 * k) / total[wanted]
    active = np.arange(len(which))
    while len(active):
        _throw(active, owner[which], seed, low, width, weight[which], limit, rank, found, k)
        missing = np.isinf(rank.reshape(n, k)).any(axis=1) & (total > 0)
        limit = np.where(missing, limit * 2, 0.0)
        active = active[missing[owner[which[active]]]]
    return found.reshape(n, k)


def _throw(active, owner, seed, low, width, weight, limit, rank, found, k) -> None:
    """Throw all darts below each owner's limit; keeps the earliest hit of each (owner, coordinate)."""
    at = np.zeros(len(active))
    nth = np.zeros(len(active), np.uint64)
    while len(active):
        expected = (limit[owner[active]] - at) * width[active]
        many = expected >= 8
        rest = []
        for group, block in ((~many, 1), (many, 64)):
            if not group.any():
                continue
            mine, start, base = active[group], at[group], nth[group]
            steps = base[:, None] + np.arange(1, block + 1, dtype=np.uint64)[None, :]
            h = mixed(seed[mine][:, None] + steps * _GAP)
            ranks = start[:, None] + np.cumsum(-np.log(_unit(h)) / width[mine][:, None], axis=1)
            below = ranks < limit[owner[mine]][:, None]
            row, col = np.nonzero(below)
            darts, r, reg = h[row, col], ranks[row, col], mine[row]
            more = mixed(darts + np.uint64(1))
            height = low[reg] + width[reg] * (1.0 - _unit(more))
            hit = height < weight[reg]
            cell = owner[reg[hit]] * k + (mixed(more[hit]) % np.uint64(k)).astype(np.int64)
            r, darts = r[hit], darts[hit]
            np.minimum.at(rank, cell, r)
            best = rank[cell] == r
            found[cell[best]] = mixed(darts[best] ^ seed[reg[hit][best]])
            on = below[:, -1]
            rest.append((mine[on], ranks[on, -1], base[on] + np.uint64(block)))
        active, at, nth = (np.concatenate(x) for x in zip(*rest)) if rest else (active[:0], at[:0], nth[:0])


def bands(signature: np.ndarray, b: int = BANDS) -> np.ndarray:
    """n x b band keys; the band's number is part of the key."""
    n, k = signature.shape
    parts = signature.reshape(n, b, k // b)
    key = np.broadcast_to(np.arange(1, b + 1, dtype=np.uint64), (n, b)).copy()
    for j in range(k // b):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key
