"""Guess cost of a password: the cheapest segmentation, by dynamic programming.

A value is cut into words of a common-password list, dates, repeats, keyboard
walks and brute-force spans; each segment has a number of guesses, further
segments cost a factor each, and the cheapest cut's product (as log10) is the
value's cost.  Every segment of every kind is an option: a repeat or walk may
begin and end anywhere within the longest one, and a repeat may have any period
up to half the value.

Words come from a ranked table (:class:`Words`): the common ones below, and
behind them those of a vocabulary file or any other list.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable

import numpy as np

#: Common passwords and words of passwords, most common first.
COMMON = (
    "password 123456 12345678 qwerty abc123 monkey letmein dragon 111111 baseball iloveyou trustno1 sunshine master "
    "welcome shadow ashley football jesus michael ninja mustang password1 admin login princess solo starwars hello "
    "freedom whatever secret token changeme default guest test testing example sample demo user root pass passwd "
    "summer winter spring autumn love angel batman superman killer hunter ranger buster soccer hockey george charlie "
    "andrew michelle jordan daniel jessica pepper cheese computer internet server system database account access "
    "private public company office money orange banana flower purple silver golden diamond chocolate coffee cookie "
    "matrix phoenix thunder tigger maggie ginger harley yankees cowboys lakers eagles steelers value string here "
    "your my the new old key api null none true false undefined placeholder insert enter xxxx redacted hidden"
).split()
#: Letters of the shortest word, and of the longest that is taken from a table.
SHORTEST, LONGEST = 3, 24

#: Rows of a QWERTY keyboard, the digits and the alphabet; neighbours in a row are one step apart.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz", "0123456789")
#: Look-alike letters.
LEET = {"4": "a", "@": "a", "8": "b", "3": "e", "1": "l", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"}

#: log10 of the factor for each further segment, of brute-force guesses per character, and of a walk's start.
SEGMENT = 1.0
DIGIT, LOWER, OTHER = math.log10(10), math.log10(26), math.log10(62)
WALK_START, TURN = math.log10(47), math.log10(4.6)
#: Values remembered, and the longest one that is.
MEMO, REMEMBERED = 50_000, 200
_DATES = (
    re.compile(r"(?:19|20)\d\d(?:[-/._]?)(?:0[1-9]|1[0-2])(?:[-/._]?)(?:0[1-9]|[12]\d|3[01])"),
    re.compile(r"(?:0[1-9]|[12]\d|3[01])(?:[-/._]?)(?:0[1-9]|1[0-2])(?:[-/._]?)(?:19|20)\d\d"),
    re.compile(r"(?:19|20)\d\d"),
)
_DATE_COST = (math.log10(365 * 100 * 4), math.log10(365 * 100 * 4), math.log10(100))


def _steps() -> dict[tuple[str, str], tuple[int, int]]:
    """(key, next key) -> direction, for keys side by side in a row or in adjacent keyboard rows."""
    steps: dict[tuple[str, str], tuple[int, int]] = {}
    for row in ROWS:
        for a, b in zip(row, row[1:]):
            steps.setdefault((a, b), (0, 1))
            steps.setdefault((b, a), (0, -1))
    for upper, lower in zip(ROWS[:3], ROWS[1:4]):
        upper = upper[1:] if upper[0] == "`" else upper
        for k, c in enumerate(lower):
            for side, d in enumerate(upper[k : k + 2]):
                steps.setdefault((c, d), (1, side))
                steps.setdefault((d, c), (-1, side))
    return steps


STEPS = _steps()


def _char_cost(c: str) -> float:
    return DIGIT if c.isdigit() else LOWER if c.islower() else OTHER


class Words:
    """Word -> rank, the common ones first; ``more`` follow in their order."""

    def __init__(self, more: Iterable[str] = ()):
        self.rank: dict[str, int] = {}
        for word in [*COMMON, *more]:
            self.rank.setdefault(word, len(self.rank) + 1)
        self.longest = max(map(len, self.rank))
        self.memo: dict[str, float] = {}

    def cost(self, part: str) -> float | None:
        low = part.lower()
        extra = 0.0 if part == low else math.log10(2) if part in (low.capitalize(), low.upper()) else math.log10(2 ** min(len(part), 10))
        if low in self.rank:
            return math.log10(self.rank[low] + 1) + extra
        plain = "".join(LEET.get(c, c) for c in low)
        return math.log10(self.rank[plain] + 1) + extra + math.log10(4) if plain in self.rank else None

    def __reduce__(self):  # what is remembered stays with the process
        return _words, (list(self.rank),)


def _words(ranked: list[str]) -> Words:
    return Words(ranked)


def vocabulary_words(path: str) -> list[str]:
    """The whole words of a byte-level BPE vocabulary (entries that begin with a blank), earliest entry first."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    entries = sorted(vocabulary.items(), key=lambda e: e[1])
    found = (t[1:].lower() for t, _ in entries if re.fullmatch(r"\u0120[A-Za-z]+", t))
    return list(dict.fromkeys(w for w in found if SHORTEST <= len(w) <= LONGEST))


def repeats(value: str) -> list[tuple[int, int, int]]:
    """(start, end, period) of the longest stretches that repeat their first ``period`` characters.

    Periods that are a repeat themselves are left out: the shorter one is
    cheaper in every part of the stretch.
    """
    n, found = len(value), []
    codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), np.uint32) if n > 64 else None
    for p in range(1, n // 2 + 1):
        if codes is not None:
            same = codes[p:] == codes[:-p]
            if int(np.count_nonzero(same)) < p:
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).view(np.int8)))
            long = edges[1::2] - edges[::2] >= max(p, 2)
            spans = list(zip(edges[::2][long].tolist(), edges[1::2][long].tolist()))
        else:
            spans, begin = [], None
            for k in range(n - p + 1):
                if k < n - p and value[k + p] == value[k]:
                    begin = k if begin is None else begin
                elif begin is not None:
                    spans.append((begin, k))
                    begin = None
        for start, stop in spans:
            unit = value[start : start + p]
            if stop - start >= max(p, 2) and (unit + unit).find(unit, 1) == p:
                found.append((start, stop + p, p))
    return found


def walks(value: str) -> tuple[list[tuple[int, int]], list[int]]:
    """(start, end) of the longest keyboard walks of three or more keys, and the turns up to each key."""
    low = value.lower()
    steps = [STEPS.get(pair) for pair in zip(low, low[1:])]
    turns, found, start = [0] * len(value), [], 0
    for k in range(1, len(value) + 1):
        step = steps[k - 1] if k < len(value) else None
        if k < len(value):
            turns[k] = turns[k - 1] + (k >= 2 and step is not None and steps[k - 2] is not None and step != steps[k - 2])
        if step is None:
            if k - start >= 3:
                found.append((start, k))
            start = k
    return found, turns


class _Starts:
    """Where a segment of growing length may best begin: ``price(length)`` is added to a start's entry.

    Prices grow with the logarithm of the length, so a start that is no worse
    than a later one at some place is no worse at any further place, and the
    later one may be forgotten; so may an earlier one whose entry is no lower.
    """

    def __init__(self, price):
        self.held: list[tuple[int, float]] = []
        self.price = price

    def add(self, start: int, entry: float) -> None:
        while self.held and self.held[-1][1] >= entry:
            self.held.pop()
        self.held.append((start, entry))

    def cheapest(self, end: int) -> float:
        best, kept = math.inf, []
        for start, entry in self.held:
            total = entry + self.price(end - start)
            if total < best:
                best = total
                kept.append((start, entry))
        self.held = kept
        return best


def _cheapest(value: str, words: Words) -> float:
    n = len(value)
    cost = [0.0]
    for c in value:
        cost.append(cost[-1] + _char_cost(c))
    dates: dict[int, list[tuple[int, float]]] = {}
    for pattern, price in zip(_DATES, _DATE_COST):
        for at in range(n):
            if value[at].isdigit() and (m := pattern.match(value, at)):
                dates.setdefault(m.end(), []).append((at, price))
    # (start, end, shortest segment, what a start adds, what an end adds, starts) of each stretch, by where its segments can first end.
    opening: dict[int, list] = {}
    for start, end, p in repeats(value):
        unit = cost[start + p] - cost[start]
        starts = _Starts(lambda size, p=p: math.log10(size / p + 1))
        opening.setdefault(start + max(2 * p, p + 2), []).append((start, end, max(2 * p, p + 2), lambda j, unit=unit: unit, lambda i: 0.0, starts))
    found, turns = walks(value)
    for start, end in found:
        # Turns between the steps of a part: from its second key's on.
        opening.setdefault(start + 3, []).append(
            (start, end, 3, lambda j: WALK_START - TURN * turns[j + 1], lambda i: TURN * turns[i - 1], _Starts(math.log10)))
    best, brute, open_now = [0.0] + [math.inf] * n, math.inf, []
    enter = lambda j: best[j] + (SEGMENT if j else 0.0)
    for i in range(1, n + 1):
        brute = min(brute, enter(i - 1)) + cost[i] - cost[i - 1]
        cheapest = brute
        for length in range(SHORTEST, min(words.longest, i) + 1):
            if (price := words.cost(value[i - length : i])) is not None:
                cheapest = min(cheapest, enter(i - length) + price)
        for at, price in dates.get(i, ()):
            cheapest = min(cheapest, enter(at) + price)
        open_now = [x for x in open_now if x[1] >= i] + opening.pop(i, [])
        for _, _, shortest, at_start, at_end, starts in open_now:
            j = i - shortest
            starts.add(j, enter(j) + at_start(j))
            cheapest = min(cheapest, starts.cheapest(i) + at_end(i))
        best[i] = cheapest
    return best[n]


def log10_guesses(value: str, words: Words) -> float:
    """log10 of the guesses for ``value``; 0 for the empty value."""
    if value in words.memo:
        return words.memo[value]
    cost = _cheapest(value, words)
    if len(value) <= REMEMBERED:
        if len(words.memo) >= MEMO:
            words.memo.clear()
        words.memo[value] = cost
    return cost
