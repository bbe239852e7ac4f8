"""Secret scan with password guess costs (operator 2).

Three base patterns find assignments, access keys and hexadecimal strings.
Beyond them, values in a credential context - after a credential word and a
separator, after a bearer scheme, between user name and host of an address -
are judged by the guess cost of their cheapest segmentation
(:mod:`tidemark.llm.guesses`): a value that needs at least
``10 ** MIN_COST`` guesses is a secret (kind ``guess``), a cheaper one is a
placeholder or an ordinary word.  Words are ranked by a vocabulary file (a
parameter) or by any other list; the table is broadcast, bounded by ``MAX_WORDS``.
A bare value that reads as code - a path of names, or a name in front of a
bracket - is no value.  Base spans always stay.

Spans are code-point offsets, end exclusive; they are ordered by start, then
kind as listed in ``KINDS``.

Defined results: null text counts as empty, whose span lists are empty; texts
of any length are read whole; every row gives one row, repeated ones too.  An empty table gives an empty result;
other columns take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import text_of
from tidemark.llm.guesses import Words, log10_guesses, vocabulary_words

KINDS = ("assign", "access", "hex", "guess")
MIN_COST = 8.0
#: Shortest value that is judged.
MIN_VALUE = 6
#: A public vocabulary whose words are ranked, and the most words of a table.
WORDS_PATH, MAX_WORDS = "/opt/tokenizers/byte_bpe_50k.json", 200_000
#: A path of names, as code has it.
NAMES = re.compile(r"[A-Za-z_][A-Za-z_]*(?:(?:\.|::|->)[A-Za-z_]+)+")

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16

#: Credential contexts; the last group that took part is the value: one in quotes up to the closing quote on its line, else a bare one.
CONTEXTS = (
    re.compile(
        r"""(?:passwords?|passwd|passphrase|passcode|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth[_-]?key)"""
        r"""["']?[\x20\t]*(?:=>|:=|[:=])[\x20\t]*(?:"([^"\\\r\n]*(?:\\.[^"\\\r\n]*)*)"|'([^'\\\r\n]*(?:\\.[^'\\\r\n]*)*)'|["']?([^\s"'<>,;()\[\]{}]+))""",
        re.I | re.A,
    ),
    re.compile(r"\bbearer[\x20\t]+([A-Za-z0-9+/_.=~-]+)", re.I | re.A),
    re.compile(r"(?<![a-z0-9+.-])[0-9+.-]*[a-z][a-z0-9+.-]*://[^\s/:@]*:([^\s/@]+)@", re.I | re.A),
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' matches."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def guess_spans(text: str, words: Words, min_cost: float = MIN_COST) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, log10 guesses) of the credential-context values that are hard to guess."""
    found = {}
    patterns = [p for p, need in zip(CONTEXTS, (":=", " \t", "@")) if any(c in text for c in need)]
    for pattern in patterns:
        m = pattern.search(text)
        while m:
            at = m.start(m.lastindex)
            quoted = m.lastindex < pattern.groups
            value = m[m.lastindex] if quoted else m[m.lastindex].rstrip(".:!?")
            code = not quoted and pattern is CONTEXTS[0] and (text[m.end() : m.end() + 1] in ("(", "[") or NAMES.fullmatch(value))
            if len(value) >= MIN_VALUE and not code and (cost := log10_guesses(value, words)) >= min_cost:
                found[at, at + len(value)] = cost
            # A quoted value can hold contexts of its own.
            m = pattern.search(text, at if quoted else m.end())
    return sorted((a, 3, b, cost) for (a, b), cost in found.items())


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_texts(batches: Iterator[pa.RecordBatch], words: Words, min_cost: float = MIN_COST) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            base = base_spans(text)
            more = guess_spans(text, words, min_cost)
            every = sorted(base + [s[:3] for s in more])
            rows.append((*(sum(s[1] == k for s in every) for k in range(4)), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), max((s[3] for s in more), default=0.0)))
        columns = list(zip(*rows)) if rows else [()] * 7
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, kinds)],
            names=["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans", "hardest"],
        )


def scan_secrets(docs: DataFrame, min_cost: float = MIN_COST, words: list[str] | None = None, words_path: str = WORDS_PATH) -> DataFrame:
    """``words`` (most common first) take the place of those of ``words_path``.

    doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess and hardest (log10 guesses of the hardest value)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_guess bigint, base_sha256 string, spans string, hardest double"
    words = vocabulary_words(words_path) if words is None else words
    if len(words) > MAX_WORDS:
        raise ValueError(f"more than {MAX_WORDS} words")
    shared = docs.sparkSession.sparkContext.broadcast(Words(words))
    found = docs.select("doc_id", text_of().alias("text")).mapInArrow(lambda batches: scan_texts(batches, shared.value, min_cost), schema)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "hardest")
