"""Fill-in-middle transformation of texts, a pyarrow.compute pipeline (operator 13).

A text is cut into units (a run of ASCII letters, or one other code point).
Per batch, all units lie in one flat array beside the index of their text
(parent) and their ordinal within it; the ordinal against a text's two cuts
gives each unit its role (prefix, middle, suffix).  Filtering the flat array
by role and rebuilding lists from the counts that stay gives three list arrays
whose elements are joined to the pieces, and the pieces are joined in the order
of the text's form around the marks.

The cuts and the form come from a hash of seed and ``doc_id`` (Spark SQL
functions), so they do not change with partitioning or retries.

``plain`` rows keep their text: empty texts, texts that contain a mark, and the
share of rows that the rates leave out.  ``psm`` is prefix mark, prefix, suffix
mark, suffix, middle mark, middle; ``spm`` begins with the suffix.
:func:`restore` rebuilds the text from output and form alone.

Defined results: a null text counts as empty and is plain; a null ``doc_id``
hashes like an empty string.  Texts of any length are whole: a batch is worked
on in runs of about ``CHUNK`` bytes, a longer text in a run of its own.  Rows
that repeat ``doc_id`` and text give equal results; there are no ties.  An
empty table gives an empty result; other columns take no part.  Bytes that are
no UTF-8 stay with the unit before them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import text_of

#: Bytes of text worked on at once.
CHUNK = 1 << 21
#: Cannot occur in UTF-8, so it may stand between units.
GAP = b"\xff"
#: A unit in front of which a gap is put: a run of letters, another ASCII byte, or the bytes of one other code point.
UNIT = rb"([A-Za-z]+|[\x00-\x40\x5b-\x60\x7b-\x7f]|[\xc0-\xfe][\x80-\xbf]*)"


@dataclass(frozen=True)
class Marks:
    """The three marks; no mark may overlap itself or another, so an output can be cut at them again."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        every = (self.prefix, self.suffix, self.middle)
        for k, a in enumerate(every):
            for j, b in enumerate(every):
                shared = any(a.endswith(b[:size]) for size in range(1, len(b)))
                if not a or shared or (k != j and a in b):
                    raise ValueError("marks must be distinct, not empty and must not overlap")

    @property
    def encoded(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


def hash_group(k: int, seed: str) -> Column:
    """The k-th group of 8 hexadecimal digits of the digest of seed and doc_id, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("bigint")


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(all units, index of each one's text, its ordinal).

    The gap in front of a text's first unit leaves an empty element of
    ordinal 0, so a text's units count from 1 and a text without units has one
    (empty) element.
    """
    lists = pc.split_pattern(pc.replace_substring_regex(texts, UNIT, GAP + rb"\1"), GAP)
    parents = pc.list_parent_indices(lists).to_numpy()
    starts = lists.offsets.to_numpy()[:-1]
    return pc.list_flatten(lists), parents, np.arange(len(parents)) - (starts[parents] - starts[0] if len(starts) else 0)


def joined(flat: pa.Array, parents: np.ndarray, chosen: np.ndarray, rows: int) -> pa.Array:
    """The chosen units of each text, joined."""
    counts = np.bincount(parents[chosen], minlength=rows)
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, flat.filter(pa.array(chosen))), b"")


def together(*parts) -> pa.Array:
    return pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.binary()))


def code_points(pieces: pa.Array) -> pa.Array:
    return pc.utf8_length(pieces.cast(pa.string(), safe=False)).cast(pa.int64())


def transformed(texts: pa.Array, h1: np.ndarray, h2: np.ndarray, spm: np.ndarray, wanted: np.ndarray, marks: Marks) -> dict[str, pa.Array]:
    """Columns n, form, prefix_chars, middle_chars, output of a run of texts."""
    rows = len(texts)
    flat, parents, ordinal = units(texts)
    n = np.bincount(parents, minlength=rows) - 1
    first, second = h1 % (n + 1), h2 % (n + 1)
    low, high = np.minimum(first, second)[parents], np.maximum(first, second)[parents]
    prefix = joined(flat, parents, ordinal <= low, rows)
    middle = joined(flat, parents, (ordinal > low) & (ordinal <= high), rows)
    suffix = joined(flat, parents, ordinal > high, rows)
    p, s, m = (pa.scalar(x, pa.binary()) for x in marks.encoded)
    marked = np.zeros(rows, bool)
    for mark in marks.encoded:
        marked |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
    cut = pa.array(wanted & ~marked & (n > 0))
    spm = pa.array(spm)
    tail = together(m, middle)
    output = pc.if_else(spm, together(s, suffix, p, prefix, tail), together(p, prefix, s, suffix, tail))
    none = pa.scalar(None, pa.int64())
    return {
        "n": pa.array(n.astype(np.int64)),
        "form": pc.if_else(cut, pc.if_else(spm, "spm", "psm"), "plain"),
        "prefix_chars": pc.if_else(cut, code_points(prefix), none),
        "middle_chars": pc.if_else(cut, code_points(middle), none),
        "output": pc.if_else(cut, output, texts),
    }


def runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of runs of about CHUNK bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if held and held + size > CHUNK:
            yield start, k - start
            start, held = k, 0
        held += size
    if len(sizes) > start:
        yield start, len(sizes) - start


def fill_in_middle(docs: DataFrame, marks: Marks = Marks(), seed: str = "1", cut_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points; null if plain) and output (binary) of every row's text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(
        "doc_id",
        text_of().cast("binary").alias("body"),
        hash_group(1, seed).alias("h1"),
        hash_group(2, seed).alias("h2"),
        (hash_group(4, seed) % 100 < spm_percent).alias("spm"),
        (hash_group(3, seed) % 100 < cut_percent).alias("wanted"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, count in runs(batch.column(1)):
                ids, texts, *how = [c for c in batch.slice(start, count).columns]
                done = transformed(texts, *[x.to_numpy(zero_copy_only=False) for x in how], marks)
                yield pa.RecordBatch.from_arrays([ids, *done.values()], names=["doc_id", *done])

    return rows.mapInArrow(cut, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary")


def _halves(pieces: pa.Array, mark: bytes) -> tuple[pa.Array, pa.Array]:
    """What stands before and after the first mark."""
    parts = pc.split_pattern(pieces, mark, max_splits=1)
    return pc.list_element(parts, 0), pc.list_element(parts, 1)


def restored(output: pa.Array, form: pa.Array, marks: Marks) -> pa.Array:
    """The texts from which outputs of these forms were made."""
    p, s, m = marks.encoded
    done, places = [], []
    for name, first, second in (("psm", p, s), ("spm", s, p)):
        at = np.flatnonzero(pc.equal(form, name).to_numpy(zero_copy_only=False))
        if not len(at):
            continue
        _, rest = _halves(output.take(pa.array(at)), first)
        one, rest = _halves(rest, second)
        two, middle = _halves(rest, m)
        done.append(together(one, middle, two) if name == "psm" else together(two, middle, one))
        places.append(at)
    plain = np.flatnonzero(pc.equal(form, "plain").to_numpy(zero_copy_only=False))
    back = np.argsort(np.concatenate([*places, plain]))
    return pa.concat_arrays([*done, output.take(pa.array(plain))]).take(pa.array(back))


def restore(made: DataFrame, marks: Marks = Marks()) -> DataFrame:
    """The rows of :func:`fill_in_middle` with a column ``restored`` (binary), rebuilt from ``output`` and ``form`` alone."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema.fields)
    names = [*made.columns, "restored"]
    output, form = made.columns.index("output"), made.columns.index("form")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, count in runs(batch.column(output)):
                part = batch.slice(start, count)
                yield pa.RecordBatch.from_arrays([*part.columns, restored(part.column(output), part.column(form), marks)], names=names)

    return made.mapInArrow(rebuild, f"{fields}, restored binary")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM k),
f AS (SELECT doc_id, body, CAST(n AS BIGINT) AS n, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s,
             CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM f
"""
