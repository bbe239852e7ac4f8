"""Distributed positional inverted index of texts.

Documents are dealt to blocks of about ``BLOCK_WORDS`` words, whole texts
each.  A block's words have places: consecutive within a document, with
``GAP`` free places between documents, so that neither a phrase nor a
neighbourhood can reach into another document.  The index is one written table
with, per block,

* a row per term: its places, ascending (``postings``: gaps as variable-length
  bytes) and how many there are (``n``);
* a row for the empty term, which no word can be: the documents' lengths;
* a row per document without a term: ``ordinal`` within the block, ``doc_id``
  and its number of words.

A term that holds a third of all words has one bounded list per block, never
one long list.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import materialise, text_of

#: Words of a block, at least, unless the task's documents end (a longer document is a block of its own).
BLOCK_WORDS = 1 << 21
#: Free places between documents.
GAP = 64

#: Letters in lower case, digits and all beyond ASCII are kept, any other byte parts words.
WORD_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, size of each value): seven bits a byte, low ones first, the top bit set if more follow."""
    v = values.astype(np.uint64)
    sizes = np.ones(len(v), np.int64)
    for k in range(1, 10):
        more = v >= np.uint64(1) << np.uint64(7 * k)
        if not more.any():
            break
        sizes += more
    starts = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint8)
    for k in range(int(sizes.max(initial=0))):
        at = np.flatnonzero(sizes > k)
        part = (v[at] >> np.uint64(7 * k)) & np.uint64(127)
        out[starts[at] + k] = part | ((sizes[at] > k + 1).astype(np.uint64) << np.uint64(7))
    return out, sizes


def unpacked(raw: np.ndarray) -> np.ndarray:
    """The values of :func:`packed` bytes."""
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    sizes = ends - starts + 1
    out = (raw[starts] & 127).astype(np.int64) if len(ends) else np.zeros(0, np.int64)
    for k in range(1, int(sizes.max(initial=0))):
        at = np.flatnonzero(sizes > k)
        out[at] |= (raw[starts[at] + k] & 127).astype(np.int64) << (7 * k)
    return out


def binaries(raw: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """One binary value per size, cut from ``raw``."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))])


class Block:
    """The block that a task is filling."""

    def __init__(self):
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.held: list[np.ndarray] = []
        self.ids: list = []
        self.size = 0

    def add(self, doc_id, text: bytes) -> None:
        found = words(text)
        self.held.append(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)))
        self.ids.append(doc_id)
        self.size += len(found)

    def rows(self, block: int, id_type: pa.DataType) -> pa.RecordBatch:
        lengths = np.array([len(x) for x in self.held], np.int64)
        docs = len(lengths)
        places = np.arange(self.size) + np.repeat(np.arange(docs) * GAP, lengths)
        terms = sorted(self.numbers)
        rank = np.empty(len(terms), np.int32)
        rank[[self.numbers[t] for t in terms]] = np.arange(len(terms), dtype=np.int32)
        ranked = rank[np.concatenate(self.held)] if terms else np.zeros(0, np.int32)
        order = np.argsort(ranked, kind="stable")
        counts = np.bincount(ranked, minlength=len(terms)).astype(np.int64)
        firsts = np.cumsum(counts) - counts
        steps = np.diff(places[order], prepend=0)
        steps[firsts] = places[order[firsts]]
        raw, sizes = packed(np.concatenate([lengths, steps]))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        cuts = ends[np.concatenate([[0, docs], docs + np.cumsum(counts)])]
        n = len(terms) + 1
        none = pa.nulls(n, pa.int32())
        columns = [
            pa.array(np.full(n + docs, block, np.int64)),
            pa.concat_arrays([pa.array([b"", *terms], pa.binary()).cast(pa.string()), pa.nulls(docs, pa.string())]),
            pa.concat_arrays([none, pa.array(np.arange(docs, dtype=np.int32))]),
            pa.concat_arrays([pa.nulls(n, id_type), pa.array(self.ids, id_type)]),
            pa.array(np.concatenate([[docs], counts, lengths])),
            pa.concat_arrays([binaries(raw, np.diff(cuts)), pa.nulls(docs, pa.binary())]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["block", "term", "ordinal", "doc_id", "n", "postings"])


def build_index(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The written index of the texts of ``docs`` (columns doc_id, text; null text counts as empty).

    A block's number is made of the task's partition and a count within it, so
    a repeated task writes the same rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block, id_type = TaskContext.get().partitionId() << 32, Block(), None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(doc_id, text.as_buffer().to_pybytes())
                if block.size >= block_words:
                    yield block.rows(number, id_type)
                    number, block = number + 1, Block()
        if block.ids:
            yield block.rows(number, id_type)

    rows = docs.select("doc_id", text_of().cast("binary").alias("body"))
    schema = f"block bigint, term string, ordinal int, doc_id {kind}, n bigint, postings binary"
    return materialise(rows.mapInArrow(index, schema), "postings")


def documents_of(index: DataFrame) -> DataFrame:
    """block, ordinal, doc_id, n_words of every document."""
    return index.filter("term IS NULL").select("block", "ordinal", "doc_id", F.col("n").alias("n_words"))
