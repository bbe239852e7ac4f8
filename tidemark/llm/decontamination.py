"""Benchmark decontamination on a positional inverted index (operator 12).

The corpus is indexed once (:mod:`tidemark.llm.postings`).  An item's windows
(``WINDOW`` consecutive words; a shorter item is one window) are looked up in
every block by intersecting offset-adjusted posting lists, from the rarest
term of the block on: the places of the rarest, moved by the distance to the
second rarest, must be among the latter's places, and so on.  Windows that
share their two rarest terms and the distance between them share that first
step.  With ``slop`` 0 a match is the exact phrase; with more it is a
neighbourhood: somewhere in one document there is room for the phrase such that
every term occurs at most ``slop`` places from where the phrase would have it.

Only the lists of the items' terms are read.  The items are taken in parts of
about ``PART_BYTES`` bytes of words, each broadcast on its own: every part
meets every block, however many items there are.

Defined results: a null or empty text has no words and no hits; an item without
words has no windows.  Equal windows of different items are looked up once and
count for each of them; repeated rows of an item count once.  An item without
id marks words as hit, but is not among the items that are counted and listed.
Repeated documents give equal rows.  Texts of any length are whole: a long
document is a block of its own, a long item is cut into overlapping pieces
that hold all its windows.  Empty tables give no rows, or rows without hits;
other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import materialise, text_of
from tidemark.llm.postings import GAP, build_index, documents_of, unpacked, words

WINDOW = 10
#: Places that a word may be off in the query's neighbourhood matches.
NEAR = 2
#: Windows of a piece of an item.
PIECE = 4096
#: Bytes of item words looked up at once, in expectation.
PART_BYTES = 1 << 24
#: Windows, and places of rarest terms, that are worked on at once.
WINDOWS_AT_ONCE, PLACES_AT_ONCE = 1 << 17, 1 << 21


def item_pieces(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, width (words of a window), words of the written pieces of the items' texts."""
    kind = items.schema["item_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = words(text)
                width = min(window, len(found))
                starts = range(0, len(found) - width + 1, PIECE) if found else ()
                pieces = [[w.decode() for w in found[k : k + PIECE + width - 1]] for k in starts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(pieces), batch.schema.field(0).type), pa.array([width] * len(pieces), pa.int32()), pa.array(pieces, pa.list_(pa.string()))],
                    names=["item_id", "width", "words"],
                )

    rows = items.select("item_id", text_of().cast("binary").alias("body"))
    made = rows.mapInArrow(cut, f"item_id {kind}, width int, words array<string>")
    return materialise(made.withColumn("piece", F.monotonically_increasing_id()), "item-pieces")


class Phrases:
    """The distinct windows of some pieces: terms, and per width the windows and the items of each."""

    def __init__(self, pieces: pa.Table):
        self.items = pieces.column("item_id").combine_chunks()
        texts = pieces.column("words").combine_chunks()
        flat = texts.flatten().dictionary_encode()
        self.terms = {t: k for k, t in enumerate(flat.dictionary.to_pylist())}
        codes = flat.indices.to_numpy().astype(np.int32)
        sizes = np.diff(texts.offsets.to_numpy())
        starts, widths = np.cumsum(sizes) - sizes, pieces.column("width").to_numpy()
        self.by_width = []
        for width in np.unique(widths):
            mine = np.flatnonzero(widths == width)
            places = [np.arange(starts[k], starts[k] + sizes[k] - width + 1) for k in mine]
            owner = np.repeat(mine, [len(p) for p in places])
            windows = codes[np.concatenate(places)[:, None] + np.arange(width)]
            distinct, which = np.unique(windows, axis=0, return_inverse=True)
            which = which.reshape(-1)
            order = np.argsort(which, kind="stable")
            bounds = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(distinct)))])
            self.by_width.append((distinct, bounds, owner[order].astype(np.int32)))


class Lists:
    """The posting lists of one block, for the terms of some phrases."""

    def __init__(self, terms: list[str], counts: np.ndarray, lists: pa.Array, numbers: dict[str, int]):
        lengths_at = terms.index("")
        self.lengths = unpacked(np.frombuffer(lists[lengths_at].as_buffer(), np.uint8))
        known = [(numbers[t], k) for k, t in enumerate(terms) if t in numbers]
        code, row = (np.array(x, np.int64) for x in zip(*sorted(known))) if known else (np.zeros(0, np.int64),) * 2
        raw = b"".join([lists[k].as_buffer() for k in row.tolist()])
        steps = unpacked(np.frombuffer(raw, np.uint8))
        n = counts[row]
        self.count = np.zeros(len(numbers), np.int64)
        self.first = np.zeros(len(numbers), np.int64)
        self.count[code], self.first[code] = n, np.cumsum(n) - n
        run = np.cumsum(steps)
        before = np.concatenate([[0], run])[np.cumsum(n) - n]
        self.places = run - np.repeat(before, n)
        #: Term and place in one number, ascending.
        self.keys = np.repeat(code, n) << 32 | self.places
        self.starts = np.cumsum(self.lengths + GAP) - self.lengths - GAP

    def near(self, term: np.ndarray, place: np.ndarray, slop: int) -> np.ndarray:
        """Does the term occur at most ``slop`` places from ``place``?"""
        if not len(self.keys):
            return np.zeros(len(term), bool)
        base = term.astype(np.int64) << 32
        at = np.searchsorted(self.keys, base | np.maximum(place - slop, 0))
        found = self.keys[np.minimum(at, len(self.keys) - 1)]
        return (at < len(self.keys)) & (found <= (base | np.maximum(place + slop, 0))) & (place + slop >= 0)

    def expanded(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``term``, place) of every posting of every term."""
        n = self.count[term]
        which = np.repeat(np.arange(len(term)), n)
        return which, self.places[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[term], n)]


def find_windows(lists: Lists, windows: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of a window, place where it starts) of all matches, some windows at a time."""
    width = windows.shape[1]
    for at in range(0, len(windows), WINDOWS_AT_ONCE):
        some = windows[at : at + WINDOWS_AT_ONCE]
        counts = lists.count[some]
        alive = np.flatnonzero(counts.min(axis=1) > 0)
        some, rarest = some[alive], np.argsort(counts[alive], axis=1, kind="stable")
        numbers = at + alive
        if not len(some):
            continue
        row = np.arange(len(some))
        first = some[row, rarest[:, 0]]
        if width == 1:
            second, distance = first, np.zeros(len(some), np.int64)
        else:
            second, distance = some[row, rarest[:, 1]], rarest[:, 1] - rarest[:, 0]
        # Windows that share their two rarest terms and the distance share the first step.
        steps, which = np.unique(np.stack([first, second, distance], axis=1), axis=0, return_inverse=True)
        by_step = np.argsort(which.reshape(-1), kind="stable")
        members = np.bincount(which.reshape(-1), minlength=len(steps))
        first_member = np.cumsum(members) - members
        load = np.cumsum(lists.count[steps[:, 0]])
        begin = 0
        while begin < len(steps):
            done = load[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(load, done + PLACES_AT_ONCE, "right")))
            step, place = lists.expanded(steps[begin:end, 0])
            step += begin
            if slop:  # the rarest term may be off its place, too
                off = np.arange(-slop, slop + 1)
                step, place = np.repeat(step, len(off)), (place[:, None] + off).ravel()
            held = lists.near(steps[step, 1], place + steps[step, 2], slop)
            step, place = step[held], place[held]
            n = members[step]
            window = by_step[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first_member[step], n)]
            start = np.repeat(place, n) - rarest[window, 0]
            for k in range(2, width):
                held = lists.near(some[window, rarest[window, k]], start + rarest[window, k], slop)
                window, start = window[held], start[held]
            if len(window):
                yield numbers[window], start
            begin = end


def block_matches(lists: Lists, phrases: Phrases, slop: int) -> tuple[np.ndarray, ...]:
    """(ordinal, piece, first word, last word) of the longest runs of words that windows of one piece cover in one document."""
    docs, owners, firsts, lasts = [], [], [], []
    for distinct, bounds, owner in phrases.by_width:
        width = distinct.shape[1]
        for window, start in find_windows(lists, distinct, slop):
            doc = np.searchsorted(lists.starts, start, "right") - 1
            word = start - lists.starts[doc]
            inside = (doc >= 0) & (word + width <= lists.lengths[doc])
            window, doc, word = window[inside], doc[inside], word[inside]
            n = bounds[window + 1] - bounds[window]
            docs.append(np.repeat(doc, n))
            owners.append(owner[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[window], n)])
            firsts.append(np.repeat(word, n))
            lasts.append(np.repeat(word + width - 1, n))
    if not docs:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    doc, owner, first, last = (np.concatenate(x) for x in (docs, owners, firsts, lasts))
    order = np.lexsort((first, owner, doc))
    doc, owner, first, last = doc[order], owner[order], first[order], last[order]
    # All windows of a piece have one width, so their ends ascend with their starts.
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1]) | (first[1:] > last[:-1] + 1)
    begin = np.flatnonzero(new)
    return doc[begin], owner[begin], first[begin], last[np.append(begin[1:], len(doc)) - 1]


def find_items(index: DataFrame, items: DataFrame, slop: int = 0, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """block, ordinal, item_id, first_word, last_word: runs of words of a document that an item's windows cover, written.

    ``slop`` is the distance that a term may be off its place in the phrase.
    """
    if not 0 <= slop < GAP // 2:
        raise ValueError(f"slop must be below {GAP // 2}")
    spark = index.sparkSession
    pieces = item_pieces(items, window)
    size = pieces.select(F.sum(F.length(F.array_join("words", " ")))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    kind = items.schema["item_id"].dataType.simpleString()
    schema = f"block bigint, ordinal int, item_id {kind}, first_word bigint, last_word bigint"
    found = []
    for part in range(parts):
        mine = pieces.filter(F.pmod(F.xxhash64("piece"), F.lit(parts)) == part).select("item_id", "width", "words")
        table = mine.toArrow()  # about part_bytes
        if not len(table):
            continue
        phrases = Phrases(table)
        shared = spark.sparkContext.broadcast(phrases)
        terms = spark.createDataFrame([(t,) for t in ["", *phrases.terms]], "term string")

        def match(group: pa.Table) -> pa.Table:
            own = shared.value
            lists = Lists(group.column("term").to_pylist(), group.column("n").to_numpy(), group.column("postings").combine_chunks(), own.terms)
            doc, owner, first, last = block_matches(lists, own, slop)
            block = group.column("block")[0].as_py()
            return pa.table({
                "block": pa.array(np.full(len(doc), block, np.int64)),
                "ordinal": pa.array(doc.astype(np.int32)),
                "item_id": own.items.take(pa.array(owner)),
                "first_word": pa.array(first.astype(np.int64)),
                "last_word": pa.array(last.astype(np.int64)),
            })

        lists = index.filter("term IS NOT NULL").join(F.broadcast(terms), "term", "left_semi").select("block", "term", "n", "postings")
        found.append(materialise(lists.groupBy("block").applyInArrow(match, schema), "item-matches"))
        shared.unpersist()
    if not found:
        return spark.createDataFrame([], schema)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def covered() -> Column:
    """Number of words that the sorted runs in ``runs`` cover together."""
    seen = F.struct(F.lit(-1).cast("bigint").alias("upto"), F.lit(0).cast("bigint").alias("total"))
    return F.aggregate(
        "runs",
        seen,
        lambda acc, run: F.struct(
            F.greatest(acc["upto"], run["last_word"]).alias("upto"),
            (acc["total"] + F.greatest(F.lit(0).cast("bigint"), run["last_word"] - F.greatest(acc["upto"], run["first_word"] - 1))).alias("total"),
        ),
        lambda acc: acc["total"],
    )


def listed() -> Column:
    return F.array_sort(F.collect_set(F.col("item_id").cast("string")))


def decontaminate(docs: DataFrame, items: DataFrame, slop: int = 0, window: int = WINDOW, near: int | None = None, index: DataFrame | None = None) -> DataFrame:
    """doc_id, n_words, n_hit, items (ids as strings, sorted) and runs (struct of first_word and last_word, sorted) of every document.

    With ``near``, also near_items: the items of which a window's words all lie
    at most ``near`` places from where the phrase would have them.
    """
    index = index if index is not None else build_index(docs)
    found = find_items(index, items, slop, window)
    runs = F.array_sort(F.collect_set(F.struct("first_word", "last_word")))
    hits = found.groupBy("block", "ordinal").agg(runs.alias("runs"), listed().alias("items"))
    hits = hits.select("block", "ordinal", "items", "runs", covered().alias("n_hit"))
    every = documents_of(index).join(hits, ["block", "ordinal"], "left")
    none = F.array().cast("array<string>")
    columns = ["doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce("items", none).alias("items"), "runs"]
    if near is not None:
        around = find_items(index, items, near, window).groupBy("block", "ordinal").agg(listed().alias("near_items"))
        every = every.join(around, ["block", "ordinal"], "left")
        columns.append(F.coalesce("near_items", none).alias("near_items"))
    return every.select(*columns)


ORACLE = r"""
WITH cut AS (SELECT 'd' AS kind, row_number() OVER () AS r, doc_id AS id,
                    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
             UNION ALL
             SELECT 'b', row_number() OVER (), item_id,
                    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
item_windows AS (SELECT DISTINCT id AS item_id, least(len(w), 10) AS width, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS phrase
                 FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM cut WHERE kind = 'b' AND len(w) > 0)),
widths AS (SELECT DISTINCT width FROM item_windows),
doc_windows AS (SELECT r, p, width, array_to_string(w[p : p + width - 1], ' ') AS phrase
                FROM (SELECT r, w, width, unnest(range(1, len(w) - width + 2)) AS p FROM cut, widths WHERE kind = 'd' AND len(w) >= width)),
found AS (SELECT r, p, width, item_id FROM doc_windows JOIN item_windows USING (width, phrase)),
hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(p, p + width)) AS place FROM found) GROUP BY r),
-- A neighbourhood: room for the phrase in the document such that each of its words is at most 2 places off.
item_words AS (SELECT DISTINCT item_id, width, phrase, string_split(phrase, ' ') AS w FROM item_windows),
item_terms AS (SELECT item_id, width, phrase, unnest(range(0, width)) AS k, unnest(w) AS term FROM item_words),
doc_terms AS (SELECT r, len(w) AS n, unnest(range(0, len(w))) AS place, unnest(w) AS term FROM cut WHERE kind = 'd'),
room AS (SELECT DISTINCT r, item_id, phrase, width, k, place - k + unnest(range(-2, 3)) AS start, n FROM doc_terms JOIN item_terms USING (term)),
near AS (SELECT DISTINCT r, item_id FROM (
             SELECT r, item_id, phrase, start, width FROM room WHERE start >= 0 AND start + width <= n
             GROUP BY r, item_id, phrase, start, width HAVING count(DISTINCT k) = width)),
nearby AS (SELECT r, count(DISTINCT item_id) AS n_near FROM near GROUP BY r),
listed AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
           FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM cut LEFT JOIN hit USING (r) LEFT JOIN listed USING (r) LEFT JOIN nearby USING (r) WHERE kind = 'd'
"""
