"""Removal of long repeated substrings (operator 1).

A byte goes if a 400-byte string that covers it also starts anywhere else, in
any text or in the same one.  Texts are UTF-8 bytes; matches never cross texts.

1. Each text's anchors (:mod:`tidemark.llm.anchors`) are counted over all
   texts, equal texts by their number.  Only windows whose anchor hash occurs
   at least twice can be repeated; these form pieces, cut where the content
   says so, so equal passages give equal pieces.
2. Equal pieces are taken together with their number: all windows of a piece
   that occurs twice are repeated.  Among the distinct pieces anchors are
   counted again, and the runs of windows whose anchors still occur twice, in
   pieces of which one at least has no copy, are the strings of the sort.
3. The difference-cover sort (:mod:`tidemark.llm.cover`) names these strings'
   windows and finds those with an equal neighbour.
4. Each text's repeated windows are put together; what they cover is removed.

Both counts pass over windows only where no equal window can exist, so the
result is exact (up to 128-bit hash collisions between different pieces).

Defined results: null text counts as empty; a text below 400 bytes keeps all.
Every row gives one row; of rows that repeat a text each loses its windows,
as they start in the others.  An empty table gives an empty result; other
columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.anchors import WINDOW, anchors, runs_of
from tidemark.llm.common import materialise, release, text_of
from tidemark.llm.cover import in_chunks, repeated

#: A piece ends after an anchor whose hash is divisible by this.
PIECE_ANCHORS = 16
#: Texts whose anchors leave a task in one batch.
ROWS = 256


def _hash(column: Column) -> tuple[Column, Column]:
    """128 bits of a binary column, as two numbers."""
    return F.xxhash64(column), F.xxhash64(F.lit(17), column)


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, body, d1, d2, key): ``key`` is a non-null form of doc_id."""
    body = text_of().cast("binary")
    key = F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.lit("n"))
    d1, d2 = _hash(body)
    return docs.select("doc_id", body.alias("body"), d1.alias("d1"), d2.alias("d2"), key.alias("key"))


def _lists(parts: list[np.ndarray], kind) -> pa.ListArray:
    cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat, kind))


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d1, d2, key, body) -> d1, d2, key, anchor hashes and first windows."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            found = [anchors(b.as_py()) for b in part.column(3)]
            lists = [_lists([h.view(np.int64) for h, _ in found], pa.int64()), _lists([s for _, s in found], pa.int32())]
            yield pa.RecordBatch.from_arrays([part.column(k) for k in range(3)] + lists, names=["d1", "d2", "key", "hashes", "starts"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d1, d2, copies, body, hashes, starts, chosen) -> one row for each piece of the text's chosen anchors."""
    for batch in batches:
        for at in range(batch.num_rows):
            d1, d2, copies, body, hashes, starts, chosen = (batch.column(k)[at] for k in range(7))
            body = body.as_py()
            h = hashes.values.to_numpy(zero_copy_only=False)
            first = np.append(starts.values.to_numpy(zero_copy_only=False), len(body) - WINDOW + 1)
            rows = []
            for a, b in runs_of(np.sort(chosen.values.to_numpy(zero_copy_only=False)), h % PIECE_ANCHORS == 0):
                lo, hi = int(first[a]), int(first[b])
                rows.append((d1.as_py(), d2.as_py(), copies.as_py(), lo, hi - lo, body[lo : hi + WINDOW - 1], h[a:b].tolist(), (first[a:b] - lo).tolist()))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["d1", "d2", "copies", "at", "windows", "piece", "hashes", "starts"]
                )


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(owner, piece, starts, chosen) -> the runs of chosen anchors: owner, offset in the piece, bytes."""
    for batch in batches:
        rows = []
        for at in range(batch.num_rows):
            owner, body, starts, chosen = (batch.column(k)[at] for k in range(4))
            body = body.as_py()
            first = np.append(starts.values.to_numpy(zero_copy_only=False), len(body) - WINDOW + 1)
            for a, b in runs_of(np.sort(chosen.values.to_numpy(zero_copy_only=False))):
                rows.append((owner.as_py(), int(first[a]), body[first[a] : first[b] + WINDOW - 1]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary()))], names=["piece", "at", "body"])


def cut_out(body: bytes, starts: list[int], ends: list[int]) -> tuple[int, int, str, list[tuple[int, int]]]:
    """(bytes removed, spans, SHA-256 of what is left, spans) for runs of windows [start, end]."""
    spans: list[list[int]] = []
    for a, b in sorted(zip(starts, ends)):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b + WINDOW)
        else:
            spans.append([a, b + WINDOW])
    left, kept = 0, hashlib.sha256()
    for a, b in spans:
        kept.update(body[left:a])
        left = b
    kept.update(body[left:])
    return sum(b - a for a, b in spans), len(spans), kept.hexdigest(), [(a, b) for a, b in spans]


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d1, d2, body, runs) -> d1, d2, n_removed, n_spans, kept_sha256, spans."""
    for batch in batches:
        rows = []
        for d1, d2, body, runs in zip(*(c.to_pylist() for c in batch.columns)):
            removed, n, sha, spans = cut_out(body, [r["s"] for r in runs], [r["e"] for r in runs])
            rows.append((d1, d2, removed, n, sha, ",".join(f"{a}:{b}" for a, b in spans)))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["d1", "d2", "n_removed", "n_spans", "kept_sha256", "spans"])


def _places(items: DataFrame, keys: list[str], often: DataFrame) -> DataFrame:
    """(keys, chosen): for each item the places of its hashes that are in ``often`` (h)."""
    each = items.select(*keys, F.posexplode("hashes").alias("place", "h"))
    return each.join(often, "h").groupBy(*keys).agg(F.collect_list("place").alias("chosen"))


def _counted(items: DataFrame) -> DataFrame:
    """(h, n, least): over all items, how many have the hash (with their copies, and without) and the fewest copies of one."""
    return items.select(F.explode("hashes").alias("h"), "copies").groupBy("h").agg(
        F.sum("copies").alias("n"), F.count("*").alias("items"), F.min("copies").alias("least")
    )


def remove_repeated(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (start:end of each removed run, in bytes) of every row."""
    rows = _rows(docs)
    long = rows.filter(F.octet_length("body") >= WINDOW)
    found = long.select("d1", "d2", "key", "body").mapInArrow(_anchored, "d1 bigint, d2 bigint, key string, hashes array<bigint>, starts array<int>")
    found = materialise(found, "substring-anchors")
    texts = found.groupBy("d1", "d2").agg(F.count("*").alias("copies"), F.min("key").alias("key"), F.first("hashes").alias("hashes"), F.first("starts").alias("starts"))
    texts = materialise(texts, "substring-texts")
    release(found)
    chosen = texts.join(_places(texts, ["d1", "d2"], _counted(texts).filter("n >= 2").select("h")), ["d1", "d2"])
    # One row of each text that has a repeated anchor: its row with the smallest key.
    bodies = long.select("d1", "d2", "key", "body").join(chosen, ["d1", "d2", "key"]).dropDuplicates(["d1", "d2", "key"])
    bodies = materialise(bodies.select("d1", "d2", "copies", "body", "hashes", "starts", "chosen"), "substring-bodies")
    release(texts)
    pieces = bodies.mapInArrow(
        _pieces, "d1 bigint, d2 bigint, copies bigint, at int, windows int, piece binary, hashes array<bigint>, starts array<int>"
    )
    p1, p2 = _hash(F.col("piece"))
    pieces = materialise(pieces.withColumns({"p1": p1, "p2": p2}), "substring-pieces")
    distinct = pieces.groupBy("p1", "p2").agg(
        F.sum("copies").alias("copies"), F.first("piece").alias("piece"), F.first("hashes").alias("hashes"), F.first("starts").alias("starts")
    )
    distinct = materialise(distinct.withColumn("owner", F.monotonically_increasing_id()), "substring-distinct")
    # From here on the occurrences go without their bytes, and the whole tables make room.
    occurrences = materialise(pieces.select("d1", "d2", "at", "windows", "p1", "p2"), "substring-occurrences")
    release(pieces)
    named = materialise(distinct.select("owner", "p1", "p2", F.col("copies").alias("n")), "substring-named")
    # A hash that only pieces with copies share says nothing new: all their windows are known.
    open_hashes = _counted(distinct).filter("items >= 2 AND least = 1").select("h")
    shared = distinct.select("owner", "piece", "starts").join(_places(distinct, ["owner"], open_hashes), "owner")
    strings = shared.select("owner", "piece", "starts", "chosen").mapInArrow(_strings, "piece bigint, at int, body binary")
    strings = materialise(strings.withColumn("owner", F.monotonically_increasing_id()), "substring-strings")
    release(distinct)
    where = materialise(strings.select("owner", "piece", "at"), "substring-where")
    chunks = in_chunks(strings.select("owner", "body"))
    release(strings)
    sorted_runs = repeated(chunks)
    runs = sorted_runs.join(where, "owner").select(
        "piece", F.explode(F.arrays_zip("starts", "ends")).alias("r"), "at"
    ).select("piece", F.struct((F.col("r.starts") + F.col("at")).alias("s"), (F.col("r.ends") + F.col("at")).alias("e")).alias("run"))
    runs = runs.groupBy("piece").agg(F.collect_list("run").alias("runs"))  # the runs of one piece
    known = named.join(runs, F.col("owner") == F.col("piece"), "left").drop("piece", "owner")
    placed = occurrences.join(known, ["p1", "p2"]).filter("n >= 2 OR runs IS NOT NULL")
    whole = F.array(F.struct(F.col("at").alias("s"), (F.col("at") + F.col("windows") - 1).alias("e")))
    shifted = F.transform("runs", lambda r: F.struct((r["s"] + F.col("at")).alias("s"), (r["e"] + F.col("at")).alias("e")))
    covered = placed.select("d1", "d2", F.when(F.col("n") >= 2, whole).otherwise(shifted).alias("runs"))
    covered = covered.groupBy("d1", "d2").agg(F.flatten(F.collect_list("runs")).alias("runs"))  # the runs of one text
    removed = bodies.select("d1", "d2", "body").join(covered, ["d1", "d2"]).mapInArrow(
        _removed, "d1 bigint, d2 bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans string"
    )
    removed = materialise(removed, "substring-removed")
    every = rows.select("doc_id", F.octet_length("body").cast("bigint").alias("n_bytes"), "d1", "d2", F.sha2("body", 256).alias("sha"))
    return every.join(removed, ["d1", "d2"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("bigint")).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
