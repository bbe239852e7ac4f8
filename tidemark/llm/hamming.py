"""Exact k nearest binary codes by incremental multi-index hashing (operator 7).

A vector's code has one bit per element, set where the element is positive.
Codes are cut into ``m`` segments and every distinct code is indexed under each
segment's value.  In round ``s`` each open query probes, in every segment, all
values that differ from its own in exactly ``s`` bits, and the codes found are
verified by their full Hamming distance.  By the pigeonhole principle a code at
distance below ``m * (s + 1)`` has been met after round ``s``; a query is
closed as soon as its k-th distance is below that, so its answer is exact.

Equal codes are searched and indexed once: a code carries its ``k + 1``
smallest ids (no more can matter), and queries with equal codes share one
search.  A vector that a third of all rows repeat costs one entry.

Defined results: neighbours are ordered by distance, then id; a row is never
its own neighbour (rows with the query's id are left out); a null vector, a
null id or a vector without elements is in no result; missing and null elements
and NaN give a 0 bit; a vector with more elements than a code has bits is an error.  A table with fewer than k others gives what there is.
Repeated rows count once.  Other columns take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import materialise, release

K = 10
BITS = 64
#: Probes made per output batch.
PROBES = 1 << 18


def code_of(column: str = "embedding", bits: int = BITS) -> Column:
    """The sign bits of the elements; a vector of more than ``bits`` elements (64 at most) is an error, never cut."""
    if not 1 <= bits <= 64:
        raise ValueError("bits must be between 1 and 64")
    one = lambda i: F.when(F.coalesce(F.get(column, i) > 0, F.lit(False)) & ~F.isnan(F.get(column, i)), F.expr("1L")).otherwise(F.expr("0L"))
    value = F.lit(0).cast("bigint")
    for i in range(bits):
        value = value.bitwiseOR(F.shiftleft(one(i), i))
    said = F.concat(F.lit(f"a vector has more than {bits} elements: "), F.size(column).cast("string"))
    return F.when(F.size(column) > bits, F.raise_error(said).cast("bigint")).otherwise(value)


def segments(bits: int, count: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment; widths differ by one at most."""
    cuts = [bits * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def segment_count(bits: int, codes: int) -> int:
    """Segments about as wide as the number of codes has bits, so that a value has about one code."""
    return max(2, min(8, round(bits / max(math.log2(max(codes, 2)), 1.0))))


def _masks(width: int, radius: int) -> np.ndarray:
    if radius > width:
        return np.zeros(0, np.int64)
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.int64)


def _probes(open_codes: DataFrame, parts: list[tuple[int, int]], radius: int) -> DataFrame:
    """(query, segment, value): every segment value at exactly ``radius`` bits from a query's."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [_masks(width, radius) for _, width in parts]
        for batch in batches:
            codes = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for seg, (low, width) in enumerate(parts):
                own = (codes.view(np.uint64) >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64)
                for masked in np.array_split(masks[seg], max(1, -(-len(masks[seg]) // PROBES))):
                    step = max(1, PROBES // max(len(masked), 1))
                    for at in range(0, len(codes), step):
                        value = (own[at : at + step, None] ^ masked[None, :]).ravel()
                        if len(value):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.repeat(codes[at : at + step], len(masked))), pa.array(np.full(len(value), seg, np.int32)), pa.array(value)],
                                names=["query", "segment", "value"],
                            )

    return open_codes.select("query").mapInArrow(probe, "query bigint, segment int, value bigint")


def nearest_codes(codes: DataFrame, queries: DataFrame, k: int, bits: int = BITS) -> DataFrame:
    """(query, id, distance): for each query code the ``k`` nearest ids of ``codes`` (code, ids) by distance, then id."""
    total = codes.agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids")).first()
    count = segment_count(bits, total["n"])
    parts = segments(bits, count)
    value = [F.struct(F.lit(j).alias("segment"), F.shiftrightunsigned("code", low).bitwiseAND(F.lit((1 << width) - 1).cast("bigint")).alias("value")) for j, (low, width) in enumerate(parts)]
    index = materialise(codes.select("code", F.explode(F.array(*value)).alias("s")).select("s.segment", "s.value", "code"), "hamming-index")
    waiting = materialise(queries.select("query").distinct(), "hamming-open")
    best = None
    nearest = Window.partitionBy("query").orderBy("distance", "id")
    done = []
    for radius in range(max(width for _, width in parts) + 1):
        probes = _probes(waiting, parts, radius)
        # Hinted: by the size of the open queries, from which Spark estimates theirs, the probes would be broadcast.
        met = probes.join(index.hint("merge"), ["segment", "value"]).select("query", "code").distinct()
        met = met.join(codes.hint("merge"), "code").select("query", F.explode("ids").alias("id"), F.bit_count(F.col("query").bitwiseXOR(F.col("code"))).alias("distance"))
        held = met if best is None else met.unionByName(best).distinct()
        held = materialise(held.withColumn("nth", F.row_number().over(nearest)).filter(F.col("nth") <= k).drop("nth"), "hamming-best")
        covered = count * (radius + 1) - 1
        # With fewer than k ids in all, every id found means an answer.
        state = held.groupBy("query").agg(F.count("*").alias("n"), F.max("distance").alias("far"))
        closed = materialise(state.filter((F.col("n") >= total["ids"]) | ((F.col("n") >= k) & (F.col("far") <= covered))).select("query"), "hamming-closed")
        done.append(held.join(closed, "query", "left_semi"))
        rest = materialise(waiting.join(closed, "query", "left_anti"), "hamming-open")
        best = held.join(rest, "query", "left_semi")
        release(waiting)
        waiting = rest
        if covered >= bits or waiting.isEmpty():
            break
    done.append(best)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def nearest(vectors: DataFrame, queries: Column, k: int = K, bits: int = BITS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, distance) of the rows that satisfy ``queries`` against all rows."""
    rows = vectors.select(F.col(id_column).alias("id"), code_of(vector_column, bits).alias("code"), queries.alias("asks"), F.size(vector_column).alias("n"))
    rows = rows.filter("id IS NOT NULL AND n > 0").select("id", "code", F.coalesce("asks", F.lit(False)).alias("asks")).distinct()
    rows = materialise(rows, "hamming-codes")
    # The limit per code is applied before the rows of a code meet.
    first = rows.select("id", "code").distinct().withColumn("nth", F.row_number().over(Window.partitionBy("code").orderBy("id"))).filter(F.col("nth") <= k + 1)
    codes = materialise(first.groupBy("code").agg(F.collect_list("id").alias("ids")), "hamming-distinct")
    asking = rows.filter("asks").select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    found = materialise(nearest_codes(codes, asking, k + 1, bits), "hamming-found")
    ranked = asking.join(found, "query").filter("query_id <> id")
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return ranked.select("query_id", nth.alias("rank"), F.col("id").alias("vec_id"), "distance").filter(F.col("rank") <= k)


ORACLE = f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(range(1, {BITS + 1}), lambda i: coalesce(embedding[i] > 0 AND NOT isnan(embedding[i]), false)) AS code
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
), p AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         list_sum(list_transform(range(1, {BITS + 1}), lambda i: CASE WHEN q.code[i] <> v.code[i] THEN 1 ELSE 0 END))::INTEGER AS distance
  FROM v q, v WHERE q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id
), r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= {K}
"""
