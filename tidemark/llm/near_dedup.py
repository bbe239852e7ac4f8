"""Near-duplicate classes from DartMinHash signatures (operator 8).

1. Texts are reduced to their words; equal word sequences are one *text* from
   here on, however many rows have it.
2. Each text gets a DartMinHash signature of its weighted five-word shingles;
   the signature is cut into bands, and texts that share a band meet in a
   bucket.  Bands of ``ROWS`` coordinates find a pair of similarity 0.8 with
   probability above 0.999.
3. Buckets are split by set size (similar sets have similar sizes) and then
   into blocks of bounded rows and bytes.  Every pair of blocks that can hold
   similar texts is one small group; in it, texts whose signatures agree far
   below the threshold are passed over, the others' weighted Jaccard similarity
   is computed from their sets.  Only links that join two parts of a group
   leave the task, so a bucket of m texts gives at most m - 1 links a group.
   No bucket is capped: a hot one has more blocks, in more tasks.
4. The links' connected components are the classes.

Defined results: null text counts as empty; a row without words is a class
of its own; equal word sequences of at least one word are always one class.
Texts of any length are taken whole.  ``class_id`` is the smallest doc_id of the
class (null ids last), ``kept`` marks one row with it.  Repeated rows share a
class, one of them is kept.  An empty table gives an empty result; other
columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import ROW, materialise, packed, text_of, tidy
from tidemark.llm.darts import BANDS, K, bands, signatures
from tidemark.llm.links import components
from tidemark.llm.shingles import blocks, occurrences, weighted

SIMILARITY = 0.8
#: Signatures agree in K draws; this far under the threshold (4.5 standard deviations) a pair is passed over.  1.0: every pair of a bucket is verified.
MARGIN = 0.15
#: Texts and set elements of a block.
BLOCK_TEXTS = 1024
BLOCK_ELEMENTS = 1 << 18


def words_of(column: str = "text") -> Column:
    """Lower-cased words joined by single blanks; what ``str.split`` takes for white space parts them, as in :mod:`tidemark.llm.shingles`."""
    return F.trim(F.regexp_replace(F.lower(text_of(column)), r"[\s\p{Z}\x1c-\x1f\x85]+", " "))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, doc_id, row, words) -> the first three, set size and band keys; texts without words are left out."""
    for batch in batches:
        for index, held in blocks(batch.column(3).to_pylist()):
            owner, element, weight = weighted(held)
            keys = bands(signatures(owner, element, weight, len(held)))
            size = np.bincount(owner, weights=weight, minlength=len(held)).astype(np.int64)
            some = np.flatnonzero(size)
            at = pa.array(np.asarray(index)[some])
            flat = pa.array(keys[some].reshape(-1).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([batch.column(k).take(at) for k in range(3)] + [pa.array(size[some]), lists], names=["digest", "doc_id", "row", "size", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tid, words) -> tid, signature and element set as bytes."""
    for batch in batches:
        for index, held in blocks(batch.column(1).to_pylist()):
            owner, element, weight = weighted(held)
            signed = signatures(owner, element, weight, len(held)).astype(np.uint32)
            cut = np.searchsorted(owner, np.arange(len(held) + 1))
            sets = [occurrences(element[a:b], weight[a:b]).tobytes() for a, b in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(index)), pa.array([s.tobytes() for s in signed], pa.binary()), pa.array(sets, pa.binary())],
                names=["tid", "signature", "elements"],
            )


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """The rows of each group of a partition that is sorted by its first column; one group at a time is copied."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        gid = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(gid[1:] != gid[:-1]) + 1).tolist(), len(gid)] if len(gid) else []
        for a, b in zip(cuts, cuts[1:]):
            if held and last != gid[a]:
                yield pa.Table.from_batches(held).to_pydict()
                held = []
            held.append(batch.slice(a, b - a))
            last = gid[a]
        # What goes on in the next batch must not keep this one in memory.
        held = [pa.RecordBatch.from_pylist(h.to_pylist(), schema=h.schema) for h in held]
    if held:
        yield pa.Table.from_batches(held).to_pydict()


def _linked(batches: Iterator[pa.RecordBatch], similarity: float, margin: float) -> Iterator[pa.RecordBatch]:
    for group in _grouped(batches):
        a, b = links_of(group["tid"], group["side"], group["signature"], group["elements"], similarity, margin)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def links_of(tids: list[int], sides: list[int], signed: list[bytes], sets: list[bytes], similarity: float, margin: float = MARGIN) -> tuple[list[int], list[int]]:
    """Links that join the parts of one group.  Side 0 meets side 1; in a group of one block (side 2) all meet all."""
    first = {}
    for k, t in enumerate(tids):
        first.setdefault(t, k)
    take = sorted(first.values())
    matrix = np.frombuffer(b"".join(signed[k] for k in take), np.uint32).reshape(len(take), K)
    side = np.array([sides[k] for k in take])
    size = np.array([len(sets[k]) // 8 for k in take])
    one, two = (np.flatnonzero(side != 1), np.flatnonzero(side != 0))
    agree = np.zeros((len(one), len(two)), np.int32)
    for c in range(K):
        agree += matrix[one, c][:, None] == matrix[two, c][None, :]
    small, big = np.minimum(size[one][:, None], size[two][None, :]), np.maximum(size[one][:, None], size[two][None, :])
    near = (agree >= (similarity - margin) * K) & (small >= similarity * big)
    if (side == 2).any():
        near &= one[:, None] < two[None, :]
    rows, cols = np.nonzero(near)
    order = np.argsort(-agree[rows, cols], kind="stable")
    root = list(range(len(take)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    elements: dict[int, np.ndarray] = {}
    out_a, out_b = [], []
    for x, y in zip(one[rows[order]].tolist(), two[cols[order]].tolist()):
        p, q = find(x), find(y)
        if p == q:
            continue
        for k in (x, y):
            if k not in elements:
                elements[k] = np.frombuffer(sets[take[k]], np.uint64)
        if similar(elements[x], elements[y], similarity):
            root[max(p, q)] = min(p, q)
            out_a.append(tids[take[x]])
            out_b.append(tids[take[y]])
    return out_a, out_b


def similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Jaccard similarity of two sorted sets of unique elements is at least ``similarity``."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    common = int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x))
    return common >= similarity * (len(x) + len(y) - common) - 1e-9


def _groups(texts: DataFrame, similarity: float) -> DataFrame:
    """(gid, side, tid): the pairs of blocks, of the buckets with at least two texts, that can hold similar texts."""
    # Sizes of similar sets differ by a factor below 1 / similarity: they are in the same or adjacent classes.
    level = F.floor(F.log(1.0 / similarity, F.col("size").cast("double")) + 1e-9).cast("int")
    member = texts.select("tid", "size", level.alias("level"), F.explode("bands").alias("key"))
    stats = member.groupBy("key").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("tid")).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit(11), "tid")).alias("x2"),
    ).filter("n >= 2")
    # Bands often repeat the same bucket: one key for each set of members.
    once = stats.groupBy("n", "x1", "x2").agg(F.min("key").alias("key")).select("key")
    member = materialise(member.join(once, "key", "left_semi"), "near-members")
    # Blocks of each (bucket, size class): as many as rows and bytes ask for.
    shape = member.groupBy("key", "level").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    shape = shape.select("key", "level", F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("s") / BLOCK_ELEMENTS)).cast("int").alias("blocks"))
    shape = materialise(shape, "near-shape")
    here, above, below = (
        shape.select("key", F.expr(f"level {shift}").cast("int").alias("level"), F.col("blocks").alias(name))
        for shift, name in (("+ 0", "here"), ("- 1", "above"), ("+ 1", "below"))
    )
    sized = member.join(here, ["key", "level"]).join(above, ["key", "level"], "left").join(below, ["key", "level"], "left")
    sized = sized.withColumn("block", F.pmod(F.xxhash64(F.lit(3), "tid"), F.col("here")).cast("int"))

    def pair(level: Column, i: Column, step: int, j: Column, side: Column) -> Column:
        return F.struct(F.xxhash64("key", level, i, F.lit(step), j).alias("gid"), side.cast("int").alias("side"))

    none = F.array().cast("array<struct<gid:bigint,side:int>>")
    each = lambda count: F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(F.array().cast("array<int>"))
    same = F.transform(each("here"), lambda j: pair(
        F.col("level"), F.least("block", j), 0, F.greatest("block", j),
        F.when(F.col("block") == j, 2).when(F.col("block") < j, 0).otherwise(1)))
    up = F.coalesce(F.transform(each("above"), lambda j: pair(F.col("level"), F.col("block"), 1, j, F.lit(0))), none)
    down = F.coalesce(F.transform(each("below"), lambda i: pair(F.col("level") - 1, i, 1, F.col("block"), F.lit(1))), none)
    return sized.select("tid", F.explode(F.concat(same, up, down)).alias("g")).select("g.gid", "g.side", "tid")


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, margin: float = MARGIN) -> DataFrame:
    """(doc_id, digest, class_id, class_size, kept) of every row of ``docs`` (columns doc_id, text)."""
    rows = docs.select("doc_id", words_of().alias("words")).select("doc_id", F.sha2(F.col("words").cast("binary"), 256).alias("digest"), "words")
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbered = rows.select("digest", "doc_id", F.monotonically_increasing_id().alias("row"), "words")
    signed = materialise(numbered.mapInArrow(tidy(_signed), f"digest string, doc_id {kind}, row bigint, size bigint, bands array<bigint>"), "near-signed")
    # One text for each word sequence; its id is the smallest row number.
    copies = signed.groupBy("digest").agg(
        F.min(F.struct(F.col("row").alias("tid"), "doc_id")).alias("first"), F.min(_order()).alias("lowest"), F.count("*").alias("copies")
    )
    first = materialise(copies.select("first.tid", "first.doc_id", "digest", "lowest", "copies"), "near-first")
    texts = materialise(signed.join(first.select("tid"), F.col("row") == F.col("tid"), "left_semi").select(F.col("row").alias("tid"), "size", "bands"), "near-texts")
    groups = materialise(_groups(texts, similarity), "near-groups")
    # A group with one text has nothing to compare.
    full = groups.groupBy("gid").agg(F.min("tid").alias("lo"), F.max("tid").alias("hi")).filter("lo < hi").select("gid")
    groups = groups.join(full, "gid", "left_semi")
    wanted = first.join(groups.select("tid").distinct(), "tid", "left_semi").select("tid", F.col("doc_id").alias("id"), F.col("digest").alias("sha"))
    bodies = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("sha"))).select("tid", "words")
    sets = materialise(bodies.mapInArrow(tidy(_sets), "tid bigint, signature binary, elements binary"), "near-sets")
    placed = groups.join(sets, "tid").select("gid", "side", "tid", "signature", "elements").repartition("gid").sortWithinPartitions("gid")
    found = placed.mapInArrow(tidy(lambda batches: _linked(batches, similarity, margin)), "a bigint, b bigint")
    roots = components(found)
    return _decided(rows, signed, first, roots)


def _order() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("row"))


def _decided(rows: DataFrame, signed: DataFrame, first: DataFrame, roots: DataFrame) -> DataFrame:
    """Decisions per row.  Classes are summed up over texts and written, so the joins back are plain and may be split."""
    known = first.join(roots, F.col("tid") == F.col("id"), "left").select("digest", "lowest", "copies", F.coalesce("root", "tid").alias("root"))
    known = materialise(known, "near-known")
    best = materialise(known.groupBy("root").agg(F.min("lowest").alias("best"), F.sum("copies").alias("class_size")), "near-best")
    classed = known.select("digest", "root").join(best, "root").select("digest", "best", "class_size")
    decided = signed.select("digest", "doc_id", "row").join(classed, "digest").select(
        "doc_id", "digest", F.col("best.doc_id").alias("class_id"), "class_size", (F.col("best.row") == F.col("row")).alias("kept")
    )
    empty = rows.filter("words = ''").select("doc_id", "digest", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"), F.lit(True).alias("kept"))
    return decided.unionByName(empty)


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` of which one stays for each class, with all their columns.

    Rows are matched by (doc_id, word sequence); rows that repeat both are told apart here.
    """
    decided = near_classes(docs, similarity).filter("digest <> sha2(cast('' as binary), 256)")
    stay = decided.groupBy(F.col("doc_id").alias("id"), F.col("digest").alias("sha")).agg(F.count("*").alias("copies"), F.count_if("kept").alias("times"))
    stay = materialise(stay.filter("times > 0"), "near-stay")
    rows = packed(docs, doc_key=F.col("doc_id"), words=words_of())
    rows = rows.withColumn("text_key", F.sha2(F.col("words").cast("binary"), 256))
    some = rows.filter("words <> ''")
    held = some.join(stay, F.col("doc_key").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("sha")))
    nth = F.row_number().over(Window.partitionBy("doc_key", "text_key").orderBy(F.lit(1)))
    repeated = held.filter("copies > times").withColumn("nth", nth).filter(F.col("nth") <= F.col("times"))
    kept = held.filter("copies = times").select(f"{ROW}.*").unionByName(repeated.select(f"{ROW}.*"))
    return kept.unionByName(rows.filter("words = ''").select(f"{ROW}.*"))
