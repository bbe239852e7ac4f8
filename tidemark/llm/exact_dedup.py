"""Exact deduplication with a heavy-hitter split (operator 9, DataFrame operations only).

A digest per row is computed once and written to the shared folder.  A
Misra-Gries pass over the digests (Spark's ``freqItems``, mergeable counters
with at most ``1 / support`` entries) finds every digest that more than
``support`` of the rows share.  The true counts of these candidates are then
taken, and the verified ones with their winners - never more than
``1 / support`` rows - are broadcast: their rows are decided map-side and
never shuffled.  All other digests go through an ordinary shuffle, in which no
group can hold more than ``support`` of the rows.

Defined results: null text counts as the empty text; empty texts are equal to
each other.  The row with the smallest ``doc_id`` stays, rows with a null
``doc_id`` come last; among rows that repeat ``doc_id`` and text exactly one
stays, so there are no ties.  Texts of any length are digested whole.  An empty
table gives an empty result.  Other columns, whatever their names, take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ROW, materialise, packed, text_of

#: Share of all rows from which a digest is treated as heavy; bounds the broadcast to 1 / SUPPORT rows.
SUPPORT = 1e-4


def normalised(column: str = "text") -> Column:
    """The text with each run of ASCII white space replaced by one space."""
    return F.regexp_replace(text_of(column), r"[ \t-\r]+", " ")


def digest_of(column: str = "text") -> Column:
    return F.sha2(normalised(column).cast("binary"), 256)


def row_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, text_sha256, row) of every row, written once; ``row`` tells repeated rows apart."""
    keys = docs.select("doc_id", digest_of().alias("text_sha256"), F.monotonically_increasing_id().alias("row"))
    return materialise(keys, "exact-digests")


def heavy_winners(keys: DataFrame, support: float) -> DataFrame:
    """Digests that at least ``support`` of the rows (and two rows) share, with count and winner; at most 1 / support rows."""
    candidates = keys.freqItems(["text_sha256"], support).select(F.explode("text_sha256_freqItems").alias("text_sha256"))
    least = max(2.0, keys.count() * support)
    return (
        keys.join(F.broadcast(candidates), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.count("*").alias("group_size"), F.min(_order()).alias("first"))
        .filter(F.col("group_size") >= least)
    )


def _order() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("row"))


def decide(keys: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Decisions for :func:`row_digests`: doc_id, keep_id, group_size, kept, text_sha256."""
    winners = materialise(heavy_winners(keys, support), "exact-winners")
    heavy = keys.join(F.broadcast(winners), "text_sha256")
    others = keys.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    # An aggregate and a join, no window: a group's rows are never held together.
    groups = others.groupBy("text_sha256").agg(F.count("*").alias("group_size"), F.min(_order()).alias("first"))
    light = others.join(groups, "text_sha256")
    return heavy.unionByName(light).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("first.row") == F.col("row")).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One decision per row of ``docs`` (columns doc_id, text)."""
    return decide(row_digests(docs), support)


def keep_first(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    The texts are shuffled once, by (doc_id, digest).  Rows that repeat both
    are told apart only here, where ``twins`` says that there are any.
    """
    keys = row_digests(docs)
    twins = keys.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("twins"))
    stay = decide(keys, support).filter("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"))
    stay = stay.join(twins, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("sha") == F.col("text_sha256"))).select("id", "sha", "twins")
    rows = packed(docs, doc_key=F.col("doc_id"), text_key=digest_of())
    held = rows.join(stay, F.col("doc_key").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("sha")))
    single = held.filter("twins = 1").select(f"{ROW}.*")
    repeated = held.filter("twins > 1").dropDuplicates(["doc_key", "text_key"]).select(f"{ROW}.*")
    return single.unionByName(repeated)


ORACLE = r"""
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
WINDOW g AS (PARTITION BY text_sha256)
"""
