"""Connected components of links as a Spark job (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import materialise, release


def _mark(edges: DataFrame) -> tuple[int, int, int]:
    """Identifies a set of edges: count and two independent sums of hashes."""
    row = edges.agg(
        F.count("*"),
        F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)),
        F.coalesce(F.bit_xor(F.xxhash64("b", F.lit(7), "a")), F.lit(0)),
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links of long ids -> (id, root): the smallest id of the component of every id that has a link.

    Each round is two aggregations and joins on an id; an id with very many
    links costs one pre-aggregated minimum and a join that may be split.  The
    number of rounds grows with the logarithm of the longest chain.
    """
    clean = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = materialise(clean, "links")
    mark = _mark(current)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(low, both["a"] == low["u"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = materialise(large, "links-large")
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        held = large.join(low, large["a"] == low["u"])
        small = held.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(held.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        small = materialise(small, "links-small")
        release(large)
        release(current)
        current, before, mark = small, mark, _mark(small)
        if mark == before:
            break
    return current.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(current.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
