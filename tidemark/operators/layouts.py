"""Written layouts that let a request read a small part of a table.

* **Clustered by id.** Rows range-partitioned and sorted by the id (and further
  columns, so that an id with a third of all rows still spans many ranges), with
  Parquet's row-group and page statistics and a Bloom filter on the id. A lookup
  is an ordinary filter; the scan skips what cannot hold the id.
* **Ranked.** Rows range-partitioned and sorted in a total order, each with its
  place within its range; a small table has each range's first rank. A page at
  any OFFSET reads the one or two ranges that hold it.
* **Grams.** The distinct ids by their three-letter grams. A substring search
  reads the rows of the fragment's grams, intersects and verifies.

Every layout is written by ordinary tasks, a range each; nothing is collected
but a line per range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import serve

#: Bytes of a row group, and rows of a page: what a lookup reads at least.
ROW_GROUP_BYTES, PAGE_ROWS = 16 << 20, 5_000
#: Ranges of a ranked table, and so lines of its rank table.
RANGES = 1_000
GRAM = 3


# --- clustered by id (B9, D3, F2) -----------------------------------------------------

def write_clustered(df: DataFrame, path: str, by: Sequence[str], distinct_ids: int = 1_000_000,
                    row_group_bytes: int = ROW_GROUP_BYTES, ranges: int | None = None) -> None:
    """Write ``df`` by ranges of ``by``, sorted within, with a Bloom filter on its first column.

    ``by`` should begin with the id and go on until it is (nearly) unique.
    ``distinct_ids`` sizes a row group's filter.
    """
    spread = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    (
        spread.sortWithinPartitions(*by).write
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option(f"parquet.bloom.filter.enabled#{by[0]}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{by[0]}", distinct_ids)
        .parquet(path)
    )


def lookup(spark: SparkSession, path: str, entity: str, column: str = "sensor_id") -> DataFrame:
    """The rows of one id of a clustered table (B9): the filter reaches the scan, which skips files, row groups and pages."""
    return serve.for_entity(spark.read.parquet(path), entity, column)


# --- ranked (F2) ------------------------------------------------------------------------

RANGE, PLACE = "_range", "_place"
# monotonically_increasing_id() counts a partition's rows in its low 33 bits.
_PLACE_BITS = (1 << 33) - 1


@dataclass(frozen=True)
class RankedTable:
    """A table in a total order, under ``path``."""

    spark: SparkSession
    path: str

    def write(self, df: DataFrame, order: Sequence[Column], ranges: int = RANGES) -> None:
        """Write ``df`` in ``order`` (sort columns that together are unique) over ``ranges`` ranges."""
        spread = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        placed = spread.select(
            "*", F.spark_partition_id().alias(RANGE), F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS)).alias(PLACE))
        placed.write.partitionBy(RANGE).parquet(f"{self.path}/rows")
        # The schema of an empty table, which has no file to tell it, is kept beside the ranks.
        placed.limit(0).coalesce(1).write.parquet(f"{self.path}/columns")
        counts = self._rows().groupBy(RANGE).agg(F.count(F.lit(1)).alias("rows")).orderBy(RANGE).collect()
        first, lines = 0, []
        for r in counts:
            lines.append((r[RANGE], first, r["rows"]))
            first += r["rows"]
        schema = f"{RANGE} int, first_rank bigint, rows bigint"
        self.spark.createDataFrame(lines, schema).coalesce(1).write.parquet(f"{self.path}/ranks")

    def _rows(self) -> DataFrame:
        columns = self.spark.read.parquet(f"{self.path}/columns").schema
        return self.spark.read.schema(columns).parquet(f"{self.path}/rows")

    def ranks(self) -> list[tuple[int, int, int]]:
        """(range, rank of its first row, rows), in order; as many as there are ranges."""
        return sorted((r[RANGE], r["first_rank"], r["rows"]) for r in self.spark.read.parquet(f"{self.path}/ranks").collect())

    def total(self) -> int:
        return sum(rows for _, _, rows in self.ranks())

    def between(self, begin: int, end: int) -> DataFrame:
        """The rows of rank ``begin`` up to ``end`` (exclusive), with ``rank`` (from 0); reads only the ranges that hold them."""
        held = [(k, first) for k, first, rows in self.ranks() if first < end and first + rows > begin]
        rows = self._rows()
        if not held:
            return rows.where("false").withColumn("rank", F.lit(0).cast("long")).drop(RANGE, PLACE)
        # A range's own bounds on the place reach its scan; the ranges' filter prunes folders.
        within = F.lit(False)
        rank = F.lit(None).cast("long")
        for k, first in held:
            within = within | ((F.col(RANGE) == k) & (F.col(PLACE) >= begin - first) & (F.col(PLACE) < end - first))
            rank = F.when(F.col(RANGE) == k, F.col(PLACE) + F.lit(first)).otherwise(rank)
        rows = rows.where(F.col(RANGE).isin([k for k, _ in held])).where(within)
        return rows.withColumn("rank", rank).drop(RANGE, PLACE)

    def page(self, offset: int, limit: int, entity: str | None = None, column: str = "sensor_id") -> DataFrame:
        """``limit`` rows from ``offset`` on (F2), in order; of one entity if the order begins with its column."""
        if offset < 0:
            raise ValueError("offset must be >= 0")
        serve._check_range("limit", limit, serve.PAGE_LIMIT)
        if entity is None:
            return self.between(offset, offset + limit).orderBy("rank")
        rows = serve.for_entity(self._rows(), entity, column)
        first = rows.agg(F.min(F.struct(RANGE, PLACE)).alias("at")).select("at.*").first()
        if first[RANGE] is None:
            return self.between(0, 0)
        begin = next(f for k, f, _ in self.ranks() if k == first[RANGE]) + first[PLACE] + offset
        return self.between(begin, begin + limit).where(F.col(column) == entity).orderBy("rank")


# --- grams (B8, F4) -----------------------------------------------------------------------

def grams_of(text: str) -> list[str]:
    return sorted({text[k : k + GRAM] for k in range(len(text) - GRAM + 1)})


@dataclass(frozen=True)
class GramIndex:
    """The distinct ids of a table and their grams, under ``path``."""

    spark: SparkSession
    path: str

    def write(self, df: DataFrame, column: str = "sensor_id") -> None:
        """Index the distinct values of ``column``, NULL left out; each gram's ids lie together."""
        ids = df.select(F.col(column).alias("id")).where("id IS NOT NULL").distinct()
        ids.write.parquet(f"{self.path}/ids")
        places = F.sequence(F.lit(1), F.length("id") - (GRAM - 1))
        grams = F.when(F.length("id") >= GRAM, F.array_distinct(F.transform(places, lambda k: F.substring(F.col("id"), k, F.lit(GRAM)))))
        pairs = self.spark.read.parquet(f"{self.path}/ids").select("id", F.explode(grams).alias("gram"))
        write_clustered(pairs, f"{self.path}/grams", ["gram", "id"], distinct_ids=50_000)

    def matching(self, fragment: str | None) -> DataFrame:
        """The ids that contain ``fragment``; a fragment shorter than a gram is looked for in the distinct ids."""
        if not fragment or len(fragment) < GRAM:
            return serve.id_contains(self.spark.read.parquet(f"{self.path}/ids"), fragment, "id")
        wanted = grams_of(fragment)
        hits = self.spark.read.parquet(f"{self.path}/grams").where(F.col("gram").isin(wanted))
        both = hits.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(wanted)).select("id")
        return serve.id_contains(both, fragment, "id")

    def search(self, fragment: str | None, limit: int = 1000, column: str = "sensor_id") -> DataFrame:
        """:func:`serve.search_ids` over the index."""
        return serve.search_ids(self.matching(fragment).select(F.col("id").alias(column)), fragment, limit, column)
