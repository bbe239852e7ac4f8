"""Sharding through a permutation-filled lookup table (operator 6).

Every shard has a preference order over the slots of a table of prime size,
``(offset + j * skip) mod size``, from two hashes of its name; the shards take
turns, each claiming its next free slot, until the table is full.  Shards then
hold equally many slots (up to one), and adding or removing a shard moves few
of the others' slots.  The table's size is a parameter, so its broadcast is
bounded whatever the input; placing a row is one hash and one lookup.

Defined results: the key is doc_id; a row without doc_id is placed by its text
(null: empty, whole however long), so rows without id spread out too.  Repeated
rows share a shard; a slot has one owner, so there are no ties.  An empty table gives an empty result; other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import ROW, packed, text_of

TABLE_SIZE = 65537
#: Largest table that may be broadcast.
MAX_SIZE = 1 << 21
SHARDS = tuple(f"shard-{k:03d}" for k in range(64))
#: Writers per shard and rows per file of :func:`write_shards`.
FILES_PER_SHARD = 8
ROWS_PER_FILE = 1_000_000


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup_table(shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index of its shard in sorted order of the names; the given order does not matter."""
    names = sorted(set(shards))
    if not names:
        raise ValueError("no shards")
    if not is_prime(size) or size < len(names):
        raise ValueError("the table size must be a prime that is not below the number of shards")
    if size > MAX_SIZE:
        raise ValueError(f"a table of more than {MAX_SIZE} slots is not broadcast")
    offsets = [_number(f"offset|{n}") % size for n in names]
    skips = [_number(f"skip|{n}") % (size - 1) + 1 if size > 2 else 1 for n in names]
    turn = [0] * len(names)
    owner = [-1] * size
    free = size
    while free:
        for shard in range(len(names)):
            while True:
                slot = (offsets[shard] + turn[shard] * skips[shard]) % size
                turn[shard] += 1
                if owner[slot] < 0:
                    break
            owner[slot] = shard
            free -= 1
            if not free:
                break
    return owner


def lookup_frame(spark: SparkSession, shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    names = sorted(set(shards))
    rows = [(slot, names[shard]) for slot, shard in enumerate(lookup_table(shards, size))]
    return spark.createDataFrame(rows, "slot bigint, shard string")


def slot_of(size: int = TABLE_SIZE, id_column: str = "doc_id", text_column: str = "text") -> Column:
    key = F.coalesce(F.concat(F.lit("i"), F.col(id_column).cast("string")), F.concat(F.lit("t"), text_of(text_column)))
    return F.pmod(F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("bigint"), F.lit(size).cast("bigint"))


def assign_shards(docs: DataFrame, shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """``__row``, ``slot`` and ``shard`` of every row; no shuffle."""
    rows = packed(docs, slot=slot_of(size))
    return rows.join(F.broadcast(lookup_frame(docs.sparkSession, shards, size)), "slot")


def write_shards(docs: DataFrame, path: str, shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> None:
    """Write the rows under one folder per shard, each shard by several tasks and in files of bounded length."""
    placed = assign_shards(docs, shards, size).withColumn("part", F.pmod(F.xxhash64("slot"), F.lit(FILES_PER_SHARD)))
    parts = len(set(shards)) * FILES_PER_SHARD
    (
        placed.repartition(parts, "shard", "part")
        .select(f"{ROW}.*", "shard")
        .write.partitionBy("shard").option("maxRecordsPerFile", ROWS_PER_FILE).mode("errorifexists").parquet(path)
    )


def oracle() -> str:
    """Placement in SQL; the table's owners are given as a list literal."""
    names = sorted(SHARDS)
    owners = ",".join(map(str, lookup_table()))
    return f"""
WITH t AS (SELECT [{owners}] AS owners, {names!r} AS names), s AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce('i' || doc_id::VARCHAR, 't' || coalesce(text, ''))), 1, 15))::BIGINT % {TABLE_SIZE} AS slot
  FROM documents)
SELECT doc_id, slot, names[owners[slot + 1] + 1] AS shard FROM s, t
"""
