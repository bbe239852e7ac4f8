"""Access to the driver-generated parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The table names the driver writes, one parquet file each.
TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazily scan one table; column pruning and filters reach the parquet reader."""
    if name not in TABLE_NAMES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")
