"""Join helpers with an explicit size guard on anything broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Fixed value: the most bytes a side may have to be hinted for a broadcast.
BROADCAST_BYTES = 8 << 20
KEY = "__key"


def keyed(df: DataFrame, keys: Sequence[str], name: str = KEY) -> DataFrame:
    """``df`` with its keys packed into one struct column.

    Structs compare field by field with NULL equal to NULL, so an ordinary
    equality join on the struct keeps the NULL group that GROUP BY makes, and
    the join still hashes, sorts and reuses partitionings by the struct.
    """
    return df.withColumn(name, F.struct(*[F.col(k) for k in keys]))


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
               broadcast_right: bool = False) -> DataFrame:
    """Join on equal keys where NULL equals NULL; left's columns, then right's other columns."""
    keys = list(keys)
    rest = [F.col(c) for c in right.columns if c not in keys]
    side = right.select(F.struct(*[F.col(k) for k in keys]).alias(KEY), *rest)
    if broadcast_right:
        side = F.broadcast(side)
    return keyed(left, keys).join(side, KEY, how).drop(KEY)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of ``df``'s rows in text form, from one aggregation; for small sides that are about to be broadcast."""
    size = F.lit(8 * len(df.columns))
    for c in df.columns:
        size = size + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return int(df.agg(F.sum(size)).first()[0] or 0)


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Column | str | list,
    how: str = "inner",
    max_bytes: int | None = None,
) -> DataFrame:
    """Join a dimension to a fact table; broadcast it only behind a size check.

    By default the check is the planner's: Spark broadcasts a side whose
    estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
    re-decides from the real shuffle sizes; anything larger is sort-merge
    joined. With ``max_bytes`` the side is also hinted, but only after one
    aggregation has measured it as no larger.
    """
    side = dim
    if max_bytes is not None and measured_bytes(dim) <= max_bytes:
        side = F.broadcast(dim)
    return facts.join(side, on, how)
