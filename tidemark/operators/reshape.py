"""Pivot, unpivot and stacking (inventory G2-G4; G1 is ``serve.distinct_ids``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import dec, mean_from, measure, round3


def pivot_mean(
    df: DataFrame,
    rows: Sequence[str] = ("sensor_id", "reading_date"),
    column: str = "parameter",
    values: Sequence[str] = (),
    value: str = "value",
    decimals: int = 3,
) -> DataFrame:
    """One row per ``rows`` key, one column per listed value holding the mean at 3 dp.

    The values must be listed (discovering them would be a distinct job over
    the whole input). Unlisted values vanish; an absent cell is NULL. The mean
    is an exact decimal mean. Written as one conditional sum and count per
    value in a single aggregation: one shuffle of partial aggregates on the row
    key, where ``groupBy().pivot()`` would aggregate per (row key, value) and
    shuffle a second time to pivot.
    """
    if not values:
        raise ValueError("pivot_mean needs the list of pivot values")
    x = dec(value, measure(decimals))
    cells = []
    for v in values:
        hit = F.col(column) == F.lit(v)
        cells.append(round3(mean_from(F.count(F.when(hit, x)), F.sum(F.when(hit, x)))).alias(str(v)))
    return df.groupBy(*rows).agg(*cells)


def unpivot_values(
    wide: DataFrame,
    ids: Sequence[str] = ("sensor_id", "reading_date"),
    values: Sequence[str] = (),
    name: str = "parameter",
    value: str = "value",
) -> DataFrame:
    """Back to one row per (ids, name) with NULL cells dropped.

    Not an inverse of ``pivot_mean``: same-day repeats were averaged and columns
    outside the pivot are gone.
    """
    return wide.unpivot(list(ids), list(values), name, value).where(F.col(value).isNotNull())


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames with the same columns, matched by name."""
    if not frames:
        raise ValueError("nothing to stack")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
