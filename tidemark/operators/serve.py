"""Read queries over the processed tables (inventory B7-B9, B12-B15, C5, D3, D4,
D9, D10, E11, F2-F6, G1).

These are what an API would run per request. Each is a lazy DataFrame; only
the envelope helpers collect, and what they collect is bounded by ``limit``.
Orders are total (a tie-break on the key), so pages never overlap or skip.
Null placement follows the serving database: ascending puts NULLs last,
descending puts them first.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import dec, exact_stddev, measure, percent, round3
from tidemark.operators.joins import keyed_join

# The id pattern, enumerations and request bounds of the API.
SENSOR_ID_PATTERN = r"^[0-9a-z]{7}$"
FRAGMENT_PATTERN = r"^[0-9a-z]*$"
FRAGMENT_MAX = 7
STATUSES = ("Good", "Bad")
SORT_FIELDS = ("reading_date", "parameter", "value", "status", "reading_no", "delta", "rolling_avg_7d", "z_score")
ORDERS = ("asc", "desc")
PAGE_LIMIT = (1, 500)
SEARCH_LIMIT = (1, 5000)
READING_COLUMNS = (
    "sensor_id", "reading_date", "location", "parameter", "value", "status",
    "reading_no", "prev_value", "delta", "rolling_avg_7d", "bad_so_far", "z_score",
)
OUTLIER_Z = 2.0


def _check_range(name: str, v: int, bounds: tuple[int, int]) -> None:
    if not (bounds[0] <= v <= bounds[1]):
        raise ValueError(f"{name} must be between {bounds[0]} and {bounds[1]}, got {v}")


def check_sensor_id(sensor_id: str) -> str:
    if not re.fullmatch(SENSOR_ID_PATTERN[1:-1], sensor_id or ""):
        raise ValueError(f"sensor id must match {SENSOR_ID_PATTERN}, got {sensor_id!r}")
    return sensor_id


# --- filters and projections (B7-B9, B12, B15) ------------------------------------

def optional_filters(df: DataFrame, **equals) -> DataFrame:
    """Equality filters where a None value means "no filter" (B7)."""
    cond = F.lit(True)
    for col, v in equals.items():
        if v is not None:
            cond = cond & (F.col(col) == F.lit(v))
    return df.where(cond)


def id_contains(df: DataFrame, fragment: str | None, column: str = "sensor_id") -> DataFrame:
    """Ids containing ``fragment`` (B8); empty or None means no filter."""
    if fragment:
        if len(fragment) > FRAGMENT_MAX or not re.fullmatch(FRAGMENT_PATTERN[1:-1], fragment):
            raise ValueError(f"fragment must match {FRAGMENT_PATTERN} and be at most {FRAGMENT_MAX} long")
        return df.where(F.col(column).contains(fragment))
    return df


def for_entity(df: DataFrame, entity: Column | str, column: str = "sensor_id") -> DataFrame:
    """Point lookup (B9); ``entity`` may be a literal id or a column expression."""
    value = entity if isinstance(entity, Column) else F.lit(check_sensor_id(entity))
    return df.where(F.col(column) == value)


def reading_rows(df: DataFrame) -> DataFrame:
    """The fixed 12-column reading projection."""
    return df.select(*READING_COLUMNS)


def flag_outliers(df: DataFrame, z: str = "z_score", threshold: float = OUTLIER_Z) -> DataFrame:
    """``is_outlier`` = |z| > threshold, NULL z counts as not an outlier."""
    return df.withColumn("is_outlier", F.coalesce(F.abs(F.col(z)) > F.lit(threshold), F.lit(False)))


def flag_warnings(summary: DataFrame, bad: str = "bad_readings") -> DataFrame:
    """``warn`` = the entity has any bad reading (B12's second threshold)."""
    return summary.withColumn("warn", F.coalesce(F.col(bad) > 0, F.lit(False)))


def validate_rows(df: DataFrame, parameters: Sequence[str], id_col: str = "sensor_id") -> DataFrame:
    """Per-rule counts of rows an API contract would reject (B13), one row."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.coalesce(F.col(id_col).rlike(SENSOR_ID_PATTERN), F.lit(False))).alias("bad_id"),
        F.count_if(~F.coalesce(F.col("parameter").isin(list(parameters)), F.lit(False))).alias("bad_parameter"),
        F.count_if(~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False))).alias("bad_status"),
    )


# Parts that a search is counted in.
SEARCH_PARTS = 64


# --- distinct ids, choices, search (G1, B14, F4, E11) ----------------------------------

def distinct_ids(df: DataFrame, column: str = "sensor_id") -> DataFrame:
    """Sorted distinct ids (G1): a hash aggregate (partial per map task), then a sort."""
    return df.select(column).distinct().orderBy(column)


def choices(df: DataFrame, column: str) -> DataFrame:
    """The sorted distinct values a filter box offers."""
    return df.select(column).distinct().orderBy(column)


def with_total(df: DataFrame, name: str = "total") -> DataFrame:
    """Attach the row count before any limit.

    The count is a scalar subquery (one partial aggregation, evaluated once): an
    unpartitioned ``count() over ()`` would pull every row into a single task.
    """
    return df.withColumn(name, df.select(F.count(F.lit(1))).scalar())


def search_ids(df: DataFrame, fragment: str | None, limit: int = 1000, column: str = "sensor_id") -> DataFrame:
    """Up to ``limit`` sorted ids containing ``fragment``, each with the total match count.

    One scan: an aggregate of the distinct ids keeps their number and, per
    task, only the ``limit`` smallest of them.
    """
    _check_range("limit", limit, SEARCH_LIMIT)
    found = search_envelope(df, fragment, limit, column)
    return found.select(F.explode("items").alias(column), "total")


def search_envelope(df: DataFrame, fragment: str | None, limit: int = 1000, column: str = "sensor_id") -> DataFrame:
    """One row: items (at most ``limit`` ids, sorted), total, limit, truncated."""
    _check_range("limit", limit, SEARCH_LIMIT)
    ids = id_contains(df.select(column), fragment, column).where(F.col(column).isNotNull()).distinct()
    # Each part keeps its smallest ids and its count; the parts are then put together.
    part = F.pmod(F.hash(column), F.lit(SEARCH_PARTS))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    counted = ids.withColumn("_part", part).withColumn("_nth", nth)
    whole = counted.groupBy("_part").agg(
        F.count(F.lit(1)).alias("n"), F.collect_list(F.when(F.col("_nth") <= limit, F.col(column))).alias("first"))
    merged = whole.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.sort_array(F.flatten(F.collect_list("first"))).alias("all"))
    items = F.slice("all", 1, limit)
    return merged.select(items.alias("items"), "total", F.lit(limit).alias("limit"), (F.col("total") > F.size(items)).alias("truncated"))


# --- summaries (D3, D4, D9, D10, C5) ------------------------------------------------------

def _bad() -> Column:
    return F.col("status") == "Bad"


def entity_summary(df: DataFrame, entity: Column | str | None = None, by: Sequence[str] = ("sensor_id",)) -> DataFrame:
    """Overall summary per entity (D3).

    With ``entity`` given: an ungrouped aggregate over that id, always exactly
    one row (readings 0 means unknown). Without: one row per entity. The
    location is ``min(location)`` so a broken one-location invariant cannot
    duplicate rows; the percentage is guarded against 0 readings.
    """
    aggs = [
        F.min("location").alias("location"),
        F.count(F.lit(1)).alias("readings"),
        F.min("reading_date").alias("first_reading"),
        F.max("reading_date").alias("last_reading"),
        F.count_if(_bad()).alias("bad_readings"),
        round3(percent(F.count_if(_bad()), F.count(F.lit(1)))).alias("bad_pct"),
    ]
    if entity is not None:
        return for_entity(df, entity).agg(*aggs)
    return df.groupBy(*by).agg(*aggs)


def parameter_summary(df: DataFrame, entity: Column | str | None = None, by: Sequence[str] = ("sensor_id",), decimals: int = 3) -> DataFrame:
    """Per-parameter summary of one entity ordered by parameter, or of every entity."""
    keys = ["parameter"] if entity is not None else [*by, "parameter"]
    src = for_entity(df, entity) if entity is not None else df
    n = F.count(F.lit(1))
    x = dec("value", measure(decimals))
    out = src.groupBy(*keys).agg(
        n.alias("readings"),
        round3(F.sum(x).cast("double") / n).alias("avg_value"),
        round3(F.min("value")).alias("min_value"),
        round3(F.max("value")).alias("max_value"),
        round3(exact_stddev("value", measure(decimals))).alias("stddev_value"),
        F.count_if(_bad()).alias("bad_readings"),
        round3(percent(F.count_if(_bad()), n)).alias("bad_pct"),
        F.min("reading_date").alias("first_reading"),
        F.max("reading_date").alias("last_reading"),
    )
    return out.orderBy("parameter") if entity is not None else out


def entity_documents(df: DataFrame, by: str = "sensor_id") -> DataFrame:
    """Every entity's summary with its per-parameter summaries nested, sorted by parameter.

    The nested list has one element per parameter of the entity, so it is
    bounded by the number of parameters, not by the readings.
    """
    per = parameter_summary(df, by=[by])
    fields = [c for c in per.columns if c != by]
    nested = per.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("parameters"))
    return keyed_join(entity_summary(df, by=[by]), nested, [by], "left")


def existence_probe(df: DataFrame, entity: Column | str, condition: Column, column: str = "sensor_id") -> DataFrame:
    """One row: rows of the entity, and rows of it passing ``condition``.

    Tells "unknown entity" (exists_rows = 0) from "filter removed everything"
    (matching_rows = 0 < exists_rows) in one conditional aggregate.
    """
    scoped = for_entity(df, entity, column)
    return scoped.agg(
        F.count(F.lit(1)).alias("exists_rows"),
        F.count_if(F.coalesce(condition, F.lit(False))).alias("matching_rows"),
    )


def table_health(readings: DataFrame, summaries: DataFrame) -> DataFrame:
    """Row counts of both tables and ``ok``/``empty`` (D10, via C2)."""
    r = readings.agg(F.count(F.lit(1)).alias("readings"))
    summaries_count = summaries.select(F.count(F.lit(1))).scalar()
    return r.select(
        F.when(F.col("readings") > 0, F.lit("ok")).otherwise(F.lit("empty")).alias("status"),
        "readings", summaries_count.alias("summaries"),
    )


# --- paging (F2, F3, F6) ------------------------------------------------------------------

def sort_key(column: str, order: str) -> Column:
    """Ascending puts NULLs last, descending puts them first."""
    if column not in SORT_FIELDS:
        raise ValueError(f"sort must be one of {', '.join(SORT_FIELDS)}, got {column!r}")
    if order not in ORDERS:
        raise ValueError(f"order must be asc or desc, got {order!r}")
    c = F.col(column)
    return c.asc_nulls_last() if order == "asc" else c.desc_nulls_first()


def page(
    df: DataFrame,
    entity: Column | str | None = None,
    parameter: str | None = None,
    status: str | None = None,
    sort: str = "reading_date",
    order: str = "asc",
    limit: int = 50,
    offset: int = 0,
    tie_break: Sequence[str] = ("parameter", "reading_no"),
) -> DataFrame:
    """One page of readings (F2): filter, total order, OFFSET, LIMIT.

    The tie-break plus the entity filter is the primary key, so the order is
    total. Without an entity the sensor id joins the tie-break. Spark plans
    this as a bounded top-k (TakeOrderedAndProject), never a full sort.
    """
    _check_range("limit", limit, PAGE_LIMIT)
    if offset < 0:
        raise ValueError("offset must be >= 0")
    if status is not None and status not in STATUSES:
        raise ValueError(f"status must be one of {STATUSES}")
    src = df if entity is None else for_entity(df, entity)
    src = optional_filters(src, parameter=parameter, status=status)
    ties = list(tie_break) if entity is not None else ["sensor_id", *tie_break]
    ordered = src.select(*READING_COLUMNS).orderBy(sort_key(sort, order), *[F.col(t).asc() for t in ties])
    return ordered.offset(offset).limit(limit) if offset else ordered.limit(limit)


def page_after(
    df: DataFrame,
    entity: Column | str,
    after: tuple | None = None,
    sort: str = "reading_date",
    order: str = "asc",
    limit: int = 50,
) -> DataFrame:
    """The page that follows a row, by keyset instead of OFFSET (F2).

    ``after`` is (sort value, parameter, reading_no) of the last row seen, None
    for the first page. However deep the page, a task keeps ``limit`` rows; the
    order is that of :func:`page`.
    """
    _check_range("limit", limit, PAGE_LIMIT)
    rows = for_entity(df, entity)
    if after is not None:
        value, parameter, number = after
        tail = (F.col("parameter") > F.lit(parameter)) | ((F.col("parameter") == F.lit(parameter)) & (F.col("reading_no") > F.lit(number)))
        same = F.col(sort).eqNullSafe(F.lit(value))
        if value is None:  # NULLs are last upwards and first downwards
            beyond = F.lit(False) if order == "asc" else F.col(sort).isNotNull()
        else:
            beyond = F.coalesce(F.col(sort) > F.lit(value), F.lit(True)) if order == "asc" else F.coalesce(F.col(sort) < F.lit(value), F.lit(False))
        rows = rows.where(beyond | (same & tail))
    return page(rows, None, sort=sort, order=order, limit=limit)


def page_envelope(df: DataFrame, entity: Column | str | None = None, parameter: str | None = None,
                  status: str | None = None, sort: str = "reading_date", order: str = "asc",
                  limit: int = 50, offset: int = 0) -> DataFrame:
    """One row: total matching, limit, offset, sort, order, has_more."""
    sort_key(sort, order)
    src = df if entity is None else for_entity(df, entity)
    src = optional_filters(src, parameter=parameter, status=status)
    return src.agg(F.count(F.lit(1)).alias("total")).select(
        "total", F.lit(limit).alias("limit"), F.lit(offset).alias("offset"),
        F.lit(sort).alias("sort"), F.lit(order).alias("order"),
        (F.col("total") > F.lit(offset + limit)).alias("has_more"),
    )


def ordered_table(df: DataFrame, keys: Sequence[str] = ("location", "parameter")) -> DataFrame:
    """The summary table in key order (F6); also the chronological sort of F5 with keys=('date',)."""
    return df.orderBy(*keys)
