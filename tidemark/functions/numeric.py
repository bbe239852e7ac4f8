"""Order-independent numerics.

Floating sums depend on the order rows arrive in, so the same mean or standard
deviation can differ in the last bit between two runs, two partitionings or two
engines. Everything here sums exact decimals and converts to double once, at
the end, so the result is a pure function of the multiset of inputs:

* mean      = double(sum(decimal x)) / n
* sample sd = sqrt(double(n*sum(x*x) - sum(x)^2) / double(n*(n-1))), NULL when n < 2
* percent   = double(100 * k) / n

Inputs are measures with at most three decimals by default (the sensor values
and bar prices are rounded to that at the source), so ``decimal(18,3)`` holds them
exactly for |x| < 1e15; squares and products keep scale 6, so nothing is
rounded. Operators take ``decimals`` for finer measures: ``decimal(18,n)`` holds
|x| < 10^(18-n); up to n = 6 sums of squares stay exact, and a mean is exact for
any n. The moment numerator grows like n^2 * x^2; decimal(38,6) holds it up
to n ~ 1e11 rows per group for values near 1e3. ANSI mode turns an overflow
into an error, never into a wrong answer.

Each Spark helper has a SQL twin (``sql_*``) producing the same bits in DuckDB,
used by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal types that hold a 3-decimal measure exactly.
MEAN_DECIMAL = "decimal(18,3)"
MOMENT_DECIMAL = "decimal(18,3)"


def measure(decimals: int = 3) -> str:
    """The type that holds a measure of so many decimals exactly."""
    if not 0 <= decimals <= 12:
        raise ValueError("decimals must be between 0 and 12")
    return f"decimal(18,{decimals})"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dec(col: Column | str, kind: str = MOMENT_DECIMAL) -> Column:
    """The value as an exact decimal; a value with more decimals than ``kind`` holds is an error, never rounded."""
    value = _c(col)
    exact = value.cast(kind)
    fits = value.isNull() | (exact.cast("double") == value.cast("double"))
    said = F.concat(F.lit(f"value does not fit {kind}: "), value.cast("string"))
    return F.when(fits, exact).otherwise(F.raise_error(said).cast(kind))


# --- aggregate building blocks ------------------------------------------------

def exact_mean(col: Column | str, kind: str = MEAN_DECIMAL) -> Column:
    """Mean over non-null values from a decimal sum; NULL on an empty group."""
    x = dec(col, kind)
    return F.sum(x).cast("double") / F.nullif(F.count(x), F.lit(0))


def mean_from(n: Column, s1: Column) -> Column:
    return s1.cast("double") / F.nullif(n, F.lit(0))


def sd_from(n: Column, s1: Column, s2: Column) -> Column:
    """Sample standard deviation from exact moments; NULL when n < 2."""
    num = (n * s2 - s1 * s1).cast("double")
    den = (n * (n - 1)).cast("double")
    return F.when(n >= 2, F.sqrt(num / den))


def exact_stddev(col: Column | str, kind: str = MOMENT_DECIMAL) -> Column:
    x = dec(col, kind)
    n = F.count(x)
    return sd_from(n, F.sum(x), F.sum(x * x))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole in double, NULL when whole is 0."""
    return (part * 100).cast("double") / F.nullif(whole, F.lit(0)).cast("double")


def round3(col: Column | str) -> Column:
    return F.round(_c(col), 3)


def round_to(col: Column | str, digits: int) -> Column:
    return F.round(_c(col), digits)


# --- SQL twins for the DuckDB oracle -------------------------------------------

def sql_round(expr: str, digits: int = 3) -> str:
    """Spark rounds the decimal text of a double half-up; do the same in DuckDB."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,15)), {digits}) AS DOUBLE)"


def sql_mean(col: str) -> str:
    return f"(CAST(sum(CAST({col} AS DECIMAL(18,3))) AS DOUBLE) / nullif(count({col}), 0))"


def sql_sd(col: str, window: str = "") -> str:
    """Sample sd from decimal moments; pass ``window`` as ' OVER (...)' for a window."""
    x = f"CAST({col} AS DECIMAL(18,3))"
    n = f"count({x}){window}"
    s1 = f"sum({x}){window}"
    s2 = f"sum({x} * {x}){window}"
    return (
        f"(CASE WHEN {n} >= 2 THEN sqrt(CAST({n} * {s2} - {s1} * {s1} AS DOUBLE)"
        f" / CAST({n} * ({n} - 1) AS DOUBLE)) END)"
    )


def sql_percent(part: str, whole: str) -> str:
    return f"(CAST(({part}) * 100 AS DOUBLE) / CAST(nullif({whole}, 0) AS DOUBLE))"
