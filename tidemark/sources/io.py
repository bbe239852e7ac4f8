"""Sources and sinks (inventory A2-A6, A8, A14).

Writes never pass rows through the driver: parquet and JDBC writes run in the
executors. Reports are counted during the write with ``observe`` (one pass)
instead of re-running the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# JDBC load defaults - a cap on concurrent writers and rows per batch.
JDBC_WRITERS = 8
JDBC_BATCH = 10_000


def scan(spark: SparkSession, path: str) -> DataFrame:
    """A whole parquet directory (A2)."""
    return spark.read.parquet(path)


def write_bars(df: DataFrame, path: str, ticker: str = "ticker", mode: str = "overwrite") -> None:
    """One dataset partitioned by ticker, instead of a file per ticker."""
    df.write.mode(mode).partitionBy(ticker).parquet(path)


def scan_bars(spark: SparkSession, path: str, tickers: Sequence[str] | None = None,
              ticker: str = "ticker") -> DataFrame:
    """Every ticker's bars as one frame, the ticker taken from the partition (A3).

    A ticker filter prunes partitions: only the wanted directories are listed.
    """
    df = spark.read.option("basePath", path).parquet(path)
    return df.where(F.col(ticker).isin(list(tickers))) if tickers is not None else df


def rename_for_table(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """Lower-case column names, with explicit overrides."""
    overrides = overrides or {}
    return df.toDF(*[overrides.get(c, c.lower()) for c in df.columns])


def write_dataset(df: DataFrame, path: str, name: str | None = None, single_file: bool = False,
                  mode: str = "overwrite", max_records: int = 0) -> dict:
    """Write parquet and report columns, rows and path (A5).

    ``single_file`` is meant for small outputs: the finished rows go through one
    more exchange into one file, so the work before it keeps its own tasks.
    ``max_records`` bounds the rows of a file (0: no bound).
    """
    obs = Observation(name or "write")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    (observed.repartition(1) if single_file else observed).write.mode(mode).option("maxRecordsPerFile", max_records).parquet(path)
    return {"name": name or path, "path": path, "columns": list(df.columns), "rows": obs.get["rows"]}


def read_jdbc_query(spark: SparkSession, options: dict[str, str], query: str) -> DataFrame:
    """Push a query to the database and read its result (A4)."""
    return spark.read.format("jdbc").options(**options).option("query", query).load()


def load_jdbc(df: DataFrame, table: str, options: dict[str, str], writers: int = JDBC_WRITERS,
              batch: int = JDBC_BATCH) -> int:
    """Replace a table's rows, keeping its DDL and constraints; return the committed count.

    ``repartition`` caps the concurrent writers but not the tasks of the work
    before them; ``truncate`` keeps
    the table definition instead of dropping and re-creating it. The count is
    asked of the database, and read by position (some databases upper-case
    unquoted aliases).
    """
    (
        df.repartition(writers).write.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("batchsize", str(batch))
        .option("truncate", "true")
        .mode("overwrite")
        .save()
    )
    landed = read_jdbc_query(df.sparkSession, options, f"SELECT count(*) AS n FROM {table}")
    return int(landed.first()[0])


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """The first rows, for a look (A14); with ``order`` always the same ones."""
    return (df.orderBy(*order) if order else df).limit(n)
