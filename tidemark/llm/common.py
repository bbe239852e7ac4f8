"""Helpers shared by the training-data operators: tables, packed rows, durable intermediate tables."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Packed original row, so that no helper column can clash with a column of the caller.
ROW = "__row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, by a path that only Spark needs to be able to read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a session that names none gets a folder of its own, and only in local
    mode, where driver and executors are one process.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="tidemark-shared-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage in storage that outlives executors: a lost executor
    costs the running tasks, never what was computed before this point.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written = path  # for release()
    return table


def release(written: DataFrame) -> None:
    """Delete the files of a :func:`materialise` table that no later plan reads."""
    spark = written.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(written._written)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``task`` for ``mapInArrow`` without pauses for cyclic garbage, after which its process gives freed memory back to the system.

    The tasks make many small objects and no cycles, over which the collector
    would go again and again.  A Python worker outlives its task and waits for
    others; what its allocators keep would be missing in the next operator's budget.
    """

    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        try:
            yield from task(batches)
        finally:
            gc.enable()
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim is not None:
                trim(0)

    return run


def packed(docs: DataFrame, **helpers: Column) -> DataFrame:
    """Each row as one struct ``__row`` beside helper columns; ``select("__row.*")`` undoes it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW), *[c.alias(k) for k, c in helpers.items()])


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def by_rank(group: list[str], *order: Column) -> Column:
    return F.row_number().over(Window.partitionBy(*group).orderBy(*order))
