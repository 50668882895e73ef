"""Helpers that the corpus operators share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.sources.tables import ensure_checkpoint_dir, scratch_path

DOCUMENT_COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


BATCH_ROWS, TEXTS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", 500
ROOT = str(Path(__file__).resolve().parents[2])


def on_workers(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``run(spark, ...)`` with Python workers that find this package where the driver has it.

    That is enough on one machine; on a cluster the package is sent along with ``--py-files``. Rows
    hold whole texts, so fewer than Spark's default of 10,000 go to a worker at a time, unless the
    session says otherwise; their buffers lie outside the heap.
    """

    @wraps(run)
    def call(spark: SparkSession, *rest) -> DataFrame:
        environment = spark.sparkContext.environment
        known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if ROOT not in known:
            environment["PYTHONPATH"] = os.pathsep.join([ROOT, *known])
        if spark.conf.get(BATCH_ROWS) == "10000":
            spark.conf.set(BATCH_ROWS, str(TEXTS_PER_BATCH))
        return run(spark, *rest)

    return call


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Only doc_id and the whole text; a null text is an empty one, other columns are left out."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))


def text_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once below the shared checkpoint folder, and read back from there.

    Work before it is not repeated by the readers, and survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes and checkpoints within remove their shuffle files when they end, not when the driver collects its garbage."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint, for the small tables of an iteration."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def unused_name(df: DataFrame) -> str:
    """A column name that the table cannot have."""
    return f"_{uuid.uuid4().hex}"


def partitions(df: DataFrame, at_least: int = 1) -> int:
    return max(at_least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


HOT = 2000  # a key of more than a HOT-th of all rows is hot, so there are at most as many hot keys


def looked_up(rows: DataFrame, table: DataFrame, keys: str | list[str], values: str | list[str], weight: str) -> DataFrame:
    """The rows with the table's ``values`` for their keys, null where it has none; null keys are equal.

    The table has a row per key, and ``weight`` says how many rows have that key. Hot keys are joined by
    broadcast, of at most HOT table rows, which should be short; the others meet in a shuffle, in which
    no key has many rows.
    """
    keys, values = ([x] if isinstance(x, str) else x for x in (keys, values))
    own, total = unused_name(rows), table.agg(F.sum(weight)).first()[0] or 0
    named = table.select(*(F.col(k).alias(f"{own}{i}") for i, k in enumerate(keys)), *values, F.col(weight).alias(own))

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        same = [left[k].eqNullSafe(right[f"{own}{i}"]) for i, k in enumerate(keys)]
        return left.join(right, same, "left").drop(*(f"{own}{i}" for i in range(len(keys))))

    hot = F.col(own) * HOT > total
    few = named.where(hot)
    if few.isEmpty():
        return met(rows, named).drop(own)
    first = met(rows, F.broadcast(few))
    found = first.where(F.col(own).isNotNull()).drop(own)
    others = met(first.where(F.col(own).isNull()).drop(own, *values), named.where(~hot)).drop(own)
    return found.unionByName(others)


ROWS_AT_ONCE = 512


def rows_of(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """The columns' values, row by row; few rows at a time are Python objects."""
    for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(begin, ROWS_AT_ONCE)
        yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are Python objects at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(begin, ROWS_AT_ONCE)


def release() -> None:
    """Give the buffers of a task's batches back; Python workers live on and serve other tasks."""
    pa.default_memory_pool().release_unused()
