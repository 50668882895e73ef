"""Integer surrogate keys in key order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.sources.tables import ensure_checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in these bits


def with_sequence_key(
    df: DataFrame, key: str, name: str, start: int = 1, partitions: int | None = None
) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` by ascending ``key``, which should be unique.

    A window ordered over the whole table would sort all rows in one task. Here the rows are
    range-partitioned and sorted in parallel and numbered within each partition; that state is
    checkpointed, as partition numbers must not change between the two uses. Then one count per
    partition (a few thousand numbers) gives each partition its offset.
    """
    ensure_checkpoint_dir(df.sparkSession)
    by_range = (
        df.repartitionByRange(partitions, key) if partitions else df.repartitionByRange(key)
    )
    local = by_range.sortWithinPartitions(key).withColumn("_id", F.monotonically_increasing_id())
    stored = local.select(
        "*",
        F.shiftright("_id", _ROW_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    ).drop("_id").checkpoint()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per partition of the table above: small whatever the data, so safe to broadcast.
    numbered = stored.join(F.broadcast(offsets), "_part")
    position = F.col("_offset") + F.col("_row") + F.lit(start)
    return numbered.select(position.cast("bigint").alias(name), *df.columns)


def with_shared_sequence_key(df: DataFrame, key: str, name: str, start: int = 1) -> DataFrame:
    """Number the distinct values of ``key``; rows that share one share its number.

    Rows without a key get 0. The numbers are joined to the rows by key, so no row is dropped or
    doubled.
    """
    values = df.select(F.col(key).alias("_natural")).filter("_natural IS NOT NULL").distinct()
    numbers = with_sequence_key(values, "_natural", "_number", start)
    numbered = df.join(numbers, F.col(key) == F.col("_natural"), "left")
    number = F.when(F.col(key).isNull(), F.lit(0).cast("bigint")).otherwise(F.col("_number"))
    return numbered.select(number.alias(name), *(df[c] for c in df.columns))
