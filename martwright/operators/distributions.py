"""Counts, shares and sums per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.money import percent


def count_by(df: DataFrame, label: Column, name: str, count: str = "n") -> DataFrame:
    """Rows per label, most frequent first."""
    grouped = df.groupBy(label.alias(name)).agg(F.count("*").alias(count))
    return grouped.orderBy(F.desc(count), name)


def with_percent(groups: DataFrame, count: str, name: str) -> DataFrame:
    """Add each group's share of the sum of ``count``.

    The total is a scalar subquery over the groups. It keeps all their columns, so that both sides
    need the same shuffle and Spark does it once. A window over all groups would gather them in one
    task, which is only small as long as the grouped column is clean.
    """
    kept = [F.max(c).alias(c) for c in groups.columns if c != count]
    total = groups.agg(F.struct(F.sum(count).alias(count), *kept).alias("total")).scalar()
    return groups.withColumn(name, percent(F.col(count), total.getField(count)))


def top(df: DataFrame, by: str, tie_break: str, rows: int) -> DataFrame:
    """The ``rows`` largest; equal values are ordered by ``tie_break``, so the cut is stable.

    Spark keeps that many rows per task and merges them; nothing is sorted as a whole.
    """
    return df.orderBy(F.desc(by), tie_break).limit(rows)
