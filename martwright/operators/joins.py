"""Key lookups and missing keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    """Inner join by key; rows without a match drop out.

    There is no broadcast hint: Spark broadcasts a dimension whose measured size is below its
    threshold, and otherwise sorts and merges, where adaptive execution splits the partition of a
    customer with very many orders.
    """
    return fact.join(dimension, on, "inner")


def frequent_keys(rows: DataFrame, key: str, share: float = 0.01) -> dict:
    """{key: about how many rows have it} of the keys that hold at least ``share`` of all rows.

    A bounded frequency sketch finds them in one pass: 40 / share keys are tracked per task, whatever the
    input. Its counts are off by a tenth of the share at most; the split is for speed, and gives the same
    rows whichever keys it is done for.
    """
    asked = int(1 / share) + 1
    top = F.call_function("approx_top_k", F.col(key), F.lit(asked), F.lit(max(1000, 40 * asked)))
    found = rows.agg(top.alias("top"), F.count("*").alias("n")).first()
    return {r["item"]: r["count"] for r in found["top"] or [] if r["item"] is not None and r["count"] >= share * found["n"]}


def split_lookup(fact: DataFrame, dimension: DataFrame, on: str, share: float = 0.01, parts: int = 16) -> DataFrame:
    """The rows of ``lookup``, with the rows of frequent keys dealt to ``parts`` tasks each.

    Keys that hold at least ``share`` of the fact are found beforehand; their fact rows get a number
    below ``parts``, and the few dimension rows of such keys are repeated for each number. Other rows
    join as they would. No setting of the session is needed, and nothing is broadcast.
    """
    hot = list(frequent_keys(fact, on, share))
    if not hot:
        return lookup(fact, dimension, on)
    number, frequent = "_part", F.col(on).isin(hot)
    spread = F.pmod(F.xxhash64(*fact.columns), F.lit(parts)).cast("int")
    dealt = fact.withColumn(number, F.when(frequent, spread).otherwise(0))
    numbers = F.when(frequent, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    repeated = dimension.withColumn(number, F.explode(numbers))
    # The part must be hashed alone for a hot key to come to several tasks, so it is part of the key.
    return dealt.join(repeated, [on, number], "inner").drop(number)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows without a parent; a null key is reported too, as it has none."""
    parents = parent.select(F.col(parent_key).alias(child_key))
    return child.join(parents, child_key, "left_anti").select(*child.columns)


def orphan_keys(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str
) -> DataFrame:
    """Keys without a parent and their row counts.

    The child is reduced to one row per key before the join, so a key that many rows share costs
    no more than any other.
    """
    per_key = child.groupBy(child_key).agg(F.count("*").alias("rows"))
    return orphans(per_key, parent, child_key, parent_key)
