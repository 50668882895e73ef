"""Loading rows into a keyed table without repeating a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_counts(batch: DataFrame, key: str) -> DataFrame:
    """(key, ``_rows``): the keys of a batch and how many rows have each; nothing for rows without a key."""
    return batch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))


def first_per_key(batch: DataFrame, key: str, order_by: Sequence[str], repeated: DataFrame | None = None) -> DataFrame:
    """One whole row per key: the first by ``order_by``, ties broken by the other columns.

    A row without a value to order by counts as the latest, as a load time not given is now.
    Rows without a key are left out, as a primary key admits none; the not-null checks count them.

    The keys are counted first, and only they are shuffled. Rows whose key occurs once pass through;
    whole rows are compared only for the repeated keys, by an aggregate of which every map task
    keeps one row per key, so a key with very many copies does not fill a single task. Repeated
    keys are broadcast while their measured size allows. A caller that has them stored gives them as
    ``repeated``, of one column: their size is then known before rows are shuffled for the join.
    """
    present = batch.filter(F.col(key).isNotNull())
    if repeated is None:
        repeated = key_counts(batch, key).filter("_rows > 1").select(key)
    repeated = repeated.toDF("_key")
    on = present[key] == repeated["_key"]
    rest = [c for c in batch.columns if c not in order_by]
    undated = [F.col(c).isNull().alias(f"_no_{c}") for c in order_by]
    row = F.struct(*undated, *order_by, *rest)
    copies = present.join(repeated, on, "left_semi").groupBy(F.col(key).alias("_key"))
    firsts = copies.agg(F.min(row).alias("_row")).select("_row.*").select(*batch.columns)
    return present.join(repeated, on, "left_anti").select(*batch.columns).unionByName(firsts)


FEW_KEYS = 1000  # keys that are asked for by value


def keys_present(target: DataFrame, key: str, asked: DataFrame, by_value: bool = False) -> DataFrame:
    """The rows' ``key`` of those keys in ``asked`` that the target has.

    With ``by_value`` the keys are looked at first. Up to FEW_KEYS of them become a filter by value that
    reaches the scan: row groups whose statistics or Bloom filter rule all of them out are not opened.
    More become a range of values, as statistics know it, before the join by key.
    """
    if by_value:
        keys = [r[0] for r in asked.limit(FEW_KEYS + 1).collect()]
        if len(keys) <= FEW_KEYS:
            return target.select(key).filter(F.col(key).isin(keys))
        low, high = asked.agg(F.min(key), F.max(key)).first()
        target = target.filter(F.col(key).between(low, high))
    return target.select(key).join(asked, key, "left_semi")


def rows_to_insert(
    batch: DataFrame, target: DataFrame, key: str, order_by: Sequence[str], by_value: bool = False
) -> DataFrame:
    """The rows of ``batch`` that an insert skipping existing keys would add to ``target``.

    The target gives only its key column, and first only the keys that occur in the batch; rows of
    keys it has are left out before copies are compared. For the usual batch, far smaller than the
    table, Spark broadcasts the batch's keys if their measured size allows, and the table is scanned
    without being shuffled. A large batch falls back to sort-merge joins on the key. ``by_value`` looks at
    the batch's keys first, which pays where the batch is stored and the target has Bloom filters.
    """
    asked = batch.select(key).filter(F.col(key).isNotNull()).distinct()
    present = keys_present(target, key, asked, by_value)
    absent = batch.join(present, key, "left_anti").select(*batch.columns)
    return first_per_key(absent, key, order_by)


def insert_if_absent(
    batch: DataFrame, target: DataFrame, key: str, order_by: Sequence[str]
) -> DataFrame:
    """``target`` after the insert, as a DataFrame; existing rows are kept as they are."""
    return target.unionByName(rows_to_insert(batch, target, key, order_by))
