"""Marts in buckets of the customer key, for star joins that do not shuffle the fact.

Both marts are catalog tables with the same number of buckets, so Spark joins bucket with bucket as they
lie. Inside a bucket file the rows are sorted by region and day, so a role's filter still skips row
groups by their statistics. A customer's orders lie in one bucket; choose the number of buckets so that
the largest customer fits a task, or leave the marts unbucketed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SORTED_BY = {"dim_customers": ["region"], "fct_orders": ["order_region", "order_date"]}
KEY = "customer_key"


def store_buckets(marts: dict[str, DataFrame], database: str, folder: str, buckets: int) -> None:
    """Store both marts as bucketed tables of the catalog, replacing those of before."""
    spark = next(iter(marts.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for table, order in SORTED_BY.items():
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
        _writer(marts[table], table, order, buckets).option("path", f"{folder.rstrip('/')}/{table}").mode("overwrite").saveAsTable(f"{database}.{table}")


def _writer(df: DataFrame, table: str, order: list[str], buckets: int):
    # A task per bucket: one file each, and no task holds more than a bucket.
    return df.repartition(buckets, KEY).write.format("parquet").bucketBy(buckets, KEY).sortBy(*order)


def append_buckets(table: str, df: DataFrame, database: str, buckets: int) -> None:
    """Add rows to a bucketed mart; its buckets get further files, and stay buckets."""
    _writer(df, table, SORTED_BY[table], buckets).mode("append").saveAsTable(f"{database}.{table}")


def read_buckets(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    return {table: spark.table(f"`{database}`.`{table}`") for table in SORTED_BY}
