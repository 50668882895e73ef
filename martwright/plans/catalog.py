"""The stored tables in Spark's catalog, with the descriptions of tables and columns and their keys.

Each table is a view over the folders of the version that is read: queries keep their pushed filters
and pruned columns, and an older version may be shown next to the latest in another database. A refresh
is followed by ``register``, which replaces the views with their comments; nothing is copied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from martwright.plans.build import SCHEMAS, Warehouse
from martwright.sources.schemas import TABLE_NOTES, known_rows

PRIMARY = {"raw_customers": "customer_id", "raw_orders": "order_id", "dim_customers": "customer_key", "fct_orders": "order_key"}
FOREIGN = {"raw_orders": {"customer_id": "raw_customers.customer_id"}, "fct_orders": {"customer_key": "dim_customers.customer_key"}}


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _properties(table: str) -> str:
    keys = {f"key.{PRIMARY[table]}": "primary"} | {f"key.{c}": f"references {parent}" for c, parent in FOREIGN.get(table, {}).items()}
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in keys.items())


def register(warehouse: Warehouse, database: str = "mart") -> list[str]:
    """Show the stored tables of the warehouse's version in a database of the catalog; their names."""
    spark, shown = warehouse.spark, []
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    folders = warehouse.versions.folders(warehouse.version)
    for table in SCHEMAS:
        if not folders.get(table):
            continue
        df = warehouse.rows(table, folders[table])
        columns = ", ".join(f"`{f.name}` COMMENT {_text(f.metadata['comment'])}" for f in df.schema)
        names = ", ".join(f"`{c}`" for c in df.columns)
        rows = " UNION ALL ".join(f"SELECT {names} FROM parquet.`{path}`" for path in folders[table])
        spark.sql(
            f"CREATE OR REPLACE VIEW `{database}`.`{table}` ({columns}) COMMENT {_text(TABLE_NOTES[table])} "
            f"TBLPROPERTIES ({_properties(table)}) AS {rows}"
        )
        shown.append(table)
    return shown


def dictionary(spark: SparkSession, database: str = "mart", tables: Sequence[str] | None = None) -> DataFrame:
    """One row per column, from the catalog alone: types, descriptions and keys.

    ``key`` is "primary", "references <table>.<column>" or null.
    """
    rows = []
    for table in sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary):
        if tables is not None and table not in tables:
            continue
        name = f"`{database}`.`{table}`"
        keys = {r["key"][4:]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect() if r["key"].startswith("key.")}
        note = spark.catalog.getTable(f"{database}.{table}").description
        for position, column in enumerate(spark.catalog.listColumns(f"{database}.{table}"), start=1):
            rows.append((table, note, position, column.name, column.dataType, column.description, keys.get(column.name)))
    return spark.createDataFrame(
        rows,
        "table_name string, table_description string, position int, column_name string,"
        " data_type string, description string, key string",
    )


def known_values(spark: SparkSession, database: str, tables: Sequence[str]) -> DataFrame:
    """(table_name, column_name, known_rows) of the tables as the catalog shows them."""
    return known_rows({table: spark.table(f"`{database}`.`{table}`") for table in tables})
