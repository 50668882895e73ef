"""The whole run: load the raw tables, build and store the marts, check them.

Tables are stored in versions (``martwright.sources.versions``): a load or a build shows its tables
together when all are written, and until then, or if it fails, the tables of before are read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.operators.loading import first_per_key, key_counts, keys_present
from martwright.operators.quality import ChecksFailed, TableChecks, key_checks, observed, run_checks
from martwright.plans.marts import build_dim_customers, build_fct_orders
from martwright.plans.staging import rejected_orders, stage_customers, stage_orders
from martwright.plans.suites import asserted, declared
from martwright.sources.schemas import (
    DIM_CUSTOMERS,
    FCT_ORDERS,
    RAW_CUSTOMERS,
    RAW_ORDERS,
    columns,
    document,
)
from martwright.sources.tables import read_table, scratch_path
from martwright.sources.versions import Versions

SCHEMAS = {
    "raw_customers": RAW_CUSTOMERS,
    "raw_orders": RAW_ORDERS,
    "dim_customers": DIM_CUSTOMERS,
    "fct_orders": FCT_ORDERS,
}
SORTED_BY = {"dim_customers": ["region"], "fct_orders": ["order_region", "order_date"]}
SURROGATE_KEYS = {"dim_customers": "customer_key", "fct_orders": "order_key"}


IDS = {"raw_customers": ["customer_id"], "raw_orders": ["order_id"], "dim_customers": ["customer_id"], "fct_orders": ["order_id"]}
REJECTED = "rejected_orders"  # ids that staging left out, so that no load looks at them again
REJECTED_SCHEMA = "order_id string, reject_reason string"


@dataclass(frozen=True)
class Warehouse:
    """Four Parquet tables below one folder, in versions; an older one is read by its number."""

    spark: SparkSession
    folder: str
    version: int | None = None

    @property
    def versions(self) -> Versions:
        return Versions(self.spark, self.folder)

    def at(self, version: int) -> Warehouse:
        """The tables as they were in a version."""
        return Warehouse(self.spark, self.folder, version)

    def read(self, table: str) -> DataFrame:
        """The stored table with its descriptions; without rows if it was never stored."""
        return self.rows(table, self.versions.folders(self.version).get(table, []))

    def rows(self, table: str, folders: Sequence[str]) -> DataFrame:
        """The rows of some of a table's folders.

        The files say which of the optional columns it has, and of which type its keys are.
        """
        if table == REJECTED:
            return self.spark.read.schema(REJECTED_SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], REJECTED_SCHEMA)
        schema = SCHEMAS[table]
        df = self.spark.read.parquet(*folders) if folders else self.spark.createDataFrame([], schema)
        return document(df.select(*[c for c in columns(schema) if c in df.columns]), schema)

    def tables(self) -> dict[str, DataFrame]:
        folders = self.versions.folders(self.version)
        return {name: self.rows(name, folders.get(name, [])) for name in SCHEMAS}


def _kept(df: DataFrame, name: str) -> DataFrame:
    """The rows, computed once and stored beside the warehouse: keys, of which the size is then known."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def _firsts(batch: DataFrame, key: str, order_by: Sequence[str], counts: DataFrame | None = None) -> DataFrame:
    """The rows of ``first_per_key``, with the repeated keys counted and stored beforehand.

    Joins are planned by their size: without repeated keys there is none, and few are broadcast, so rows
    are neither derived three times nor shuffled before that is known.
    """
    repeated = (key_counts(batch, key) if counts is None else counts).filter("_rows > 1").select(key)
    repeated = _kept(repeated, "repeated")
    if repeated.isEmpty():
        return batch.filter(F.col(key).isNotNull())
    return first_per_key(batch, key, order_by, repeated)


def load_raw(warehouse: Warehouse, customers: DataFrame, orders: DataFrame) -> int:
    """Replace all four tables: raw rows, the first of each key, and empty marts; the new version."""
    versions, base = warehouse.versions, warehouse.versions.latest()
    customers = _firsts(customers, "customer_id", ["created_at"])
    orders = _firsts(orders, "order_id", ["created_at"])
    new = {
        "raw_customers": [versions.write("raw_customers", document(customers, RAW_CUSTOMERS), IDS["raw_customers"])],
        "raw_orders": [versions.write("raw_orders", document(orders, RAW_ORDERS), IDS["raw_orders"])],
        REJECTED: [],
    }
    for table in SORTED_BY:
        new[table] = [versions.write(table, _empty(warehouse, table, "hash"))]
    return versions.publish(base, new)


def add_raw(warehouse: Warehouse, customers: DataFrame, orders: DataFrame) -> int:
    """Append the rows whose keys are new. Running it again with the same rows adds nothing."""
    versions, base, new = warehouse.versions, warehouse.versions.latest(), {}
    for table, batch, key in (
        ("raw_customers", customers, "customer_id"),
        ("raw_orders", orders, "order_id"),
    ):
        fresh = _absent(batch, warehouse.read(table), key)
        new[table] = [versions.write(table, document(fresh, SCHEMAS[table]), IDS[table])]
    return versions.publish(base, {}, new)


def _absent(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The rows of ``rows_to_insert``; the batch's keys are compared with the target's, and whole rows
    are read only once it is known which keys are new."""
    asked = _kept(key_counts(batch, key), "asked")
    present = keys_present(target, key, asked.select(key), by_value=True)
    fresh = _kept(asked.join(present, key, "left_anti"), "fresh")
    rows = batch.join(fresh.select(key), key, "left_semi").select(*batch.columns)
    return _firsts(rows, key, ["created_at"], fresh)


def _staged_raw(warehouse: Warehouse, as_of: dt.date | str, age: str) -> dict:
    return {
        "stg_customers": stage_customers(warehouse.read("raw_customers"), as_of, age),
        "stg_orders": stage_orders(warehouse.read("raw_orders")),
    }


def build_marts(
    warehouse: Warehouse,
    as_of: dt.date | str,
    age: str = "completed",
    keys: str = "hash",
    guard: Sequence[TableChecks] | None = None,
) -> list[tuple]:
    """Replace both marts. The fact reads the stored dimension, so that is computed once.

    With ``guard`` the marts are shown only if they pass its checks; otherwise ``ChecksFailed`` has the
    report, and the marts stay as they were. Rules on single rows are counted while the rows are
    written, without another scan. The report's rows.
    """
    versions, base = warehouse.versions, warehouse.versions.latest()
    stage = _staged_raw(warehouse, as_of, age)
    dim, report = _write(warehouse, "dim_customers", build_dim_customers(stage["stg_customers"], keys), guard)
    known = warehouse.rows("dim_customers", [versions.path(dim)])
    fct, more = _write(warehouse, "fct_orders", build_fct_orders(stage["stg_orders"], known, keys), guard)
    report += more
    if guard:
        new = {"dim_customers": known, "fct_orders": warehouse.rows("fct_orders", [versions.path(fct)])}
        report += key_checks(warehouse.tables() | new, [entry for entry in guard if entry.table in new])
        if any(r[-1] != "PASS" for r in report):
            raise ChecksFailed(report)
    rejected = rejected_orders(warehouse.read("raw_orders")).filter("order_id IS NOT NULL")
    lost = versions.write(REJECTED, rejected.select("order_id", "reject_reason"))
    versions.publish(base, {"dim_customers": [dim], "fct_orders": [fct], REJECTED: [lost]})
    return report


def missing_customers(warehouse: Warehouse) -> DataFrame:
    """Ids of stored customers that the dimension does not have; only ids are read."""
    ids = warehouse.read("raw_customers").select("customer_id").filter("customer_id IS NOT NULL")
    known = warehouse.read("dim_customers").select("customer_id")
    return ids.distinct().join(known, "customer_id", "left_anti")


def missing_orders(warehouse: Warehouse) -> DataFrame:
    """Ids of stored orders that the fact does not have but whose customer the dimension has.

    They are new, or older than their customer. Orders that staging left out before are not looked
    at again, as a stored raw row never changes. Only ids are read.
    """
    return _missing_orders(warehouse, warehouse.read("dim_customers"))


def _missing_orders(warehouse: Warehouse, dim: DataFrame) -> DataFrame:
    raw = warehouse.read("raw_orders").select("order_id", "customer_id")
    absent = raw.join(warehouse.read("fct_orders").select("order_id"), "order_id", "left_anti")
    absent = absent.join(warehouse.read(REJECTED).select("order_id"), "order_id", "left_anti")
    absent = absent.join(dim.select("customer_id"), "customer_id", "left_semi")
    return absent.filter("order_id IS NOT NULL").select("order_id").distinct()


def add_to_marts(
    warehouse: Warehouse, as_of: dt.date | str, age: str = "completed", keys: str | None = None
) -> int:
    """Append the customers and orders that the marts do not hold yet.

    All stored raw rows count, so an order that came before its customer is added once that is
    there. The tables are compared by their ids; what is missing is all that is staged, joined and
    keyed. ``keys`` is that of the stored marts, or "hash" for empty ones; integer keys go on from
    the largest. Asking for another kind fails before anything is written.
    """
    kinds = {t: _key_kind(warehouse, t) for t in SURROGATE_KEYS}
    keys = keys or next((k for k, _ in kinds.values() if k), "hash")
    wrong = [t for t, (kind, _) in kinds.items() if kind not in (None, keys)]
    if wrong:
        raise ValueError(f"{', '.join(wrong)} not keyed by {keys}")
    versions, base = warehouse.versions, warehouse.versions.latest()
    stored = versions.entries()
    # What was stored without rows may have keys of the other type, so it is replaced.
    names = {t: [] if kinds[t][0] is None else list(stored.get(t, [])) for t in SORTED_BY}
    ids = _kept(missing_customers(warehouse), "missing")
    new = warehouse.read("raw_customers").join(ids, "customer_id", "left_semi")
    staged = stage_customers(new, as_of, age)
    dim = _firsts(build_dim_customers(staged, keys, start=kinds["dim_customers"][1]), "customer_id", ["customer_since"])
    names["dim_customers"].append(_write(warehouse, "dim_customers", dim)[0])
    known = warehouse.rows("dim_customers", [versions.path(n) for n in names["dim_customers"]])
    ids = _kept(_missing_orders(warehouse, known), "missing")
    new = warehouse.read("raw_orders").join(ids, "order_id", "left_semi")
    lost = versions.write(REJECTED, rejected_orders(new).select("order_id", "reject_reason"))
    fct = build_fct_orders(stage_orders(new), known, keys, kinds["fct_orders"][1])
    names["fct_orders"].append(_write(warehouse, "fct_orders", _firsts(fct, "order_id", ["created_at"]))[0])
    return versions.publish(base, names, {REJECTED: [lost]})


def _key_kind(warehouse: Warehouse, table: str) -> tuple[str | None, int]:
    """"hash" or "sequence", None for a table without rows, and the next number."""
    keys = warehouse.read(table).select(SURROGATE_KEYS[table])
    if keys.isEmpty():
        return None, 1
    if isinstance(keys.schema[0].dataType, T.StringType):
        return "hash", 1
    return "sequence", keys.agg(F.max(keys.columns[0])).first()[0] + 1


def _sorted(table: str, df: DataFrame) -> DataFrame:
    """Rows in the order of the usual filters inside each file, so scans skip by its statistics."""
    return document(df, SCHEMAS[table]).sortWithinPartitions(*SORTED_BY[table])


def _write(warehouse: Warehouse, table: str, df: DataFrame, guard: Sequence[TableChecks] | None = None) -> tuple[str, list[tuple]]:
    """Rows stored for the next version: their folder, and the results of the row checks of ``guard``."""
    df, results = observed(_sorted(table, df), table, guard or [])
    return warehouse.versions.write(table, df, IDS[table]), results()


def _empty(warehouse: Warehouse, table: str, keys: str) -> DataFrame:
    """The table without rows: its files still say which columns it has."""
    key = T.StringType() if keys == "hash" else T.LongType()
    surrogates = set(SURROGATE_KEYS.values())
    fields = [f for f in SCHEMAS[table] if f.name != "date_of_birth"]
    types = [T.StructField(f.name, key if f.name in surrogates else f.dataType) for f in fields]
    return _sorted(table, warehouse.spark.createDataFrame([], T.StructType(types)))


def check(warehouse: Warehouse, as_of: dt.date | str, age: str = "completed") -> DataFrame:
    """The report of all suites over the stored tables and the staging views."""
    tables = warehouse.tables() | _staged_raw(warehouse, as_of, age)
    return run_checks(tables, declared() + asserted())
