"""Raw customers and orders, derived from the provided ``customer``, ``nation`` and ``orders``.

Keys, the buyer of an order, its date, status and price, and a customer's country come from the
tables; the attributes these do not have are drawn from the keys. ``dirty=True`` puts in defects by a rule
on the key; the expressions below are SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.plans.marts import build_dim_customers, build_fct_orders
from martwright.plans.staging import stage_customers, stage_orders
from martwright.sources.synthetic import customers_from, orders_from
from martwright.sources.tables import read_table

AS_OF = "2025-01-01"

CUSTOMER_CYCLE, ORDER_CYCLE = 97, 89

# column -> (remainder of the key, value)
CUSTOMER_DEFECTS = {
    "customer_id": [(47, "NULL")],
    "customer_full_name": [(11, "'Émile Zola'"), (12, "NULL"), (14, "'7th Customer'")],
    "customer_email": [
        (3, "''"),
        (5, "'nobody.example.com'"),
        (7, "'_x@y.com'"),
        (9, "'a@b@c.com'"),
        (41, "NULL"),
    ],
    "customer_phone": [
        (13, "'07123 456789'"),
        (15, "'call +44 7123 456 7890 now'"),
        (43, "NULL"),
    ],
    "country": [(23, "NULL"), (24, "''"), (25, "' nation_3 '")],
    "region": [(17, "' uk '"), (19, "NULL"), (21, "'US'")],
    "gender": [(27, "NULL")],
    "date_of_birth": [
        (29, "DATE '2000-02-29'"),
        (31, "DATE '2008-01-01'"),
        (33, "DATE '2007-01-02'"),
        (35, "DATE '2007-01-01'"),
        (37, "DATE '1923-12-31'"),
        (39, "NULL"),
    ],
    "created_at": [(53, "NULL")],
}
ORDER_DEFECTS = {
    "order_id": [(47, "NULL")],
    "customer_id": [(23, "'CUST-X'"), (43, "NULL")],
    "order_date": [(13, "NULL")],
    "order_status": [(17, "'Lost'"), (19, "' delivered '"), (21, "NULL")],
    "payment_method": [(29, "' apple-pay '"), (30, "NULL")],
    "product_category": [(33, "NULL")],
    "product_description": [(34, "'CUSHION, \"RED\"'"), (36, "''"), (38, "' padded '")],
    "quantity": [(3, "0"), (5, "NULL"), (6, "1001"), (83, "2000000")],
    "unit_price": [
        (7, "CAST(-0.01 AS DECIMAL(10,2))"),
        (11, "NULL"),
        (41, "CAST(0.01 AS DECIMAL(10,2))"),
        (42, "CAST(0.00 AS DECIMAL(10,2))"),
        (83, "CAST(99999999.99 AS DECIMAL(10,2))"),  # no amount can hold the total
    ],
    "region": [(31, "'eu '"), (37, "'US'"), (39, "NULL")],
}
FACT_DEFECTS = {
    "total_amount": [
        (1, "total_amount + CAST(0.03 AS DECIMAL(12,2))"),
        (2, "total_amount + CAST(0.02 AS DECIMAL(12,2))"),
        (4, "NULL"),
    ],
}
STATUS_OF = {"F": "Delivered", "O": "Pending", "P": "Shipped"}
DUPLICATE_REMAINDER = 59  # rows with this remainder come twice, a day apart


def defect_sql(column: str, defects: dict, number: str, cycle: int) -> str:
    cases = " ".join(
        f"WHEN {number} % {cycle} = {rest} THEN {value}" for rest, value in defects[column]
    )
    return f"CASE {cases} ELSE {column} END"


def _spoil(df: DataFrame, defects: dict, number: str, cycle: int) -> DataFrame:
    df = df.withColumns(
        {c: F.expr(defect_sql(c, defects, number, cycle)).cast(df.schema[c].dataType) for c in defects}
    )
    twice = F.col(number) % cycle == DUPLICATE_REMAINDER
    copies = F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    later = F.expr("created_at + make_dt_interval(_copy - 1)")
    return df.withColumn("_copy", F.explode(copies)).withColumn("created_at", later).drop("_copy")


SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz",
}


def scan(spark: SparkSession, folder: str, table: str, *columns: str) -> DataFrame:
    return read_table(spark, f"{folder}/{table}.parquet", SCHEMAS[table], columns)


# (folder, table, dirty) -> where a benchmark has stored the raw table, so that it is not derived again.
STORED: dict[tuple[str, str, bool], str] = {}


def _stored(spark: SparkSession, folder: str, table: str, dirty: bool) -> DataFrame | None:
    path = STORED.get((folder, table, dirty))
    return path and read_table(spark, path)


def store_raw(spark: SparkSession, folder: str, to: str) -> None:
    """Derive the raw tables, with and without defects, and read them from ``to`` from now on."""
    for dirty in (False, True):
        for table, df in raw(spark, folder, dirty).items():
            path = f"{to}/{table}-{'dirty' if dirty else 'clean'}"
            df.write.parquet(path)
            STORED[folder, table, dirty] = path


def raw_customers(spark: SparkSession, folder: str, dirty: bool = False) -> DataFrame:
    if known := _stored(spark, folder, "raw_customers", dirty):
        return known
    customer = scan(spark, folder, "customer", "c_custkey", "c_nationkey")
    nation = scan(spark, folder, "nation", "n_nationkey", "n_name")
    numbers = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    if not dirty:
        return _customers(numbers)
    return _spoiled(numbers, "c_custkey", CUSTOMER_DEFECTS, CUSTOMER_CYCLE, _customers)


def raw_orders(spark: SparkSession, folder: str, dirty: bool = False) -> DataFrame:
    if known := _stored(spark, folder, "raw_orders", dirty):
        return known
    orders = scan(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    if not dirty:
        return _orders(orders)
    return _spoiled(orders, "o_orderkey", ORDER_DEFECTS, ORDER_CYCLE, _orders)


def numbered_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Clean raw orders with their number ``n``."""
    orders = scan(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return _orders(orders, "o_orderkey").withColumnRenamed("o_orderkey", "n")


def _customers(numbers: DataFrame, *keep: str) -> DataFrame:
    return customers_from(numbers, "c_custkey", country=F.col("n_name"), keep=keep)


def _orders(numbers: DataFrame, *keep: str) -> DataFrame:
    """Buyer, day, status and a thousandth of the price come from the table."""
    day, given = F.to_date("o_orderdate"), F.col("o_orderstatus")
    status = F.coalesce(*(F.when(given == k, v) for k, v in STATUS_OF.items()), given)
    pence = F.floor(F.col("o_totalprice") / 10)
    return orders_from(numbers, "o_orderkey", F.col("o_custkey"), day, keep=keep, status=status, pence=pence)


def _spoiled(numbers: DataFrame, number: str, defects: dict, cycle: int, build) -> DataFrame:
    return _spoil(build(numbers, number), defects, number, cycle).drop(number)


def raw(spark: SparkSession, folder: str, dirty: bool = False) -> dict[str, DataFrame]:
    return {
        "raw_customers": raw_customers(spark, folder, dirty),
        "raw_orders": raw_orders(spark, folder, dirty),
    }


def staging(
    spark: SparkSession, folder: str, dirty: bool = False, status_case: str = "title"
) -> dict[str, DataFrame]:
    tables = raw(spark, folder, dirty)
    return {
        "stg_customers": stage_customers(tables["raw_customers"], AS_OF),
        "stg_orders": stage_orders(tables["raw_orders"], status_case),
    }


def dim_customers(spark: SparkSession, folder: str, dirty: bool = False) -> DataFrame:
    return build_dim_customers(stage_customers(raw_customers(spark, folder, dirty), AS_OF))


def marts(spark: SparkSession, folder: str, dirty: bool = False) -> dict[str, DataFrame]:
    dim = dim_customers(spark, folder, dirty)
    orders = stage_orders(raw_orders(spark, folder, dirty))
    return {"dim_customers": dim, "fct_orders": build_fct_orders(orders, dim)}


def spoiled_fact(fct: DataFrame) -> DataFrame:
    """The fact with totals that do not add up; the number is the one in the order's id."""
    number = F.substring("order_id", 5, 20).cast("bigint")
    spoiled = fct.withColumn("_n", F.coalesce(number, F.lit(0)))
    value = F.expr(defect_sql("total_amount", FACT_DEFECTS, "_n", ORDER_CYCLE))
    return spoiled.withColumn("total_amount", value.cast("decimal(12,2)")).drop("_n")
