"""Explicit schemas of the raw and mart tables. Nothing is inferred."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PRICE = T.DecimalType(10, 2)
_AMOUNT = T.DecimalType(12, 2)


def _schema(*fields: tuple[str, T.DataType, str]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True, {"comment": text}) for n, t, text in fields])


RAW_CUSTOMERS = _schema(
    ("customer_id", T.StringType(), "Id the source gives a customer"),
    ("customer_full_name", T.StringType(), "Full name (personal data)"),
    ("customer_email", T.StringType(), "E-mail address (personal data)"),
    ("customer_phone", T.StringType(), "Phone number (personal data)"),
    ("country", T.StringType(), "Country of residence"),
    ("region", T.StringType(), "UK or EU; decides who may see the row"),
    ("gender", T.StringType(), "M or F"),
    ("date_of_birth", T.DateType(), "Birth date (personal data)"),
    ("created_at", T.TimestampType(), "When the record was created"),
    ("updated_at", T.TimestampType(), "When the record last changed"),
)

RAW_ORDERS = _schema(
    ("order_id", T.StringType(), "Natural key of the order"),
    ("customer_id", T.StringType(), "Id of the buyer, matches raw_customers"),
    ("order_date", T.DateType(), "Calendar day of the order; undated orders are rejected"),
    ("order_status", T.StringType(), "Stage of the order, spelled as delivered"),
    ("payment_method", T.StringType(), "Means of payment, spelled as delivered"),
    ("product_category", T.StringType(), "Category of the product"),
    ("product_description", T.StringType(), "Product"),
    ("quantity", T.IntegerType(), "Number of items; orders without a positive one are rejected"),
    ("unit_price", _PRICE, "Pounds for one item; negative ones are rejected"),
    ("region", T.StringType(), "UK or EU; decides who may see the row"),
    ("created_at", T.TimestampType(), "When the record was created"),
)

DIM_CUSTOMERS = _schema(
    ("customer_key", T.StringType(), "md5 of the natural key, or a number from 1 with integer keys"),
    ("customer_id", T.StringType(), "Id the source gives a customer"),
    ("customer_full_name", T.StringType(), "Full name (masked by role)"),
    ("customer_email", T.StringType(), "E-mail address (masked by role)"),
    ("customer_phone", T.StringType(), "Phone number (masked by role)"),
    ("country", T.StringType(), "Country of residence"),
    ("region", T.StringType(), "UK or EU; decides who may see the row"),
    ("gender", T.StringType(), "M or F"),
    ("customer_age", T.IntegerType(), "Whole years on the day of the build, null without a birth date"),
    ("date_of_birth", T.DateType(), "Birth date (personal data, off by default)"),
    ("customer_since", T.DateType(), "Day the customer record was created"),
    ("updated_at", T.TimestampType(), "When the record last changed"),
)

FCT_ORDERS = _schema(
    ("order_key", T.StringType(), "md5 of the natural key, or a number from 1 with integer keys"),
    ("order_id", T.StringType(), "Natural key of the order"),
    ("customer_key", T.StringType(), "Key of the customer dimension"),
    ("customer_id", T.StringType(), "Id the source gives a customer"),
    ("order_date", T.DateType(), "Calendar day of the order; undated orders are rejected"),
    ("order_status", T.StringType(), "Stage of the order, spelled as delivered"),
    ("payment_method", T.StringType(), "Means of payment, spelled as delivered"),
    ("product_category", T.StringType(), "Category of the product"),
    ("product_description", T.StringType(), "Product"),
    ("quantity", T.IntegerType(), "Items ordered"),
    ("unit_price", _PRICE, "Price of one item in GBP"),
    ("gross_amount", _AMOUNT, "Price without tax, rounded half up to pence"),
    ("tax_amount", _AMOUNT, "Tax rounded half up to pence"),
    ("total_amount", _AMOUNT, "Price with tax, rounded once from the unrounded product"),
    ("order_region", T.StringType(), "UK or EU; decides who may see the row"),
    ("created_at", T.TimestampType(), "When the record was created"),
)


TABLE_NOTES = {
    "raw_customers": "Customers as the source systems deliver them, one row each",
    "raw_orders": "Orders as the source systems deliver them, one row each",
    "stg_customers": "Cleaned customers with hashed contact data and derived age",
    "stg_orders": "Valid orders with clean labels and derived amounts",
    "dim_customers": "Customer dimension, one row per customer; masked and filtered by role",
    "fct_orders": "Order fact, one row per order; filtered by role",
}


def columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema]


def document(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Attach the column descriptions of ``schema`` to the columns that ``df`` shares with it."""
    notes = {field.name: field.metadata for field in schema}
    return df.select(*[F.col(c).alias(c, metadata=notes.get(c, {})) for c in df.columns])


def data_dictionary(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column: its table, position, name, type and descriptions, from the schemas."""
    rows = [
        (
            table,
            TABLE_NOTES.get(table),
            position,
            f.name,
            f.dataType.simpleString(),
            f.metadata.get("comment"),
        )
        for table, df in tables.items()
        for position, f in enumerate(df.schema, start=1)
    ]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(
        rows,
        "table_name string, table_description string, position int, column_name string,"
        " data_type string, description string",
    )


def known_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column: how many rows of its table have a value; one pass over each table."""
    parts = []
    for table, df in tables.items():
        counts = df.agg(*(F.count(F.col(c)).alias(c) for c in df.columns))
        rows = [F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("known_rows")) for c in df.columns]
        parts.append(counts.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionAll, parts)
