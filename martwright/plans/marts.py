"""Marts: the customer dimension and the order fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions.keys import hash_key
from martwright.operators.joins import lookup, split_lookup
from martwright.operators.sequence import with_shared_sequence_key
from martwright.sources.schemas import DIM_CUSTOMERS, FCT_ORDERS, document


def build_dim_customers(
    stg_customers: DataFrame, keys: str = "hash", birth_date: bool = False, start: int = 1
) -> DataFrame:
    """A row for each staged customer that has an id.

    ``keys="sequence"`` numbers the ids from ``start`` in their order instead of hashing them; the
    rows are the same for both. The birth date is left out unless asked for, as the age is what the
    reports need.
    """
    known = stg_customers.filter(F.col("customer_id").isNotNull()).select(
        "customer_id",
        "customer_full_name",
        F.col("customer_email_raw").alias("customer_email"),
        F.col("customer_phone_raw").alias("customer_phone"),
        "country",
        "region",
        "gender",
        "customer_age",
        *(["date_of_birth"] if birth_date else []),
        F.to_date("created_at").alias("customer_since"),
        "updated_at",
    )
    keyed = _keyed(known, "customer_id", "customer_key", keys, start)
    return document(keyed, DIM_CUSTOMERS)


def build_fct_orders(
    stg_orders: DataFrame, dim_customers: DataFrame, keys: str = "hash", start: int = 1, split_share: float | None = None
) -> DataFrame:
    """A row for each staged order and customer of its in the dimension.

    The region is kept on the fact, so a role's row filter needs no join. With ``split_share`` customers
    who hold at least that share of the orders are found first and their orders dealt to several
    tasks, for sessions in which adaptive execution does not split them.
    """
    people = dim_customers.select("customer_id", "customer_key")
    if split_share is None:
        found = lookup(stg_orders, people, "customer_id")
    else:
        found = split_lookup(stg_orders, people, "customer_id", split_share)
    found = found.withColumnRenamed("region", "order_region").select(
        "order_id",
        "customer_key",
        "customer_id",
        "order_date",
        "order_status",
        "payment_method",
        "product_category",
        "product_description",
        "quantity",
        "unit_price",
        "gross_amount",
        "tax_amount",
        "total_amount",
        "order_region",
        "created_at",
    )
    return document(_keyed(found, "order_id", "order_key", keys, start), FCT_ORDERS)


def _keyed(df: DataFrame, natural: str, name: str, keys: str, start: int) -> DataFrame:
    if keys == "sequence":
        return with_shared_sequence_key(df, natural, name, start)
    if keys != "hash":
        raise ValueError(f"keys must be 'hash' or 'sequence', not {keys!r}")
    return df.select(hash_key(F.col(natural)).alias(name), "*")
