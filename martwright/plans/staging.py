"""Staging: cleaned customers and orders, as lazy views over the raw tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.dates import age_calendar_years, age_completed_years
from martwright.functions.keys import pii_hash
from martwright.functions.money import PRICE, gross_amount, tax_amount, total_amount
from martwright.functions.text import title_case, upper_trim

AGES = {"completed": age_completed_years, "calendar": age_calendar_years}
SMALL_QUANTITY, SMALL_PRICE = 1000, 100_000  # their total has 9 digits, an amount holds 10
STATUS_CASES = {"title": title_case, "upper": upper_trim}


def stage_customers(
    raw: DataFrame, as_of: dt.date | str, age: str = "completed", salt: str | None = None
) -> DataFrame:
    """Clean country and region, hash e-mail and phone, derive the age on the day ``as_of``."""
    today = F.lit(as_of).cast("date")
    return raw.select(
        "customer_id",
        "customer_full_name",
        pii_hash(F.col("customer_email"), salt).alias("customer_email_hash"),
        F.col("customer_email").alias("customer_email_raw"),
        pii_hash(F.col("customer_phone"), salt).alias("customer_phone_hash"),
        F.col("customer_phone").alias("customer_phone_raw"),
        upper_trim(F.col("country")).alias("country"),
        upper_trim(F.col("region")).alias("region"),
        "gender",
        AGES[age](F.col("date_of_birth"), today).alias("customer_age"),
        "date_of_birth",
        "created_at",
        "updated_at",
    )


def _valid_quantity() -> Column:
    return F.col("quantity") > 0


def _valid_price() -> Column:
    return F.col("unit_price") >= 0


def _dated() -> Column:
    return F.col("order_date").isNotNull()


def _fits() -> Column:
    """The total is the largest amount, so the others fit if it does.

    Usual orders are too small by far to have a total that does not; only others are computed.
    """
    quantity, price = F.col("quantity"), F.col("unit_price")
    small = (quantity <= SMALL_QUANTITY) & (price <= SMALL_PRICE)
    return F.when(small, F.lit(True)).otherwise(total_amount(quantity, price).isNotNull())


def stage_orders(raw: DataFrame, status_case: str = "title") -> DataFrame:
    """Valid orders with clean labels and their amounts.

    ``status_case="title"`` gives the spelling the marts are checked against, ``"upper"`` capitals.
    """
    quantity, price = F.col("quantity"), F.col("unit_price")
    return raw.filter(_valid_quantity() & _valid_price() & _dated() & _fits()).select(
        "order_id",
        "customer_id",
        "order_date",
        STATUS_CASES[status_case](F.col("order_status")).alias("order_status"),
        title_case(F.col("payment_method")).alias("payment_method"),
        "product_category",
        "product_description",
        "quantity",
        price.cast(PRICE).alias("unit_price"),
        gross_amount(quantity, price).alias("gross_amount"),
        tax_amount(quantity, price).alias("tax_amount"),
        total_amount(quantity, price).alias("total_amount"),
        upper_trim(F.col("region")).alias("region"),
        "created_at",
    )


def rejected_orders(raw: DataFrame) -> DataFrame:
    """The orders that staging leaves out, each with its first reason."""

    def fails(rule: Column) -> Column:
        return ~F.coalesce(rule, F.lit(False))

    reason = (
        F.when(fails(_valid_quantity()), "quantity")
        .when(fails(_valid_price()), "unit_price")
        .when(fails(_dated()), "order_date")
        .when(fails(_fits()), "amount")
    )
    return raw.withColumn("reject_reason", reason).filter(F.col("reject_reason").isNotNull())
