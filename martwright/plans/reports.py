"""Reports over the marts (amounts with tax) and over the raw tables (value without tax).

Cancelled and refunded orders count in every report. Each report is ordered by its key figure,
with ties broken by its labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.domain import REGIONS
from martwright.functions.dates import month_key
from martwright.functions.money import (
    mean_amount,
    net_value,
    quantity_bucket,
    quantity_bucket_rank,
)
from martwright.functions.text import label
from martwright.operators.distributions import count_by, top, with_percent
from martwright.operators.joins import lookup, orphans
from martwright.sources.tables import table_counts


def _mean(amount: str) -> Column:
    return mean_amount(F.sum(amount), F.count(amount))


# Over the marts.


def revenue_by_region(fct: DataFrame) -> DataFrame:
    return (
        fct.groupBy("order_region")
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("quantity").alias("total_items_sold"),
            F.sum("gross_amount").alias("gross_revenue"),
            F.sum("tax_amount").alias("tax_collected"),
            F.sum("total_amount").alias("total_revenue"),
            _mean("total_amount").alias("avg_order_value"),
        )
        .orderBy("order_region")
    )


def revenue_by_category_and_region(fct: DataFrame) -> DataFrame:
    return (
        fct.groupBy("product_category", "order_region")
        .agg(
            F.count("*").alias("order_count"),
            F.sum("quantity").alias("items_sold"),
            F.sum("total_amount").alias("revenue"),
            _mean("total_amount").alias("avg_order_value"),
        )
        .orderBy(F.desc("revenue"), "product_category", "order_region")
    )


def spend_per_customer(fct: DataFrame) -> DataFrame:
    """The fact reduced to one row per customer key.

    Joining this instead of the orders means that a customer with very many orders is summed up
    in the map tasks and reaches the join as a single row.
    """
    return fct.groupBy("customer_key").agg(
        F.count("order_id").alias("_orders"),
        F.sum("total_amount").alias("_spend"),
        F.count("total_amount").alias("_amounts"),
        F.max("total_amount").alias("_largest"),
        F.max("order_date").alias("_last"),
    )


_PARTS = {"_orders": F.sum, "_spend": F.sum, "_amounts": F.sum, "_largest": F.max}


def customer_spend(dim: DataFrame, fct: DataFrame) -> DataFrame:
    """Spend per country and region.

    The joined rows lie by customer key already, so they are reduced to a row per customer without
    a shuffle; a key stands for one customer id, so these rows are the distinct customers.
    """
    spend = spend_per_customer(fct)
    who = ["customer_key", "customer_id", "country", "region"]
    return (
        lookup(spend, dim.select(*who), "customer_key")
        .groupBy(*who)
        .agg(*(f(c).alias(c) for c, f in _PARTS.items()))
        .groupBy("country", "region")
        .agg(
            F.count("customer_id").alias("unique_customers"),
            F.sum("_orders").alias("total_orders"),
            F.sum("_spend").cast("decimal(32,2)").alias("total_spend"),
            mean_amount(F.sum("_spend"), F.sum("_amounts")).alias("avg_spend_per_order"),
            F.max("_largest").alias("largest_order"),
        )
        .orderBy(F.desc("total_spend"), "country", "region")
    )


def top_customers(dim: DataFrame, fct: DataFrame, rows: int = 10) -> DataFrame:
    """The customers who spent most."""
    who = ["customer_id", "customer_full_name", "country", "region", "customer_age"]
    totals = (
        lookup(spend_per_customer(fct), dim.select("customer_key", *who), "customer_key")
        .groupBy("customer_key", *who)
        .agg(
            F.sum("_orders").alias("total_orders"),
            F.sum("_spend").cast("decimal(32,2)").alias("total_spend"),
            mean_amount(F.sum("_spend"), F.sum("_amounts")).alias("avg_order_value"),
            F.max("_last").alias("last_order_date"),
        )
        .drop("customer_key")
    )
    return top(totals, "total_spend", "customer_id", rows)


def monthly_revenue(fct: DataFrame) -> DataFrame:
    return (
        fct.groupBy(month_key(F.col("order_date")).alias("month"), "order_region")
        .agg(F.count("*").alias("orders"), F.sum("total_amount").alias("revenue"))
        .orderBy("month", "order_region")
    )


def status_distribution(fct: DataFrame) -> DataFrame:
    groups = fct.groupBy("order_status").agg(
        F.count("*").alias("order_count"), F.sum("total_amount").alias("revenue")
    )
    shares = with_percent(groups, "order_count", "pct_of_total")
    return shares.select("order_status", "order_count", "pct_of_total", "revenue").orderBy(
        F.desc("order_count"), "order_status"
    )


def orphan_orders(dim: DataFrame, fct: DataFrame) -> DataFrame:
    """Orders whose customer key is not in the dimension; there should be none."""
    ids = fct.select("order_id", "customer_id", "customer_key")
    return orphans(ids, dim, "customer_key", "customer_key").select(
        "order_id", "customer_id", "customer_key"
    )


def hierarchy_counts(
    raw_customers: DataFrame, raw_orders: DataFrame, dim: DataFrame, fct: DataFrame
) -> DataFrame:
    return table_counts(
        {
            "raw_customers": raw_customers,
            "raw_orders": raw_orders,
            "dim_customers (mart)": dim,
            "fct_orders (mart)": fct,
        }
    )


# Over the raw tables.


def customers_by(raw_customers: DataFrame, column: str) -> DataFrame:
    """Customers per region, country or gender, most frequent first."""
    return count_by(raw_customers, label(raw_customers, column), column, "customers")


def gender_shares(raw_customers: DataFrame) -> DataFrame:
    groups = raw_customers.groupBy(label(raw_customers, "gender").alias("gender")).agg(
        F.count("*").alias("customers")
    )
    return with_percent(groups, "customers", "pct_of_total").orderBy(
        F.desc("customers"), "gender"
    )


def top_countries(raw_customers: DataFrame, rows: int = 10) -> DataFrame:
    counts = raw_customers.groupBy("country").agg(F.count("*").alias("customers"))
    return top(counts, "customers", "country", rows)


def orders_by(raw_orders: DataFrame, column: str) -> DataFrame:
    """Orders per status or payment method, most frequent first."""
    return count_by(raw_orders, label(raw_orders, column), column, "orders")


def _net_revenue(places: int = 2) -> Column:
    return F.round(F.sum(net_value(F.col("quantity"), F.col("unit_price"))), places)


def net_revenue_by_region(raw_orders: DataFrame) -> DataFrame:
    return (
        raw_orders.groupBy("region")
        .agg(F.count("*").alias("orders"), _net_revenue().alias("net_revenue"))
        .orderBy("region")
    )


def net_revenue_by_category(raw_orders: DataFrame, rows: int | None = None) -> DataFrame:
    """Orders and value per category, by number of orders; ``rows`` keeps the largest only."""
    name = label(raw_orders, "product_category").alias("product_category")
    totals = raw_orders.groupBy(name).agg(
        F.count("*").alias("orders"), _net_revenue().alias("net_revenue")
    )
    if rows is not None:
        return top(totals, "orders", "product_category", rows)
    return totals.orderBy(F.desc("orders"), "product_category")


def _month() -> Column:
    """An order without a date counts under an empty month."""
    return F.coalesce(month_key(F.col("order_date")), F.lit("")).alias("month")


def net_revenue_by_month(raw_orders: DataFrame) -> DataFrame:
    return (
        raw_orders.groupBy(_month(), "region")
        .agg(_net_revenue().alias("net_revenue"))
        .orderBy("month", "region")
    )


def net_revenue_by_month_pivot(raw_orders: DataFrame) -> DataFrame:
    """A column per region, 0 where a month has none, and the total of these regions."""
    wide = raw_orders.groupBy(_month()).pivot("region", list(REGIONS)).agg(_net_revenue())
    sums = [F.coalesce(F.col(region), F.lit(0).cast("decimal(31,2)")) for region in REGIONS]
    named = [s.alias(f"{region.lower()}_revenue") for s, region in zip(sums, REGIONS)]
    return wide.select("month", *named, sum(sums[1:], sums[0]).alias("total_revenue")).orderBy(
        "month"
    )


def months(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.select(_month()).distinct().orderBy("month")


def quantity_histogram(raw_orders: DataFrame) -> DataFrame:
    """Orders per quantity bucket, from the smallest bucket to the largest."""
    counts = raw_orders.groupBy(quantity_bucket(F.col("quantity")).alias("bucket")).agg(
        F.count("*").alias("orders")
    )
    position = quantity_bucket_rank(F.col("bucket")).alias("position")
    return counts.select(position, "bucket", "orders").orderBy("position")


def kpis(raw_customers: DataFrame, raw_orders: DataFrame) -> DataFrame:
    """Customers, orders, value and value per order (0 without orders), in one row.

    Both tables are reduced to one row before the rows are put together.
    """
    none, no_money = F.lit(0).cast("bigint"), F.lit(0).cast("decimal(31,2)")
    buyers = raw_customers.agg(F.count("*").alias("customers")).select(
        "customers", none.alias("orders"), no_money.alias("revenue")
    )
    sales = raw_orders.agg(
        none.alias("customers"),
        F.count("*").alias("orders"),
        F.coalesce(_net_revenue(), no_money).cast("decimal(31,2)").alias("revenue"),
    )
    totals = buyers.unionByName(sales).agg(
        F.sum("customers").alias("total_customers"),
        F.sum("orders").alias("total_orders"),
        F.sum("revenue").cast("decimal(31,2)").alias("total_revenue"),
    )
    per_order = F.coalesce(
        F.round(F.col("total_revenue") / F.nullif(F.col("total_orders"), F.lit(0)), 2),
        F.lit(0),
    )
    return totals.withColumn("avg_order_value", per_order.cast("decimal(31,2)"))


# All distributions in one pass.


def _distributions(df: DataFrame, labels: dict[str, Column], sets: dict[str, list[str]], *measures: Column) -> DataFrame:
    """(distribution, label, label_2, ...measures): several groupings of one table, from one scan.

    Spark repeats a row per grouping in the map task and combines it there, so what is shuffled is a row
    per group and task. A group whose label is null keeps it; the grouping id tells it from a label
    that is not part of the grouping. An empty table has no rows, not even a total.
    """
    named = df.select("*", *(c.alias(f"_{name}") for name, c in labels.items()))
    order = list(labels)
    groupings = [[F.col(f"_{label}") for label in asked] for asked in sets.values()]
    grouped = named.groupingSets(groupings, *(F.col(f"_{label}") for label in order))
    ids = F.grouping_id(*(f"_{label}" for label in order)).alias("_id")
    found = grouped.agg(ids, *measures)
    parts = F

    def number(asked: list[str]) -> int:
        """The grouping id has a bit for each label that is left out, the first label's highest."""
        return sum(1 << (len(order) - 1 - i) for i, label in enumerate(order) if label not in asked)

    for name, asked in sets.items():
        row = F.struct(
            F.lit(name).alias("distribution"),
            (F.col(f"_{asked[0]}").cast("string") if asked else F.lit(None).cast("string")).alias("label"),
            (F.col(f"_{asked[1]}").cast("string") if len(asked) > 1 else F.lit(None).cast("string")).alias("label_2"),
        )
        parts = parts.when(F.col("_id") == number(asked), row)
    values = [c for c in found.columns if c not in {"_id", *(f"_{label}" for label in order)}]
    return found.select(parts.alias("_row"), *values).select("_row.*", *values)


def order_distributions(raw_orders: DataFrame) -> DataFrame:
    """Orders and value by region, category, status, payment, quantity, month and region, and in total.

    One scan of the orders gives what the single reports give: (distribution, label, label_2, orders,
    net_revenue).
    """
    labels = {
        "region": F.col("region"),
        "category": label(raw_orders, "product_category"),
        "status": label(raw_orders, "order_status"),
        "payment": label(raw_orders, "payment_method"),
        "bucket": quantity_bucket(F.col("quantity")),
        "month": _month(),
    }
    sets = {
        "region": ["region"],
        "product_category": ["category"],
        "order_status": ["status"],
        "payment_method": ["payment"],
        "quantity": ["bucket"],
        "month": ["month", "region"],
        "all": [],
    }
    return _distributions(raw_orders, labels, sets, F.count("*").alias("orders"), _net_revenue().alias("net_revenue"))


def customer_distributions(raw_customers: DataFrame) -> DataFrame:
    """Customers by region, country and gender, and in total, from one scan: (distribution, label, customers)."""
    labels = {name: label(raw_customers, name) for name in ("region", "country", "gender")}
    sets = {**{name: [name] for name in labels}, "all": []}
    return _distributions(raw_customers, labels, sets, F.count("*").alias("customers")).drop("label_2")


# Distinct buyers from states that can be merged.


def buyer_states(fct: DataFrame, bits: int = 12) -> DataFrame:
    """(order_date, order_region, orders, buyers): per day and region a sketch of its buyers.

    A state has a fixed size of a few kilobytes, however many orders a day has, and is merged with others
    at read time; the relative standard error is about 1.04 / sqrt(2 ** bits).
    """
    return fct.groupBy("order_date", "order_region").agg(
        F.count("*").alias("orders"), F.hll_sketch_agg("customer_key", F.lit(bits)).alias("buyers")
    )


def distinct_buyers(states: DataFrame, first: str, last: str) -> DataFrame:
    """Orders and an estimate of the distinct buyers per region, in a span of days; the fact is not read."""
    span = states.filter(F.col("order_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return span.groupBy("order_region").agg(
        F.sum("orders").alias("orders"), F.hll_sketch_estimate(F.hll_union_agg("buyers")).alias("buyers")
    )


def exact_buyers(fct: DataFrame, first: str, last: str) -> DataFrame:
    """The same from the fact itself, exactly."""
    span = fct.filter(F.col("order_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return span.groupBy("order_region").agg(F.count("*").alias("orders"), F.countDistinct("customer_key").alias("buyers"))
