"""Queries over drawn attributes against digests taken in plain Python, on rows of the tests' own, in Spark and in SQL."""

import hashlib
from bisect import bisect
from collections import Counter
from itertools import accumulate

import duckdb
import pytest

from martwright import domain
from verification import tables as t
from verification.compare import connect
from verification.oracle import ORACLE
from verification.queries import QUERIES

SPOILT = {t.DUPLICATE_REMAINDER}.union(*({r for r, _ in d} for some in (t.CUSTOMER_DEFECTS, t.ORDER_DEFECTS) for d in some.values()))
BUYERS = [n for n in range(1, 400) if n % t.CUSTOMER_CYCLE not in SPOILT]
SALES = [n for n in range(1, 1500) if n % t.ORDER_CYCLE not in SPOILT]
BUYER_OF = {n: BUYERS[n * 7 % len(BUYERS)] for n in SALES}
PENCE_OF = {n: 100 + n * 13 % 5000 for n in SALES}
YEAR_OF = {n: 1992 + n % 10 for n in SALES}  # from 1999 on, orders are new


def draw(n, attribute, size):
    return int(hashlib.md5(f"{n}/{attribute}".encode()).hexdigest()[:8], 16) % size


def region(n):
    return "UK" if draw(n, "region", 100) < domain.UK_SHARE_PERCENT else "EU"


def gender(n):
    return domain.GENDERS[draw(n, "gender", len(domain.GENDERS))]


def born(n):
    return draw(n, "birth_year", 56) + 1950


def sold(n):
    """Payment, category and quantity."""
    weights = list(accumulate(domain.QUANTITY_WEIGHTS))
    return (
        domain.PAYMENT_METHODS[draw(n, "payment", len(domain.PAYMENT_METHODS))],
        domain.PRODUCT_CATEGORIES[draw(n, "product", 48) // 6],
        domain.QUANTITIES[bisect(weights, draw(n, "quantity", 100))],
    )


def total(n):
    return (PENCE_OF[n] * sold(n)[2] * 120 + 50) // 100


def pounds(groups):
    """(key..., pounds) of pence that were added up by key."""
    return {(*(k if isinstance(k, tuple) else (k,)), pence / 100) for k, pence in groups.items()}


def revenue(key, sales=SALES):
    groups = Counter()
    for n in sales:
        groups[key(n)] += total(n)
    return pounds(groups)


def buyers(*drawn, numbers=BUYERS):
    return {(f"CUST-{n:05d}", *(f(n) for f in drawn)) for n in numbers}


def of(wanted):
    return [n for n in BUYERS if region(n) == wanted]


NEW = [n for n in SALES if YEAR_OF[n] >= 1999]
WHO, DRAWN = "customer_id", ("customer_id", "region", "gender")
SALE = ("order_id", "payment_method", "product_category", "quantity")


def sales(numbers, *more):
    return {(f"ORD-{n:05d}", *sold(n), *(f(n) for f in more)) for n in numbers}


def top(wanted):
    spend = revenue(lambda n: f"CUST-{BUYER_OF[n]:05d}", [n for n in SALES if region(BUYER_OF[n]) == wanted])
    return set(sorted(spend, key=lambda row: (-row[1], row[0]))[:10])


# query -> its columns that depend on draws, and their rows
EXPECTED = {
    "insert_raw_orders": ((*SALE, "region"), lambda: sales(NEW, lambda n: region(BUYER_OF[n]))),
    "insert_raw_customers": (DRAWN, lambda: buyers(region, gender)),
    "insert_dim_customers": (DRAWN, lambda: buyers(region, gender)),
    "insert_fct_orders": (("order_id", "product_category", "quantity", "order_region"), lambda: {(f"ORD-{n:05d}", *sold(n)[1:], region(BUYER_OF[n])) for n in NEW}),
    "synthetic_customers": (DRAWN, lambda: buyers(region, gender)),
    "synthetic_orders": ((*SALE, "region"), lambda: sales(SALES, lambda n: region(draw(n, "buyer", 1000) + 1))),
    "stg_customers_calendar_age": ((WHO, "customer_age"), lambda: buyers(lambda n: 2025 - born(n))),
    "order_amounts": (("order_id", "total_amount"), lambda: revenue(lambda n: f"ORD-{n:05d}")),
    "customer_ages": ((WHO, "calendar_2025"), lambda: buyers(lambda n: 2025 - born(n))),
    "sequence_keys_customers": ((WHO, "region"), lambda: buyers(region)),
    "dim_customers_as_engineer": (DRAWN, lambda: buyers(region, gender)),
    "dim_customers_as_uk_analyst": (DRAWN, lambda: buyers(region, gender, numbers=of("UK"))),
    "dim_customers_as_eu_analyst": (DRAWN, lambda: buyers(region, gender, numbers=of("EU"))),
    "layer_gate": (("table_name", "role", "visible_rows"), lambda: {("dim_customers", role, len(of(r))) for role, r in domain.ANALYST_REGION.items()}),
    "uk_analyst_revenue": (("order_region", "total_revenue"), lambda: revenue(lambda n: region(BUYER_OF[n]), [n for n in SALES if region(BUYER_OF[n]) == "UK"])),
    "eu_analyst_top_customers": ((WHO, "total_spend"), lambda: top("EU")),
    "revenue_by_region": (("order_region", "total_revenue"), lambda: revenue(lambda n: region(BUYER_OF[n]))),
    "revenue_by_category_and_region": (("product_category", "order_region", "revenue"), lambda: revenue(lambda n: (sold(n)[1], region(BUYER_OF[n])))),
    "customer_spend": (("country", "region", "total_spend"), lambda: revenue(lambda n: (f"LAND {BUYER_OF[n] % 5}", region(BUYER_OF[n])))),
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("drawn")

    def write(table, columns, rows):
        duckdb.execute(f"COPY (SELECT * FROM (VALUES {', '.join(map(str, rows))}) AS given({columns})) TO '{at}/{table}.parquet'")

    write("nation", "n_nationkey, n_name", [(i, f"LAND {i}") for i in range(5)])
    write("customer", "c_custkey, c_nationkey", [(n, n % 5) for n in BUYERS])
    prices = [(n, BUYER_OF[n], "F", PENCE_OF[n] * 10 + 3, f"{YEAR_OF[n]}-06-01") for n in SALES]
    write("orders", "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate", prices)
    types = {"nation": "n_nationkey::INT", "customer": "c_custkey::BIGINT c_nationkey::INT"}
    types["orders"] = "o_orderkey::BIGINT o_custkey::BIGINT o_totalprice::DOUBLE o_orderdate::TIMESTAMP"
    for table, casts in types.items():
        changed = ", ".join(f"{c} AS {c.split(':')[0]}" for c in casts.split())
        rows = duckdb.sql(f"SELECT * REPLACE ({changed}) FROM '{at}/{table}.parquet'").arrow().read_all()
        duckdb.register("typed", rows)
        duckdb.execute(f"COPY typed TO '{at}/{table}.parquet'")
    return str(at)


@pytest.mark.parametrize("name", EXPECTED)
def test_drawn_columns_are_digests(spark, folder, name):
    columns, rows = EXPECTED[name]
    expected = rows()
    own = QUERIES[name](spark, folder).select(*columns).collect()
    with connect(folder) as duck:
        sql = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    for got in (own, sql):
        got = {tuple(row) for row in got}
        assert expected <= got if name == "layer_gate" else got == expected
