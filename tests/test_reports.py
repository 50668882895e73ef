"""Each report against plain Python over a small table with skew, gaps and ties."""

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import customer, order
from pyspark.sql import functions as F

from martwright.plans import reports
from martwright.plans.marts import build_dim_customers, build_fct_orders
from martwright.plans.staging import stage_customers, stage_orders

CENT = Decimal("0.01")


def half_up(x, unit=CENT):
    return Decimal(x).quantize(unit, ROUND_HALF_UP)


@pytest.fixture(scope="module")
def data(spark):
    from martwright.sources.schemas import RAW_CUSTOMERS, RAW_ORDERS

    rng = random.Random(7)
    people = [
        customer(
            f"C{i:03d}",
            country=rng.choice(["France", "Ireland", "Spain"]),
            region=rng.choice(["UK", "EU"]),
            gender=rng.choice(["M", "F", None]),
        )
        for i in range(40)
    ]
    sales = []
    for i in range(600):
        # A third of all orders come from one customer; some customers have left.
        buyer = "C007" if i % 3 == 0 else f"C{rng.randrange(45):03d}"
        sales.append(
            order(
                f"O{i:04d}",
                buyer,
                order_date=dt.date(2022 + rng.randrange(2), 1 + rng.randrange(12), 5),
                order_status=rng.choice(["Pending", "Shipped", "Delivered"]),
                payment_method=rng.choice(["PayPal", "Apple Pay", None]),
                product_category=rng.choice(["Toys", "Garden", None]),
                quantity=rng.choice([1, 2, 5, 12, 20, 48]),
                unit_price=Decimal(rng.randrange(1, 2000)) / 100,
                region=rng.choice(["UK", "EU"]),
            )
        )
    raw_customers = spark.createDataFrame(people, RAW_CUSTOMERS)
    raw_orders = spark.createDataFrame(sales, RAW_ORDERS)
    dim = build_dim_customers(stage_customers(raw_customers, "2024-01-01"))
    fct = build_fct_orders(stage_orders(raw_orders), dim)
    known = {p[0]: p for p in people}
    names = [f.name for f in RAW_ORDERS]
    rows = [dict(zip(names, s)) for s in sales]
    for r in rows:
        r["net"] = r["quantity"] * r["unit_price"]
        r["total"] = half_up(r["net"] * Decimal("1.2"))
        r["tax"] = half_up(r["net"] * Decimal("0.2"))
    kept = [r for r in rows if r["customer_id"] in known]
    return {
        "raw_customers": raw_customers, "raw_orders": raw_orders, "dim": dim, "fct": fct,
        "people": known, "rows": rows, "kept": kept,
    }


def tuples(df):
    return [tuple(r) for r in df.collect()]


def grouped(rows, key):
    groups = defaultdict(list)
    for r in rows:
        groups[key(r)].append(r)
    return groups


def test_revenue_by_region(data):
    want = []
    for region, rows in sorted(grouped(data["kept"], lambda r: r["region"]).items()):
        total = sum(r["total"] for r in rows)
        want.append(
            (
                region, len(rows), sum(r["quantity"] for r in rows), sum(r["net"] for r in rows),
                sum(r["tax"] for r in rows), total, half_up(total / len(rows)),
            )
        )
    assert tuples(reports.revenue_by_region(data["fct"])) == want


def test_revenue_by_category_and_region(data):
    got = tuples(reports.revenue_by_category_and_region(data["fct"]))
    groups = grouped(data["kept"], lambda r: (r["product_category"], r["region"]))
    assert {g[:2] for g in got} == set(groups)
    for category, region, n, items, revenue, mean in got:
        rows = groups[category, region]
        total = sum(r["total"] for r in rows)
        assert (n, items, revenue) == (len(rows), sum(r["quantity"] for r in rows), total)
        assert mean == half_up(total / n)
    assert [g[4] for g in got] == sorted((g[4] for g in got), reverse=True)


def test_customer_spend(data):
    people = data["people"]

    def home(r):
        return people[r["customer_id"]][4].upper(), people[r["customer_id"]][5]

    groups = grouped(data["kept"], home)
    want = []
    for (country, region), rows in groups.items():
        total = sum(r["total"] for r in rows)
        want.append(
            (
                country, region, len({r["customer_id"] for r in rows}), len(rows), total,
                half_up(total / len(rows)), max(r["total"] for r in rows),
            )
        )
    want.sort(key=lambda w: (-w[4], w[0], w[1]))
    assert tuples(reports.customer_spend(data["dim"], data["fct"])) == want


def test_top_customers(data):
    want = []
    for id_, rows in grouped(data["kept"], lambda r: r["customer_id"]).items():
        total = sum(r["total"] for r in rows)
        p = data["people"][id_]
        want.append(
            (
                id_, p[1], p[4].upper(), p[5], 43, len(rows), total, half_up(total / len(rows)),
                max(r["order_date"] for r in rows),
            )
        )
    want.sort(key=lambda w: (-w[6], w[0]))
    got = tuples(reports.top_customers(data["dim"], data["fct"]))
    assert got == want[:10] and got[0][0] == "C007"


def test_customers_with_the_same_attributes_are_one_group(spark, customers, orders):
    """Two dimension rows of one customer count its orders twice, as the join does."""
    dim = build_dim_customers(stage_customers(customers(customer("C1"), customer("C1")), "2024-01-01"))
    one = dim.dropDuplicates(["customer_id"])
    fct = build_fct_orders(stage_orders(orders(order("O1"))), one)
    got = reports.top_customers(dim, fct).first()
    assert (got["total_orders"], got["total_spend"]) == (2, Decimal("6.00"))
    spend = reports.customer_spend(dim, fct).first()
    assert (spend["unique_customers"], spend["total_orders"]) == (1, 2)


def test_monthly_revenue(data):
    groups = grouped(data["kept"], lambda r: (r["order_date"].strftime("%Y-%m"), r["region"]))
    want = [(*k, len(v), sum(r["total"] for r in v)) for k, v in sorted(groups.items())]
    assert tuples(reports.monthly_revenue(data["fct"])) == want


def test_status_distribution(data):
    groups = grouped(data["kept"], lambda r: r["order_status"])
    n = len(data["kept"])
    want = [
        (k, len(v), half_up(Decimal(100 * len(v)) / n, Decimal("0.1")), sum(r["total"] for r in v))
        for k, v in sorted(groups.items(), key=lambda kv: (-len(kv[1]), kv[0]))
    ]
    assert tuples(reports.status_distribution(data["fct"])) == want


def test_orphans(data):
    assert reports.orphan_orders(data["dim"], data["fct"]).count() == 0
    fewer = data["dim"].filter(F.col("customer_id") != "C007")
    got = {r["order_id"] for r in reports.orphan_orders(fewer, data["fct"]).collect()}
    assert got == {r["order_id"] for r in data["kept"] if r["customer_id"] == "C007"}
    assert len(got) >= 200


def test_hierarchy_counts(data):
    got = tuples(
        reports.hierarchy_counts(data["raw_customers"], data["raw_orders"], data["dim"], data["fct"])
    )
    assert got == [
        ("dim_customers (mart)", 40), ("fct_orders (mart)", len(data["kept"])),
        ("raw_customers", 40), ("raw_orders", 600),
    ]


@pytest.mark.parametrize("column, position", [("region", 5), ("country", 4), ("gender", 6)])
def test_customers_by(data, column, position):
    counts = Counter(p[position] for p in data["people"].values())
    got = tuples(reports.customers_by(data["raw_customers"], column))
    assert dict(got) == dict(counts)
    assert [n for _, n in got] == sorted(counts.values(), reverse=True)


def test_customers_by_a_column_the_table_lacks(data):
    assert tuples(reports.customers_by(data["raw_customers"], "tier")) == [("Unknown", 40)]


def test_gender_shares(data):
    got = tuples(reports.gender_shares(data["raw_customers"]))
    assert sum(n for _, n, _ in got) == 40
    assert all(p == half_up(Decimal(100 * n) / 40, Decimal("0.1")) for _, n, p in got)


def test_top_countries(data):
    counts = Counter(p[4] for p in data["people"].values())
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:2]
    assert tuples(reports.top_countries(data["raw_customers"], 2)) == want


@pytest.mark.parametrize("column", ["order_status", "payment_method"])
def test_orders_by(data, column):
    counts = Counter(r[column] for r in data["rows"])
    assert dict(tuples(reports.orders_by(data["raw_orders"], column))) == dict(counts)


def test_net_revenue(data):
    by_region = grouped(data["rows"], lambda r: r["region"])
    assert tuples(reports.net_revenue_by_region(data["raw_orders"])) == [
        (k, len(v), sum(r["net"] for r in v)) for k, v in sorted(by_region.items())
    ]
    by_category = grouped(data["rows"], lambda r: r["product_category"])
    got = tuples(reports.net_revenue_by_category(data["raw_orders"]))
    assert sorted(got, key=str) == sorted(
        ((k, len(v), sum(r["net"] for r in v)) for k, v in by_category.items()), key=str
    )
    assert tuples(reports.net_revenue_by_category(data["raw_orders"], rows=1)) == got[:1]


def test_net_revenue_by_month(data):
    groups = grouped(data["rows"], lambda r: (r["order_date"].strftime("%Y-%m"), r["region"]))
    want = {k: sum(r["net"] for r in v) for k, v in groups.items()}
    got = tuples(reports.net_revenue_by_month(data["raw_orders"]))
    assert {g[:2]: g[2] for g in got} == want and got == sorted(got)
    wide = tuples(reports.net_revenue_by_month_pivot(data["raw_orders"]))
    for month, uk, eu, total in wide:
        assert (uk, eu) == (want.get((month, "UK"), 0), want.get((month, "EU"), 0))
        assert total == uk + eu
    months = sorted({m for m, _ in want})
    assert [w[0] for w in wide] == months == [m for m, in tuples(reports.months(data["raw_orders"]))]


def test_pivot_keeps_months_without_the_regions(spark, orders):
    raw = orders(order("O1", region="US"), order("O2", order_date=None, region="UK"))
    assert tuples(reports.net_revenue_by_month_pivot(raw)) == [
        ("", Decimal("2.50"), Decimal("0.00"), Decimal("2.50")),
        ("2023-03", Decimal("0.00"), Decimal("0.00"), Decimal("0.00")),
    ]


def test_quantity_histogram(data):
    counts = Counter(r["quantity"] for r in data["rows"])
    assert tuples(reports.quantity_histogram(data["raw_orders"])) == [
        (1, "1", counts[1]), (2, "2-3", counts[2]), (3, "4-6", counts[5]),
        (4, "7-12", counts[12]), (5, "13-24", counts[20]), (6, "25+", counts[48]),
    ]


def test_kpis(data):
    net = sum(r["net"] for r in data["rows"])
    assert tuples(reports.kpis(data["raw_customers"], data["raw_orders"])) == [
        (40, 600, net, half_up(net / 600))
    ]
    none = data["raw_orders"].filter(F.lit(False))
    assert tuples(reports.kpis(data["raw_customers"], none)) == [(40, 0, Decimal(0), Decimal(0))]


REPORT_TYPES = {
    "revenue_by_region": "order_region string, total_orders bigint, total_items_sold bigint, gross_revenue decimal(22,2), tax_collected decimal(22,2), total_revenue decimal(22,2), avg_order_value decimal(14,2)",
    "monthly_revenue": "month string, order_region string, orders bigint, revenue decimal(22,2)",
    "status_distribution": "order_status string, order_count bigint, pct_of_total decimal(6,1), revenue decimal(22,2)",
    "customer_spend": "country string, region string, unique_customers bigint, total_orders bigint, total_spend decimal(32,2), avg_spend_per_order decimal(14,2), largest_order decimal(12,2)",
    "top_customers": "customer_id string, customer_full_name string, country string, region string, customer_age int, total_orders bigint, total_spend decimal(32,2), avg_order_value decimal(14,2), last_order_date date",
}


@pytest.mark.parametrize("name", REPORT_TYPES)
def test_report_types(customers, orders, name):
    dim = build_dim_customers(stage_customers(customers(customer("C1")), "2024-01-01"))
    fct = build_fct_orders(stage_orders(orders(order("O1"))), dim)
    needed = [dim, fct] if name in ("customer_spend", "top_customers") else [fct]
    got = getattr(reports, name)(*needed)
    assert ", ".join(f"{c} {kind}" for c, kind in got.dtypes) == REPORT_TYPES[name]
