import pytest
from conftest import customer, order, plan_of
from pyspark.sql import functions as F

from martwright.operators import access
from martwright.plans.marts import build_dim_customers, build_fct_orders
from martwright.plans.staging import stage_customers, stage_orders
from martwright.sources.tables import refresh_table

ENGINEER, UK, EU, OTHER = "DATA_ENGINEER", "DATA_ANALYST_UK", "DATA_ANALYST_EU", "ACCOUNTADMIN"


@pytest.fixture
def marts(customers, orders):
    raw = customers(
        customer("C1"),
        customer("C2", region="EU", customer_email="_odd@x.org"),
        customer("C3", region=None),
    )
    dim = build_dim_customers(stage_customers(raw, "2024-01-01"))
    placed = orders(
        order("O1", "C1"), order("O2", "C2", region="EU"), order("O3", "C3", region=None)
    )
    return {"dim_customers": dim, "fct_orders": build_fct_orders(stage_orders(placed), dim)}


@pytest.mark.parametrize(
    "role, ids", [(ENGINEER, ["1", "2", "3"]), (UK, ["1"]), (EU, ["2"]), (OTHER, [])]
)
def test_rows_by_role(marts, role, ids):
    seen = access.secure(marts["dim_customers"], "dim_customers", role)
    assert sorted(r["customer_id"] for r in seen.collect()) == [f"C{i}" for i in ids]
    seen = access.secure(marts["fct_orders"], "fct_orders", role)
    assert sorted(r["order_id"] for r in seen.collect()) == [f"O{i}" for i in ids]


def test_masks_by_role(marts):
    dim = marts["dim_customers"]
    columns = ["customer_email", "customer_phone", "customer_full_name"]

    def shown(role, id_, strict=True):
        masked = access.mask_columns(dim, "dim_customers", role, strict)
        return tuple(masked.filter(F.col("customer_id") == id_).select(*columns).first())

    assert shown(ENGINEER, "C1") == ("john.smith@gmail.com", "+44 7123 456 7890", "John Smith")
    assert shown(UK, "C1") == ("j***@gmail.com", "+44 *** *** 7890", "J***")
    assert shown(EU, "C2")[0] == "***"
    assert shown(EU, "C2", strict=False)[0] == "_odd@x.org"
    assert shown(OTHER, "C1") == ("***", "***", "***")


def test_other_roles_see_the_hidden_value_even_for_null(spark, customers):
    dim = build_dim_customers(
        stage_customers(customers(customer("C1", customer_phone=None)), "2024-01-01")
    )
    masked = access.mask_columns(dim, "dim_customers", OTHER)
    assert masked.first()["customer_phone"] == "***"
    assert access.mask_columns(dim, "dim_customers", UK).first()["customer_phone"] is None


def test_layers(marts):
    dim = marts["dim_customers"]
    for table in ("raw_customers", "stg_orders"):
        for role in (UK, OTHER):
            with pytest.raises(access.AccessDenied):
                access.secure(dim, table, role)
        assert access.secure(dim, table, ENGINEER).count() == 3


def test_views(spark, marts):
    tables = {"raw_customers": marts["dim_customers"]} | marts
    assert access.register_views(tables, ENGINEER) == ["raw_customers", "dim_customers", "fct_orders"]
    assert access.register_views(tables, UK) == ["dim_customers", "fct_orders"]
    assert not spark.catalog.tableExists("raw_customers")
    got = spark.sql(
        "SELECT d.customer_email, f.order_id FROM dim_customers d JOIN fct_orders f"
        " ON d.customer_key = f.customer_key"
    ).collect()
    assert [tuple(r) for r in got] == [("j***@gmail.com", "O1")]


def test_policy_report_names_every_region(customers):
    raw = customers(*(customer(f"C{i}", region=r) for i, r in enumerate(["UK", "UK", "EU", "US", "FR", None])))
    dim = build_dim_customers(stage_customers(raw, "2024-01-01"))
    got = access.policy_report(dim, "dim_customers", [ENGINEER, UK, EU, OTHER]).collect()
    assert sorted(map(str, (tuple(r)[1:] for r in got))) == sorted(
        map(str, [
            (ENGINEER, "UK", 2), (ENGINEER, "EU", 1), (ENGINEER, "US", 1), (ENGINEER, "FR", 1),
            (ENGINEER, None, 1), (UK, "UK", 2), (EU, "EU", 1), (OTHER, None, 0),
        ])
    )
    assert {r["table_name"] for r in got} == {"dim_customers"}


def test_masked_sample(marts):
    got = access.masked_sample(marts["dim_customers"], "dim_customers", UK, 5, "customer_id")
    assert [r["customer_full_name"] for r in got.collect()] == ["J***"]
    assert got.columns == [
        "role", "customer_id", "customer_email", "customer_phone", "customer_full_name",
    ]


@pytest.mark.parametrize(
    "table, column", [("dim_customers", "region"), ("fct_orders", "order_region")]
)
def test_the_row_filter_reaches_the_scan(spark, marts, tmp_path, table, column):
    path = str(tmp_path / table)
    refresh_table(marts[table], path)
    plan = plan_of(access.secure(spark.read.parquet(path), table, UK))
    assert f"EqualTo({column},UK)" in plan


@pytest.mark.parametrize(
    "table, column", [("dim_customers", "region"), ("fct_orders", "order_region")]
)
def test_the_row_filter_picks_the_folder(spark, marts, tmp_path, table, column):
    path = str(tmp_path / table)
    refresh_table(marts[table], path, column)
    seen = access.secure(spark.read.parquet(path), table, UK)
    line = next(x for x in plan_of(seen).splitlines() if "PartitionFilters" in x)
    assert f"({column}" in line and "= UK)" in line
    assert seen.count() == 1


def test_a_role_without_rows_reads_nothing(spark, marts, tmp_path):
    path = str(tmp_path / "t")
    refresh_table(marts["fct_orders"], path)
    plan = plan_of(access.secure(spark.read.parquet(path), "fct_orders", OTHER))
    assert "LocalTableScan" in plan or "EmptyRelation" in plan
    assert "Scan parquet" not in plan
