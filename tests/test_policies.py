"""Masks and row policies as SQL functions, and tables in the catalog."""

import pytest
from conftest import customer, order, plan_of

from martwright.operators import policies
from martwright.operators.access import secure
from martwright.plans import build, catalog
from martwright.plans.marts import build_dim_customers, build_fct_orders
from martwright.plans.staging import stage_customers, stage_orders
from martwright.sources.schemas import DIM_CUSTOMERS

DAY = "2024-06-01"
ROLES = ["DATA_ENGINEER", "DATA_ANALYST_UK", "DATA_ANALYST_EU", "SYSADMIN", "it's", ""]


@pytest.fixture
def marts(customers, orders):
    odd = ["_x@y.com", "a@b@c.com", "x\ny@z.com", "", None, "plain"]
    people = [customer(f"C{i}", customer_email=e, region=("UK", "eu", None)[i % 3], customer_full_name=("Émile", "7th", None)[i % 3]) for i, e in enumerate(odd)]
    people += [customer("C7", customer_phone=" +44 7123 456 7890 "), customer("C8", customer_phone="call +44 7123 456 7890 now"), customer("C9", customer_phone=None)]
    dim = build_dim_customers(stage_customers(customers(*people), DAY))
    sales = orders(order("O1", "C0"), order("O2", "C1", region="EU"), order("O3", "C2", region=None), order("O4", "C7"))
    return {"dim_customers": dim, "fct_orders": build_fct_orders(stage_orders(sales), dim)}


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("role", ROLES)
def test_functions_show_what_secure_shows(spark, marts, role, strict):
    policies.register_functions(marts)
    shown = role.replace("'", "\\'")
    for table, df in marts.items():
        got = spark.sql(f"SELECT * FROM secured_{table}('{shown}', {str(strict).lower()})")
        assert got.columns == df.columns and rows(got) == rows(secure(df, table, role, strict)), table


def test_masks_are_strict_unless_asked_otherwise(spark, marts):
    assert "mask_email" in policies.register_functions(marts)
    call = "SELECT {}"
    one = lambda text: spark.sql(call.format(text)).first()[0]
    assert one("mask_email('_x@y.com', 'DATA_ANALYST_UK')") == "***"
    assert one("mask_email('_x@y.com', 'DATA_ANALYST_UK', false)") == "_x@y.com"
    assert one("mask_phone('+44 7123 456 7890', 'DATA_ANALYST_EU')") == "+44 *** *** 7890"
    assert one("mask_full_name('Ada', 'DATA_ENGINEER')") == "Ada" and one("mask_full_name('Ada', null)") == "***"
    assert one("may_see('UK', 'DATA_ANALYST_UK')") and not one("may_see(null, 'DATA_ANALYST_UK')")


def test_a_role_is_a_filter_in_the_scan(spark, marts, tmp_path):
    stored = {}
    for table, df in marts.items():
        df.write.parquet(str(tmp_path / table))
        stored[table] = spark.read.parquet(str(tmp_path / table))
    policies.register_functions(stored)
    plan = plan_of(spark.sql("SELECT order_id FROM secured_fct_orders('DATA_ANALYST_UK') WHERE total_amount > 1"))
    assert "EqualTo(order_region,UK)" in plan and "DATA_ANALYST" not in plan
    schema = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "order_id" in schema and "payment_method" not in schema
    assert "EqualTo(region,EU)" in plan_of(spark.sql("SELECT customer_email FROM secured_dim_customers('DATA_ANALYST_EU')"))
    nobody = spark.sql("SELECT * FROM secured_fct_orders('SYSADMIN')")
    assert "Scan parquet" not in plan_of(nobody) and nobody.count() == 0


def test_the_catalog_describes_the_stored_tables(spark, tmp_path, customers, orders):
    warehouse = build.Warehouse(spark, str(tmp_path))
    build.load_raw(warehouse, customers(customer("C1")), orders(order("O1")))
    build.build_marts(warehouse, DAY)
    assert len(catalog.register(warehouse, "described")) == 4

    def described():
        found = catalog.dictionary(spark, "described").filter("table_name = 'dim_customers'").orderBy("position").collect()
        return [(r["column_name"], r["data_type"], r["description"]) for r in found]

    first = described()
    assert [c for c, _, _ in first] == [f.name for f in DIM_CUSTOMERS if f.name != "date_of_birth"]
    assert all(text == next(f.metadata["comment"] for f in DIM_CUSTOMERS if f.name == c) for c, _, text in first)
    build.add_raw(warehouse, customers(customer("C2")), orders(order("O2", "C2"), order("O3")))
    build.add_to_marts(warehouse, DAY)
    catalog.register(warehouse, "described")
    assert described() == first and spark.table("described.fct_orders").count() == 3
    keys = {(r["table_name"], r["column_name"]): r["key"] for r in catalog.dictionary(spark, "described").collect() if r["key"]}
    assert keys["fct_orders", "order_key"] == "primary" and keys["fct_orders", "customer_key"] == "references dim_customers.customer_key"
    plan = plan_of(spark.sql("SELECT order_id FROM described.fct_orders WHERE order_region = 'UK'"))
    assert plan.count("EqualTo(order_region,UK)") == 2 and "product_description" not in plan  # two folders
    catalog.register(warehouse.at(2), "described_before")
    assert spark.table("described_before.fct_orders").count() == 1
