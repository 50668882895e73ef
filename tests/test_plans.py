"""What the plans must and must not contain, whatever the size of the tables."""

import re
from pathlib import Path

import pytest
from conftest import customer, node_lines, order, plan_of
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from martwright.operators.loading import first_per_key
from martwright.plans import reports
from martwright.plans.marts import build_dim_customers, build_fct_orders
from martwright.plans.staging import stage_customers, stage_orders
from martwright.sources.synthetic import generate
from verification import tables as t

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

def test_only_aggregates_go_to_a_single_partition(spark):
    """Every exchange to one partition carries partial aggregates, never rows."""
    for name in ("kpis", "status_distribution", "quality_report", "policy_report_orders"):
        plan = entry_points.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan()
        lines = plan.toString().splitlines()
        for above, below in zip(lines, lines[1:]):
            if "Exchange SinglePartition" in above:
                assert re.search(r"(Hash|Sort|Object)\w*Aggregate.*partial_", below), (name, below)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("marts")
    for name, df in t.marts(spark, FOLDER).items():
        df.write.parquet(str(folder / name))
    return {n: spark.read.parquet(str(folder / n)) for n in ("dim_customers", "fct_orders")}


def test_spend_is_summed_before_the_join(spark, stored):
    plan = reports.customer_spend(stored["dim_customers"], stored["fct_orders"])
    lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    join = next(i for i, x in enumerate(lines) if "HashJoin" in x or "SortMergeJoin" in x)
    assert any("partial_sum(total_amount" in x for x in lines[join:])
    assert not any("partial_sum(total_amount" in x for x in lines[:join])


def test_top_rows_are_merged_not_sorted(spark, stored):
    plan = plan_of(reports.top_customers(stored["dim_customers"], stored["fct_orders"]))
    assert "TakeOrderedAndProject" in plan and "Sort " not in node_lines(plan)


def test_reports_read_only_their_columns(spark, stored):
    plan = plan_of(reports.revenue_by_region(stored["fct_orders"]))
    schema = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    assert sorted(re.findall(r"(\w+):", schema)) == sorted(
        ["order_region", "quantity", "gross_amount", "tax_amount", "total_amount"]
    )


def final_nodes(df):
    df.collect()
    return [x.strip(" +-:*()0123456789") for x in df._jdf.queryExecution().executedPlan().toString().splitlines()]


def test_a_share_needs_no_second_derivation(spark, stored):
    nodes = final_nodes(reports.status_distribution(stored["fct_orders"]))
    assert sum(x.startswith("ReusedExchange") for x in nodes) >= 1


def test_customer_reports_shuffle_no_more_than_they_must(spark, stored, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    for report, most in ((reports.customer_spend, 4), (reports.top_customers, 2)):
        plan = report(stored["dim_customers"], stored["fct_orders"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") <= most


def test_distinct_customers_with_a_repeated_row(spark, customers, orders):
    dim = build_dim_customers(stage_customers(customers(customer("C1"), customer("C1"), customer("C2")), "2024-01-01"))
    fct = build_fct_orders(stage_orders(orders(order("O1"), order("O2", "C2"))), dim.dropDuplicates(["customer_id"]))
    row = reports.customer_spend(dim, fct).first()
    assert (row["unique_customers"], row["total_orders"]) == (2, 3)


def test_copies_are_dropped_without_shuffling_rows(spark, tmp_path):
    """Rows of keys that occur once are not shuffled while the repeated keys can be broadcast."""
    spark.range(0, 20000).selectExpr("id DIV 1 AS k", "id AS t", "repeat('x', 50) AS wide").union(
        spark.range(0, 5).selectExpr("id AS k", "id + 7 AS t", "'y' AS wide")
    ).write.parquet(str(tmp_path / "t"))
    got = first_per_key(spark.read.parquet(str(tmp_path / "t")), "k", ["t"])
    assert got.count() == 20000
    nodes = got.select("k", "wide")
    nodes.collect()
    plan = nodes._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_numbering_windows_see_one_row_per_partition(spark):
    from martwright.operators.sequence import with_sequence_key

    people, _ = generate(spark, 500, 1)
    numbered = with_sequence_key(people, "customer_id", "key", partitions=6)
    lines = numbered._jdf.queryExecution().executedPlan().toString().splitlines()
    window = next(i for i, x in enumerate(lines) if "Window [" in x)
    assert any("HashAggregate(keys=[_part" in x for x in lines[window:])
    assert numbered.agg(F.max("key")).first()[0] == 500
