"""Plans and rows of the bucketed star join, split lookups, shared distributions, merged buyer states, and
seeds with bad lines."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from martwright.operators.joins import frequent_keys, lookup, split_lookup
from martwright.plans import bucketed, reports
from martwright.plans.marts import build_dim_customers, build_fct_orders
from martwright.plans.staging import stage_customers, stage_orders
from martwright.sources.schemas import RAW_ORDERS, columns
from martwright.sources.seeds import read_seed, read_seed_sorted
from martwright.sources.synthetic import generate

DAY = "2024-06-01"


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("mart")
    people, sales = generate(spark, 400, 5000, hot_percent=33)
    dim = build_dim_customers(stage_customers(people, DAY))
    dim.write.parquet(str(folder / "dim"))
    dim = spark.read.parquet(str(folder / "dim"))
    build_fct_orders(stage_orders(sales), dim).write.parquet(str(folder / "fct"))
    return {"dim_customers": dim, "fct_orders": spark.read.parquet(str(folder / "fct"))}


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_bucketed_star_join_does_not_shuffle_the_fact(spark, conf, mart, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    old = F.col("order_date") < "2023-06-01"
    bucketed.store_buckets({**mart, "fct_orders": mart["fct_orders"].filter(old)}, "buckets", str(tmp_path), 4)
    bucketed.append_buckets("fct_orders", mart["fct_orders"].filter(~old), "buckets", 4)
    star = bucketed.read_buckets(spark, "buckets")
    report = reports.customer_spend(*star.values())
    plan = plan_of(report)
    assert "SelectedBucketsCount: 4 out of 4" in plan and "hashpartitioning(customer_key" not in plan
    assert rows(report) == rows(reports.customer_spend(*mart.values()))
    plain = plan_of(reports.customer_spend(*mart.values()))
    assert "hashpartitioning(customer_key" in plain
    assert "EqualTo(order_region,UK)" in plan_of(star["fct_orders"].filter("order_region = 'UK'"))


def task_seconds(spark, df):
    """Rows that each task of the join's stage gave, largest first."""
    counts = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return sorted((r["count"] for r in counts), reverse=True)


def test_a_frequent_customer_is_dealt_to_several_tasks(spark, conf):
    for key, value in {"autoBroadcastJoinThreshold": "-1", "shuffle.partitions": "16", "adaptive.enabled": "false"}.items():
        conf(f"spark.sql.{key}", value)
    people, sales = generate(spark, 2000, 30_000)
    hot = F.when(F.crc32("order_id") % 3 == 0, "CUST-00007").otherwise(F.col("customer_id"))
    sales = stage_orders(sales.withColumn("customer_id", hot)).select("order_id", "customer_id", "total_amount")
    dim = build_dim_customers(stage_customers(people, DAY)).select("customer_id", "customer_key")
    found = frequent_keys(sales, "customer_id", 0.05)
    assert list(found) == ["CUST-00007"] and abs(found["CUST-00007"] - 10_000) < 600
    plain, split = lookup(sales, dim, "customer_id"), split_lookup(sales, dim, "customer_id", 0.05)
    assert rows(split.select("order_id", "customer_key")) == rows(plain.select("order_id", "customer_key"))
    sizes, before = task_seconds(spark, split), task_seconds(spark, plain)
    assert before[0] > 4 * before[len(before) // 2] and sizes[0] <= 3 * sizes[len(sizes) // 2]


def test_split_lookups_of_odd_keys(spark):
    fact = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 3), ("b", 4), ("x", 5)], "k string, v int")
    dim = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, w int")
    for share in (0.01, 0.4, 0.9):
        assert rows(split_lookup(fact, dim, "k", share)) == rows(lookup(fact, dim, "k"))
    assert split_lookup(fact.limit(0), dim, "k").count() == 0


def test_distributions_come_from_one_scan(spark, mart, tmp_path):
    people, sales = generate(spark, 200, 2000)
    odd = sales.withColumn("region", F.when(F.crc32("order_id") % 5 > 0, F.col("region"))).withColumn("quantity", F.when(F.crc32("order_id") % 7 > 0, F.col("quantity")))
    odd.write.parquet(str(tmp_path / "o"))
    people.write.parquet(str(tmp_path / "c"))
    sales, people = spark.read.parquet(str(tmp_path / "o")), spark.read.parquet(str(tmp_path / "c"))
    found = reports.order_distributions(sales)
    assert plan_of(found).count("Scan parquet") == 2  # the node and its details
    assert plan_of(reports.customer_distributions(people)).count("Scan parquet") == 2

    def part(name, *wanted):
        return sorted(map(str, found.filter(F.col("distribution") == name).select(*wanted).collect()))

    assert part("region", "label", "orders", "net_revenue") == [str(r).replace("region=", "label=") for r in sorted(reports.net_revenue_by_region(sales).collect(), key=str)]
    single = reports.net_revenue_by_month(sales).select(F.col("month").alias("label"), F.col("region").alias("label_2"), "net_revenue")
    assert part("month", "label", "label_2", "net_revenue") == rows(single)
    assert [r["orders"] for r in found.filter("distribution = 'all'").collect()] == [2000]
    buckets = reports.quantity_histogram(sales).select(F.col("bucket").alias("label"), "orders")
    assert part("quantity", "label", "orders") == rows(buckets)
    assert reports.order_distributions(sales.limit(0)).collect() == []


def test_buyer_states_are_near_the_exact_count(spark, mart, tmp_path):
    reports.buyer_states(mart["fct_orders"]).write.parquet(str(tmp_path / "s"))
    states = spark.read.parquet(str(tmp_path / "s"))
    for first, last in (("2022-01-01", "2024-12-31"), ("2023-02-01", "2023-03-15"), ("2023-05-05", "2023-05-05")):
        exact = {r["order_region"]: tuple(r)[1:] for r in reports.exact_buyers(mart["fct_orders"], first, last).collect()}
        got = {r["order_region"]: tuple(r)[1:] for r in reports.distinct_buyers(states, first, last).collect()}
        assert got.keys() == exact.keys()
        for region, (orders, buyers) in got.items():
            assert orders == exact[region][0] and abs(buyers - exact[region][1]) <= 3 * 1.04 / 64 * exact[region][1] + 1
    assert reports.distinct_buyers(states, "2030-01-01", "2030-01-02").count() == 0


HEADER = ",".join(columns(RAW_ORDERS))
GOOD = 'O1,C1,2023-03-01,Shipped,PayPal,Toys,"BEAR, ""RED""",2,1.25,UK,2023-03-01T00:00:00.000Z'
BAD = {
    GOOD.replace("2023-03-01,", "2023-13-45,", 1): "not of its type: order_date",
    GOOD.replace(",2,", ",two,"): "not of its type: quantity",
    GOOD.replace(",2,1.25", ",2.5,cheap"): "not of its type: quantity, unit_price",
    GOOD + ",more": "12 values instead of 11",
    "O1,C1": "2 values instead of 11",
}


def test_bad_seed_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "one.csv").write_text("\n".join([HEADER, GOOD, *list(BAD)[:2]]) + "\n")
    (tmp_path / "s" / "two.csv").write_text("\n".join([HEADER, *list(BAD)[2:], GOOD.replace("O1", "O2").replace("2023-03-01,", ",", 1)]) + "\n")
    good, bad = read_seed_sorted(spark, "raw_orders", str(tmp_path / "s"))
    assert good.columns == columns(RAW_ORDERS) and good.schema["quantity"].dataType == RAW_ORDERS["quantity"].dataType
    got = sorted((r["order_id"], str(r["order_date"]), r["product_description"], r["quantity"]) for r in good.collect())
    assert got == [("O1", "2023-03-01", 'BEAR, "RED"', 2), ("O2", "None", 'BEAR, "RED"', 2)]
    found = {r["line"]: (r["reason"], r["file"].rsplit("/", 1)[1]) for r in bad.collect()}
    assert {line: reason for line, (reason, _) in found.items()} == BAD
    assert {file for _, file in found.values()} == {"one.csv", "two.csv"} and {r["seed"] for r in bad.collect()} == {"raw_orders"}
    assert good.count() == 2 and bad.count() == 5
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        read_seed(spark, "raw_orders", str(tmp_path / "s")).collect()
