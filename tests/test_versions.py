"""Versions of the stored tables, guarded builds, and loads that cost what the batch costs."""

from pathlib import Path

import pytest
from conftest import customer, order, plan_of
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martwright.operators.loading import keys_present
from martwright.operators.quality import ChecksFailed, key_checks, observed, run_checks
from martwright.plans import build, suites
from martwright.sources.synthetic import generate
from martwright.sources.versions import Conflict, VersionGone, Versions

DAY = "2024-06-01"


@pytest.fixture
def warehouse(spark, tmp_path):
    return build.Warehouse(spark, str(tmp_path / "w"))


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_readers_see_whole_versions(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    assert versions.latest() == 0 and versions.folders() == {}
    a, b = (versions.write(t, spark.range(n)) for t, n in (("a", 2), ("b", 3)))
    assert versions.folders() == {}  # written, not shown
    assert versions.publish(0, {"a": [a], "b": [b]}) == 1
    more = versions.write("a", spark.range(5, 6))
    assert versions.publish(1, {}, {"a": [more]}) == 2
    read = lambda v: ids(spark.read.parquet(*versions.folders(v)["a"]))
    assert read(None) == [0, 1, 5] and read(1) == [0, 1] and len(versions.folders(2)["b"]) == 1
    with pytest.raises(Conflict):
        versions.publish(1, {"a": [b]})
    for unknown in (3, 0, -1):
        with pytest.raises(VersionGone):
            versions.folders(unknown)


def test_old_versions_are_removed_by_count(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    for n in range(4):
        versions.publish(n, {"a": [versions.write("a", spark.range(n))], **({} if n else {"b": [versions.write("b", spark.range(9))]})})
    versions.write("a", spark.range(1))  # of a job that died
    gone = versions.keep(2)
    assert len(gone) == 3 and versions.latest() == 4 and versions.removed() == 2
    assert len(list(Path(tmp_path, "a").iterdir())) == 2
    for version, rows in ((3, 2), (4, 3)):
        assert spark.read.parquet(*versions.folders(version)["a"]).count() == rows
        assert spark.read.parquet(*versions.folders(version)["b"]).count() == 9  # shared by all
    with pytest.raises(VersionGone):
        versions.folders(2)
    assert versions.keep(2) == [] and versions.publish(4, {}) == 5
    with pytest.raises(ValueError):
        versions.keep(0)


def test_a_load_that_dies_leaves_the_tables_of_before(spark, warehouse):
    build.load_raw(warehouse, *generate(spark, 10, 30))
    build.build_marts(warehouse, DAY)
    before = {n: ids(df.select(df.columns[0])) for n, df in warehouse.tables().items()}
    people, sales = generate(spark, 20, 60)
    broken = F.when(F.col("order_id") == "ORD-00055", F.raise_error(F.lit("lost"))).otherwise(F.col("order_id"))
    with pytest.raises((PySparkException, Py4JJavaError)):
        build.load_raw(warehouse, people, sales.withColumn("order_id", broken))
    assert {n: ids(df.select(df.columns[0])) for n, df in warehouse.tables().items()} == before
    assert warehouse.versions.latest() == 2


def test_a_table_is_replaced_by_rows_that_read_it(spark, warehouse):
    build.load_raw(warehouse, *generate(spark, 10, 30))
    tables = warehouse.tables()
    again = tables["raw_orders"].filter("quantity > 1")
    wanted = ids(again.select("order_id"))
    build.load_raw(warehouse, tables["raw_customers"], again)
    assert ids(warehouse.read("raw_orders").select("order_id")) == wanted
    assert warehouse.at(1).read("raw_orders").count() == 30


def test_all_tables_change_together(spark, warehouse):
    first = build.load_raw(warehouse, *generate(spark, 10, 30))
    second = build.build_marts(warehouse, DAY) or warehouse.versions.latest()
    build.load_raw(warehouse, *generate(spark, 4, 4))
    counts = lambda v: {n: df.count() for n, df in warehouse.at(v).tables().items()}
    assert counts(first) == {"raw_customers": 10, "raw_orders": 30, "dim_customers": 0, "fct_orders": 0}
    assert counts(second) == {"raw_customers": 10, "raw_orders": 30, "dim_customers": 10, "fct_orders": 30}
    assert {n: df.count() for n, df in warehouse.tables().items()} == {"raw_customers": 4, "raw_orders": 4, "dim_customers": 0, "fct_orders": 0}


def test_a_build_that_breaks_a_rule_is_not_shown(spark, warehouse, customers, orders):
    people = customers(customer("C1"), customer("C2", region="US"))
    build.load_raw(warehouse, people, orders(order("O1"), order("O2", "C2", order_status="Lost")))
    with pytest.raises(ChecksFailed, match="region") as refused:
        build.build_marts(warehouse, DAY, guard=suites.declared_marts())
    assert warehouse.read("fct_orders").count() == 0 and warehouse.versions.latest() == 1
    failed = {r[:3] for r in refused.value.report if r[-1] == "FAIL"}
    assert ("accepted_values", "dim_customers", "region") in failed and ("accepted_values", "fct_orders", "order_status") in failed
    build.load_raw(warehouse, customers(customer("C1")), orders(order("O1")))
    report = build.build_marts(warehouse, DAY, guard=suites.declared_marts())
    assert warehouse.read("fct_orders").count() == 1 and {r[-1] for r in report} == {"PASS"}
    later = run_checks(warehouse.tables(), suites.declared_marts()).collect()
    assert sorted(map(str, report)) == sorted(str(tuple(r)) for r in later)


def test_rules_are_counted_on_the_way(spark, tmp_path, customers):
    """Results of the watched write equal those of the checks; the write scans its source once."""
    rows = customers(customer("C1", region="US"), customer(None), customer("C3", customer_email="nobody"), customer("C3"))
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    suite = [e for e in suites.asserted_raw() if e.table == "raw_customers"]
    watched, results = observed(source, "raw_customers", suite)
    assert plan_of(watched).count("Scan parquet") == 2  # the node and its details
    watched.write.parquet(str(tmp_path / "out"))
    got = results() + key_checks({"raw_customers": source}, suite)
    want = [tuple(r) for r in run_checks({"raw_customers": source}, suite).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and any(r[-1] == "FAIL" for r in got)
    none, results = observed(source.limit(0), "raw_customers", suite)
    none.write.parquet(str(tmp_path / "none"))
    assert [r[:2] for r in results() if r[-1] == "FAIL"] == [("non_empty", "raw_customers")]
    assert observed(source, "other", suite)[1]() == [] and key_checks({}, []) == []


def test_rejected_orders_are_staged_once(spark, warehouse, customers, orders):
    build.load_raw(warehouse, customers(customer("C1")), orders(order("O1"), order("O2", quantity=0), order("O3", "late")))
    build.add_to_marts(warehouse, DAY)
    assert ids(warehouse.read("fct_orders").select("order_id")) == ["O1"]
    assert [tuple(r) for r in warehouse.read(build.REJECTED).collect()] == [("O2", "quantity")]
    assert build.missing_orders(warehouse).count() == 0  # nothing is left to stage
    build.add_raw(warehouse, customers(customer("late")), orders(order("O4", unit_price=None), order("O5", "late")))
    assert ids(build.missing_orders(warehouse)) == ["O4"]
    build.add_to_marts(warehouse, DAY)
    assert ids(warehouse.read("fct_orders").select("order_id")) == ["O1", "O3", "O5"]
    assert ids(warehouse.read(build.REJECTED).select("order_id")) == ["O2", "O4"]
    build.build_marts(warehouse, DAY)
    assert ids(warehouse.read(build.REJECTED).select("order_id")) == ["O2", "O4"] and build.missing_orders(warehouse).count() == 0
    build.load_raw(warehouse, customers(customer("C1")), orders(order("O2")))
    build.add_to_marts(warehouse, DAY)
    assert ids(warehouse.read("fct_orders").select("order_id")) == ["O2"]


def opened_rows(df):
    """Rows of the row groups that the scan opened."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_small_batch_opens_only_the_row_groups_that_can_hold_its_keys(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    _, sales = generate(spark, 100, 16_000)
    sales = sales.repartition(16, "order_id")  # every file has ids from end to end
    name = versions.write("raw_orders", sales, ["order_id"])
    target = spark.read.parquet(versions.path(name))
    known = [r[0] for r in target.select("order_id").limit(2).collect()]
    new = [f"ORD-0{n}x" for n in range(1000, 1300)]
    asked = spark.createDataFrame([(k,) for k in [*known, *new]], "order_id string")
    found = keys_present(target, "order_id", asked, by_value=True)
    assert ids(found) == sorted(known)
    assert opened_rows(found) <= 16_000 / 16 * 8  # of sixteen; a filter lets a key in a hundred pass
    assert opened_rows(target.select("order_id")) == 16_000
    none = keys_present(target, "order_id", spark.createDataFrame([("ORD-00001x",)], "order_id string"), by_value=True)
    assert opened_rows(none) <= 2000
    assert ids(keys_present(target, "order_id", asked)) == sorted(known)
    many = spark.range(5000).selectExpr("concat('ORD-', lpad(id, 5, '0')) AS order_id")
    plain, ranged = (ids(keys_present(target, "order_id", many, by_value=v)) for v in (False, True))
    assert plain == ranged and len(plain) == 4999
    assert keys_present(target, "order_id", many.limit(0), by_value=True).count() == 0
