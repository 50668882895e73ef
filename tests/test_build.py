import datetime as dt
from decimal import Decimal

import pytest
from conftest import customer, order, plan_of
from pyspark.sql import functions as F

from martwright.__main__ import main
from martwright.operators.joins import orphans
from martwright.plans import build
from martwright.plans.marts import build_dim_customers, build_fct_orders
from martwright.plans.staging import rejected_orders, stage_customers, stage_orders
from martwright.sources.schemas import DIM_CUSTOMERS, FCT_ORDERS, columns, data_dictionary
from martwright.sources.synthetic import generate

DAY = "2024-06-01"


@pytest.fixture
def warehouse(spark, tmp_path):
    return build.Warehouse(spark, str(tmp_path))


def test_staged_customer(customers):
    row = stage_customers(customers(customer("C1")), DAY).first().asDict()
    assert row["country"] == "UNITED KINGDOM" and row["region"] == "UK"
    assert row["customer_age"] == 44 and len(row["customer_email_hash"]) == 64
    assert stage_customers(customers(customer("C1")), "2024-01-01", "calendar").first()[
        "customer_age"
    ] == 44
    assert stage_customers(customers(customer("C1")), dt.date(2024, 1, 1)).first()["customer_age"] == 43


def test_staged_order(orders):
    row = stage_orders(orders(order("O1"))).first().asDict()
    assert row["order_status"] == "Shipped" and row["payment_method"] == "Paypal"
    assert (row["gross_amount"], row["tax_amount"], row["total_amount"]) == (
        Decimal("2.50"), Decimal("0.50"), Decimal("3.00"),
    )
    assert stage_orders(orders(order("O1")), "upper").first()["order_status"] == "SHIPPED"


def test_mart_columns_and_types(customers, orders):
    dim = build_dim_customers(stage_customers(customers(customer("C1")), DAY), birth_date=True)
    assert dim.columns == columns(DIM_CUSTOMERS)
    assert [f.dataType for f in dim.schema] == [f.dataType for f in DIM_CUSTOMERS]
    fct = build_fct_orders(stage_orders(orders(order("O1"))), dim)
    assert fct.columns == columns(FCT_ORDERS)
    assert [f.dataType for f in fct.schema] == [f.dataType for f in FCT_ORDERS]
    assert "date_of_birth" not in build_dim_customers(stage_customers(customers(customer("C1")), DAY)).columns


def test_sequence_keys_number_each_customer_once(customers, orders):
    raw = customers(customer("C2"), customer("C1"), customer("C2"), customer(None))
    dim = build_dim_customers(stage_customers(raw, DAY), keys="sequence")
    numbers = sorted((r["customer_id"], r["customer_key"]) for r in dim.collect())
    assert numbers == [("C1", 1), ("C2", 2), ("C2", 2)]
    dim = dim.dropDuplicates(["customer_id"])
    sales = orders(order("O9", "C2"), order("O1", "C1"), order("O5", "gone"))
    fct = build_fct_orders(stage_orders(sales), dim, keys="sequence")
    got = sorted((r["order_id"], r["order_key"], r["customer_key"]) for r in fct.collect())
    assert got == [("O1", 1, 1), ("O9", 2, 2)]
    with pytest.raises(ValueError, match="keys"):
        build_dim_customers(stage_customers(raw, DAY), keys="uuid")


def test_whole_run(spark, warehouse):
    people, sales = generate(spark, 300, 2000)
    build.load_raw(warehouse, people, sales)
    build.build_marts(warehouse, DAY)
    tables = warehouse.tables()
    assert {n: t.count() for n, t in tables.items()} == {
        "raw_customers": 300, "raw_orders": 2000, "dim_customers": 300, "fct_orders": 2000,
    }
    report = build.check(warehouse, DAY)
    # The tax on the cheapest orders is off by rounding; every other check passes.
    assert [r["check_name"] for r in report.filter("status = 'FAIL'").collect()] in ([], ["tax_rate"])

    # Adding the same rows again changes nothing; new rows are added once.
    build.add_raw(warehouse, people, sales)
    more, later = generate(spark, 310, 2100)
    build.add_raw(warehouse, more.unionByName(more), later)
    build.add_to_marts(warehouse, DAY)
    build.add_to_marts(warehouse, DAY)
    assert {n: t.count() for n, t in warehouse.tables().items()} == {
        "raw_customers": 310, "raw_orders": 2100, "dim_customers": 310, "fct_orders": 2100,
    }
    # A batch whose keys are all new.
    build.add_raw(warehouse, *generate(spark, 320, 2200))
    build.add_to_marts(warehouse, DAY)
    build.add_to_marts(warehouse, DAY)
    assert {n: t.count() for n, t in warehouse.tables().items()} == {
        "raw_customers": 320, "raw_orders": 2200, "dim_customers": 320, "fct_orders": 2200,
    }
    # A full refresh gives the same marts as adding did.
    before = {n: t.drop("created_at").collect() for n, t in warehouse.tables().items()}
    build.build_marts(warehouse, DAY)
    for name, rows in before.items():
        again = warehouse.read(name).drop("created_at").collect()
        assert sorted(map(str, again)) == sorted(map(str, rows)), name


@pytest.mark.parametrize("keys", ["hash", "sequence"])
def test_the_same_rows_whatever_the_keys(customers, orders, keys):
    people = customers(customer("C1"), customer("C1"), customer("C2"), customer(None))
    sales = orders(order("O1"), order("O1"), order("O2", "C2"), order(None, "C2"), order("O3", None))
    dim = build_dim_customers(stage_customers(people, DAY), keys)
    fct = build_fct_orders(stage_orders(sales), dim, keys)
    assert dim.groupBy("customer_id").count().orderBy("customer_id").collect() == [("C1", 2), ("C2", 1)]
    got = [tuple(r) for r in fct.groupBy("order_id").count().orderBy("order_id").collect()]
    assert got == [(None, 1), ("O1", 4), ("O2", 1)]
    pairs = fct.select("order_id", "order_key").distinct()
    assert pairs.count() == pairs.select("order_key").distinct().count() == 3


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("keys", ["hash", "sequence"])
@pytest.mark.parametrize("order_of", ["customers first", "orders first", "mixed"])
def test_any_split_into_batches_ends_in_the_same_marts(spark, tmp_path, keys, order_of):
    people, sales = generate(spark, 60, 300)
    n = F.crc32(people["customer_id"]) % 3
    m = F.crc32(sales["order_id"]) % 3
    none_p, none_s = people.limit(0), sales.limit(0)
    batches = {
        "customers first": [(people, none_s), (none_p, sales)],
        "orders first": [(none_p, sales), (people, none_s)],
        "mixed": [(people.filter(n == i), sales.filter(m == i)) for i in range(3)],
    }[order_of]
    split = build.Warehouse(spark, str(tmp_path / "split"))
    for batch in batches:
        build.add_raw(split, *batch)
        build.add_to_marts(split, DAY, keys=keys)
    whole = build.Warehouse(spark, str(tmp_path / "whole"))
    build.load_raw(whole, people, sales)
    build.build_marts(whole, DAY, keys=keys)
    drop = ["customer_key", "order_key"] if keys == "sequence" else []
    for table in ("dim_customers", "fct_orders"):
        assert rows(split.read(table).drop(*drop)) == rows(whole.read(table).drop(*drop)), table
    if keys == "sequence":
        dim, fct = split.read("dim_customers"), split.read("fct_orders")
        numbers = sorted(r[0] for r in dim.select("customer_key").collect())
        assert numbers == list(range(1, 61))
        assert sorted(r[0] for r in fct.select("order_key").collect()) == list(range(1, 301))
        assert fct.join(dim, ["customer_key", "customer_id"]).count() == 300


def test_keys_of_another_kind_are_refused_before_any_write(spark, warehouse):
    build.load_raw(warehouse, *generate(spark, 10, 20))
    build.build_marts(warehouse, DAY)
    build.add_raw(warehouse, *generate(spark, 12, 30))
    with pytest.raises(ValueError, match="not keyed by sequence"):
        build.add_to_marts(warehouse, DAY, keys="sequence")
    assert warehouse.read("dim_customers").count() == 10
    build.add_to_marts(warehouse, DAY)
    assert warehouse.read("dim_customers").count() == 12


def test_missing_rows_are_found_by_keys_alone(spark, warehouse):
    build.load_raw(warehouse, *generate(spark, 10, 20))
    build.build_marts(warehouse, DAY)
    for found, names in ((build.missing_customers(warehouse), {"customer_id"}), (build.missing_orders(warehouse), {"order_id", "customer_id"})):
        read = set()
        for line in plan_of(found).splitlines():
            if "ReadSchema" in line:
                read |= {f.split(":")[0] for f in line.split("struct<")[1].rstrip(">").split(",")}
        assert read == names


def test_blank_regions_and_empty_tables_are_stored_as_they_are(spark, warehouse, customers, orders):
    build.load_raw(warehouse, customers(customer("C1", region=""), customer("C2")), orders(order("O1", quantity=0)))
    build.build_marts(warehouse, DAY)
    assert sorted(r["region"] for r in warehouse.read("dim_customers").collect()) == ["", "UK"]
    assert warehouse.read("fct_orders").columns == columns(FCT_ORDERS)
    failed = build.check(warehouse, DAY).filter("status = 'FAIL' AND table_name = 'fct_orders'")
    assert [r["check_name"] for r in failed.collect()] == ["non_empty"]


def test_a_new_load_leaves_no_old_marts(spark, warehouse):
    build.load_raw(warehouse, *generate(spark, 10, 20))
    build.build_marts(warehouse, DAY)
    build.load_raw(warehouse, *generate(spark, 5, 5))
    assert {n: df.count() for n, df in warehouse.tables().items()} == {
        "raw_customers": 5, "raw_orders": 5, "dim_customers": 0, "fct_orders": 0,
    }


def test_an_amount_that_does_not_fit_rejects_its_order_only(orders):
    raw = orders(order("O1"), order("O2", quantity=2_000_000_000, unit_price=Decimal("99999999.99")))
    assert [r["order_id"] for r in stage_orders(raw).collect()] == ["O1"]
    assert [(r["order_id"], r["reject_reason"]) for r in rejected_orders(raw).collect()] == [("O2", "amount")]


def test_steps_from_the_shell(spark, tmp_path, capsys):
    first, second, seeds = (str(tmp_path / name) for name in ("a", "b", "seeds"))
    day = ["--as-of", DAY]
    main(["generate", first, "--customers", "40", "--orders", "200"])
    main(["build", first, *day])
    main(["export", first, "--seeds", seeds])
    main(["seed", second, "--seeds", seeds])
    main(["build", second, *day])
    main(["check", second, *day])
    main(["report", second])
    assert "fct_orders (mart)" in capsys.readouterr().out
    one, two = (build.Warehouse(spark, folder) for folder in (first, second))
    for name, df in one.tables().items():
        rows = (sorted(map(str, t.collect())) for t in (df, two.read(name)))
        assert next(rows) == next(rows), name


def test_column_notes_are_stored_with_the_table(spark, warehouse):
    build.load_raw(warehouse, *generate(spark, 5, 5))
    build.build_marts(warehouse, DAY)
    notes = data_dictionary(warehouse.tables())
    assert notes.filter(F.col("description").isNull()).count() == 0
    row = notes.filter("table_name = 'fct_orders' AND column_name = 'total_amount'").first()
    assert tuple(row)[2:] == (14, "total_amount", "decimal(12,2)", "Price with tax, rounded once from the unrounded product")
    assert row["table_description"].startswith("Order fact")


def test_valid_orders_are_filtered_in_the_scan(spark, orders, tmp_path):
    orders(order("O1")).write.parquet(str(tmp_path / "o"))
    staged = stage_orders(spark.read.parquet(str(tmp_path / "o"))).select("order_id", "total_amount")
    plan = plan_of(staged)
    assert "GreaterThan(quantity,0)" in plan and "IsNotNull(order_date)" in plan
    assert "GreaterThanOrEqual(unit_price,0" in plan
    schema = next(x for x in plan.splitlines() if "ReadSchema" in x)
    assert "order_status" not in schema and "product_description" not in schema


@pytest.fixture
def small_partitions(conf):
    """Partitions of kilobytes count as large, and nothing is broadcast."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.shuffle.partitions", "16")


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_customer_is_split_in_the_join(spark, small_partitions):
    """With a third of the orders on one customer, adaptive execution splits that partition."""
    people, sales = generate(spark, 1000, 40000)
    hot = F.when(F.crc32("order_id") % 3 == 0, "CUST-00007").otherwise(F.col("customer_id"))
    sales = sales.withColumn("customer_id", hot).repartition(8)
    dim = build_dim_customers(stage_customers(people, DAY))
    fct = build_fct_orders(stage_orders(sales), dim)
    joined = fct.select("order_id", "customer_key", "total_amount")
    rows = joined.collect()
    assert len(rows) == len({r["order_id"] for r in rows}) == 40000
    assert "SortMergeJoin(skew=true)" in final_plan(joined)


@pytest.mark.parametrize("hot", ["CUST-X", None])
def test_a_hot_orphan_key_is_split_in_the_join(spark, small_partitions, hot):
    people, sales = generate(spark, 1000, 40000)
    lost = F.when(F.crc32("order_id") % 3 == 0, F.lit(hot)).otherwise(F.col("customer_id"))
    sales = sales.withColumn("customer_id", lost).repartition(8)
    got = orphans(sales, people, "customer_id", "customer_id").select("order_id")
    rows = got.collect()
    want = sales.filter(F.crc32("order_id") % 3 == 0).count()
    assert len(rows) == len({r["order_id"] for r in rows}) == want
    assert "SortMergeJoin(skew=true)" in final_plan(got)


def test_small_dimensions_are_broadcast_without_a_hint_and_large_ones_are_not(spark, conf, customers, orders):
    dim = build_dim_customers(stage_customers(customers(customer("C1")), DAY))
    fct = build_fct_orders(stage_orders(orders(order("O1"))), dim)
    assert "ResolvedHint" not in fct._jdf.queryExecution().analyzed().toString()
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    again = build_fct_orders(stage_orders(orders(order("O1"))), dim)
    assert "SortMergeJoin" in again._jdf.queryExecution().executedPlan().toString()
