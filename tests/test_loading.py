import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import duckdb
import pytest
from conftest import customer, moment, order
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martwright.operators.loading import first_per_key, insert_if_absent, rows_to_insert
from martwright.operators.sequence import with_sequence_key
from martwright.sources.seeds import read_seed, with_load_times, write_seed
from martwright.sources.synthetic import generate
from martwright.sources.tables import ensure_checkpoint_dir, range_predicates, refresh_table, table_counts


def test_first_per_key_keeps_the_whole_first_row(spark):
    rows = [("a", 2, "late"), ("a", 1, "early"), ("b", 1, "only"), (None, 0, "keyless")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    got = first_per_key(df, "k", ["t"])
    assert got.columns == ["k", "t", "v"]
    assert sorted(map(tuple, got.collect())) == [("a", 1, "early"), ("b", 1, "only")]


def test_first_per_key_takes_a_row_without_time_last(spark):
    rows = [("a", None, "x"), ("a", 5, "y"), ("b", None, "z")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    got = first_per_key(df, "k", ["t"])
    assert sorted(r["v"] for r in got.collect()) == ["y", "z"]


def test_first_per_key_does_not_depend_on_partitioning(spark):
    rows = [("a", 1, str(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    assert {first_per_key(df.repartition(n), "k", ["t"]).first()["v"] for n in (1, 3, 7)} == {"0"}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 20000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    got = first_per_key(df, "k", ["v"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert got.filter("k = -1").first()["v"] == 0
    assert got.count() == df.select("k").distinct().count()


def test_insert_if_absent(spark):
    schema = "k string, t int, v string"
    target = spark.createDataFrame([("a", 1, "old")], schema)
    batch = spark.createDataFrame(
        [("a", 1, "new"), ("b", 2, "second"), ("b", 1, "first"), (None, 1, "x")], schema
    )
    after = insert_if_absent(batch, target, "k", ["t"])
    assert sorted(map(tuple, after.collect())) == [("a", 1, "old"), ("b", 1, "first")]
    assert rows_to_insert(batch, after, "k", ["t"]).count() == 0


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_insert_against_plain_python(spark, conf, threshold):
    """A third of the batch has one key; merge joins and broadcast joins agree with a dict."""
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    rng = random.Random(3)
    schema = "k int, t int, v int"
    target = [(k, 0, k) for k in rng.sample(range(200), 80)]
    batch = [
        (1000 if i % 3 == 0 else rng.choice([None, *range(200)]), rng.randrange(9), i)
        for i in range(900)
    ]
    want = {k: (k, t, v) for k, t, v in target}
    for k, t, v in sorted((r for r in batch if r[0] is not None), key=lambda r: r[1:]):
        want.setdefault(k, (k, t, v))
    after = insert_if_absent(
        spark.createDataFrame(batch, schema).repartition(6),
        spark.createDataFrame(target, schema),
        "k",
        ["t"],
    )
    rows = list(map(tuple, after.collect()))
    assert sorted(rows) == sorted(want.values())


def test_the_target_is_not_shuffled_for_a_small_batch(spark, tmp_path):
    target = spark.range(0, 1000000).withColumn("v", F.col("id"))
    target.write.parquet(str(tmp_path / "t"))
    batch = spark.range(999990, 1000010).withColumn("v", F.col("id"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    fresh = rows_to_insert(batch, stored, "id", ["v"])
    assert fresh.count() == 10
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("LeftSemi") :]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "ReadSchema: struct<id:bigint>" in scan


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_sequence_key(spark, partitions):
    ids = spark.range(0, 1000).select(F.format_string("K%05d", (F.col("id") * 7919) % 1000).alias("k"))
    got = with_sequence_key(ids.repartition(5), "k", "key", start=10, partitions=partitions)
    rows = got.orderBy("k").collect()
    assert [r["key"] for r in rows] == list(range(10, 1010))
    assert got.columns == ["key", "k"]


def test_sequence_key_sorts_in_parallel(spark):
    ids = spark.range(0, 1000).select(F.col("id").alias("k"))
    got = with_sequence_key(ids, "k", "key")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" in plan  # what follows the checkpoint does not sort the rows again


class FakeSession:
    def __init__(self, setting, master):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = self
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_checkpoint_folder_of_the_session_is_used():
    session = FakeSession("hdfs://shared/state", "yarn")
    assert ensure_checkpoint_dir(session) == "hdfs://shared/state" == session.folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(FakeSession(None, "yarn"))
    local = FakeSession(None, "local[2]")
    assert ensure_checkpoint_dir(local) == local.folder


def test_seed_round_trip(spark, orders, tmp_path):
    raw = orders(
        order("O1", product_description='CUSHION, "RED"'),
        order("O2", product_description=" padded \\ "),
        order("O3", payment_method=None, product_description="£ ü"),
    )
    write_seed(raw, "raw_orders", str(tmp_path / "s"))
    back = read_seed(spark, "raw_orders", str(tmp_path / "s"))
    assert back.schema.simpleString() == raw.schema.simpleString()
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, raw.collect()), key=str)


def test_seed_blank_is_null_and_line_breaks_need_multiline(spark, orders, tmp_path):
    raw = orders(order("O1", product_description="a\nb"), order("O2", product_category=""))
    write_seed(raw, "raw_orders", str(tmp_path / "s"))
    back = read_seed(spark, "raw_orders", str(tmp_path / "s"), multiline=True)
    got = {r["order_id"]: r for r in back.collect()}
    assert got["O1"]["product_description"] == "a\nb"
    assert got["O2"]["product_category"] is None


def test_seed_with_a_bad_value_fails(spark, tmp_path):
    header = (
        "order_id,customer_id,order_date,order_status,payment_method,product_category,"
        "product_description,quantity,unit_price,region,created_at\n"
    )
    (tmp_path / "bad.csv").write_text(header + "O1,C1,2022-01-01,Shipped,,,,many,1.00,UK,\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_seed(spark, "raw_orders", str(tmp_path / "bad.csv")).collect()


def test_seed_with_plain_dates_as_times(spark, tmp_path):
    header = (
        "customer_id,customer_full_name,customer_email,customer_phone,country,region,gender,"
        "date_of_birth,created_at,updated_at\n"
    )
    line = "CUST-00001,Ada,ada@x.org,,UK,UK,F,1980-02-03,2022-05-06,\n"
    (tmp_path / "c.csv").write_text(header + line)
    row = with_load_times(read_seed(spark, "raw_customers", str(tmp_path / "c.csv"))).first()
    assert row["created_at"] == moment(2022, 5, 6) and row["updated_at"] is not None
    assert row["customer_phone"] is None and row["date_of_birth"] == dt.date(1980, 2, 3)


def test_generated_tables(spark):
    people, sales = generate(spark, 2000, 20000)
    assert people.select("customer_id").distinct().count() == 2000
    assert sales.select("order_id").distinct().count() == 20000
    assert sales.join(people, "customer_id", "left_anti").count() == 0
    # An order has the region of its buyer.
    joined = sales.join(people.select("customer_id", F.col("region").alias("home")), "customer_id")
    assert joined.filter("region <> home").count() == 0
    shares = {r[0]: r[1] / 20000 for r in sales.groupBy("order_status").count().collect()}
    for status, weight in zip(
        ("Pending", "Shipped", "Delivered", "Cancelled", "Refunded"), (0.15, 0.25, 0.5, 0.05, 0.05)
    ):
        assert abs(shares[status] - weight) < 0.02
    assert abs(people.filter("region = 'UK'").count() / 2000 - 0.55) < 0.05
    low, high = sales.agg(F.min("unit_price"), F.max("unit_price")).first()
    assert Decimal("1.12") <= low and high <= Decimal("15.54")
    assert sales.select("product_category").distinct().count() == 8
    bad = people.filter(~F.col("customer_email").rlike(r"^[a-z.]+_\d+@[a-z.]+$"))
    assert bad.count() == 0
    masked = people.filter(~F.col("customer_phone").rlike(r"^\+\d{2} \d{3,4} \d{3} \d{4}$"))
    assert masked.count() == 0


def test_generated_rows_do_not_depend_on_partitioning(spark):
    one, _ = generate(spark, 500, 1)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    try:
        three, _ = generate(spark, 500, 1)
        assert one.exceptAll(three).count() == 0
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_refresh_and_counts(spark, customers, tmp_path):
    path = str(tmp_path / "t")
    refresh_table(customers(customer("C1"), customer("C2", region="EU")), path, "region")
    refresh_table(customers(customer("C3")), path, "region")
    stored = spark.read.parquet(path)
    assert [r["customer_id"] for r in stored.collect()] == ["C3"]
    assert [tuple(r) for r in table_counts({"t": stored, "a": stored}).collect()] == [("a", 1), ("t", 1)]


def test_a_table_is_refreshed_from_itself_and_survives_a_failure(spark, customers, tmp_path):
    path = str(tmp_path / "t")
    refresh_table(customers(customer("C1"), customer("C2"), customer("C3")), path)
    refresh_table(spark.read.parquet(path).filter("customer_id > 'C1'"), path)
    kept = lambda: sorted(r["customer_id"] for r in spark.read.parquet(path).collect())
    assert kept() == ["C2", "C3"]
    broken = spark.read.parquet(path).withColumn("gender", F.when(F.col("customer_id") == "C3", F.raise_error(F.lit("lost"))))
    with pytest.raises((PySparkException, Py4JJavaError)):
        refresh_table(broken, path)
    assert kept() == ["C2", "C3"]


def test_ranges_of_a_text_key_cover_every_row_once():
    found = range_predicates("order_id", ["B", "O'x"])
    assert found == [
        "\"order_id\" < 'B' OR \"order_id\" IS NULL",
        "\"order_id\" >= 'B' AND \"order_id\" < 'O''x'",
        "\"order_id\" >= 'O''x'",
    ]
    assert range_predicates("n", []) == ["1 = 1"]
    rows = [("A",), ("B",), ("C",), ("O'x",), ("Z",), (None,)]
    with duckdb.connect() as db:
        db.execute("CREATE TABLE t (order_id VARCHAR)")
        db.executemany("INSERT INTO t VALUES (?)", rows)
        counts = [db.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in found]
    assert counts == [2, 2, 2]


def test_drawn_attributes_are_independent(spark):
    people, sales = generate(spark, 6000, 6000)
    names = people.groupBy("region").agg(F.countDistinct("customer_full_name").alias("n"))
    assert {r["n"] for r in names.collect()} == {64}
    pairs = sales.groupBy("order_status", "quantity").count().collect()
    by_status, by_quantity = Counter(), Counter()
    for status, quantity, n in pairs:
        by_status[status] += n
        by_quantity[quantity] += n
    for status, quantity, n in pairs:
        expected = by_status[status] * by_quantity[quantity] / 6000
        assert abs(n - expected) < 5 * expected**0.5 + 5


def test_a_hot_buyer_can_be_asked_for(spark):
    _, sales = generate(spark, 100, 3000, hot_percent=33)
    share = sales.filter("customer_id = 'CUST-00001'").count() / 3000
    assert 0.3 < share < 0.38
