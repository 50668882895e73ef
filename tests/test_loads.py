"""Loads look at keys before they move rows."""

from conftest import customer, moment, order, plan_of

from martwright.operators.loading import rows_to_insert
from martwright.plans import build
from martwright.sources.versions import Versions


def test_rows_without_copies_are_stored_without_a_join(spark, conf, tmp_path, monkeypatch, customers, orders):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans, write = {}, Versions.write

    def noted(self, table, df, keys=()):
        plans.setdefault(table, []).append(plan_of(df))
        return write(self, table, df, keys)

    monkeypatch.setattr(Versions, "write", noted)
    warehouse = build.Warehouse(spark, str(tmp_path / "w"))
    build.load_raw(warehouse, customers(customer("C1"), customer(None)), orders(order("O1"), order("O2")))
    assert "Join" not in plans["raw_customers"][0] and "Join" not in plans["raw_orders"][0]
    assert [r["customer_id"] for r in warehouse.read("raw_customers").collect()] == ["C1"]
    assert sorted(r["order_id"] for r in warehouse.read("raw_orders").collect()) == ["O1", "O2"]


def test_copies_in_a_batch_are_added_as_an_insert_adds_them(spark, conf, tmp_path, customers, orders):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    warehouse = build.Warehouse(spark, str(tmp_path / "w"))
    build.load_raw(warehouse, customers(customer("C1")), orders(order("O1"), order("O1", created_at=moment(2020), quantity=7)))
    before = warehouse.read("raw_orders")
    assert [r["quantity"] for r in before.collect()] == [7]
    batch = orders(
        order("O1", quantity=9), order("O2", created_at=moment(2023)), order("O2", created_at=moment(2021), quantity=5),
        order("O3", created_at=None), order("O3", created_at=moment(2024), quantity=8), order(None), order("O4"),
    )
    wanted = sorted(map(tuple, before.unionByName(rows_to_insert(batch, before, "order_id", ["created_at"])).collect()), key=repr)
    build.add_raw(warehouse, customers(customer("C1")), batch)
    assert sorted(map(tuple, warehouse.read("raw_orders").collect()), key=repr) == wanted
    build.add_raw(warehouse, customers(customer("C1")), batch)
    assert warehouse.read("raw_orders").count() == len(wanted) == 4
