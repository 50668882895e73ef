import datetime as dt
import os
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from martwright.session import local_session  # noqa: E402
from martwright.sources.schemas import RAW_CUSTOMERS, RAW_ORDERS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(int(os.environ.get("TEST_CPUS", "4")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def moment(year, month=1, day=1):
    return dt.datetime(year, month, day)


def customer(id_, **changes):
    row = {
        "customer_id": id_,
        "customer_full_name": "John Smith",
        "customer_email": "john.smith@gmail.com",
        "customer_phone": "+44 7123 456 7890",
        "country": " United Kingdom ",
        "region": "uk",
        "gender": "M",
        "date_of_birth": dt.date(1980, 5, 17),
        "created_at": moment(2022),
        "updated_at": moment(2022),
    }
    return tuple((row | changes).values())


def order(id_, customer_id="C1", **changes):
    row = {
        "order_id": id_,
        "customer_id": customer_id,
        "order_date": dt.date(2023, 3, 1),
        "order_status": " shipped",
        "payment_method": "PayPal",
        "product_category": "Toys",
        "product_description": "BEAR",
        "quantity": 2,
        "unit_price": Decimal("1.25"),
        "region": "uk",
        "created_at": moment(2023, 3, 1),
    }
    return tuple((row | changes).values())


@pytest.fixture
def customers(spark):
    return lambda *rows: spark.createDataFrame(list(rows), RAW_CUSTOMERS)


@pytest.fixture
def orders(spark):
    return lambda *rows: spark.createDataFrame(list(rows), RAW_ORDERS)


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def node_lines(plan):
    """The tree of a formatted plan without the details below it."""
    return plan[: plan.index("\n\n\n")] if "\n\n\n" in plan else plan
