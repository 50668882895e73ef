"""Every registered query: a callable of (spark, folder) that returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from functools import reduce
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.domain import MAX_AGE, MIN_AGE, ORDER_STATUSES, REGIONS
from martwright.functions import dates, keys, masks, money, text
from martwright.operators import access, policies, quality
from martwright.operators.joins import orphan_keys, orphans
from martwright.operators.loading import first_per_key, insert_if_absent, rows_to_insert
from martwright.operators.sequence import with_sequence_key
from martwright.plans import bucketed, catalog, reports, suites
from martwright.plans.build import REJECTED, SCHEMAS, Warehouse, add_raw, add_to_marts, build_marts, load_raw
from martwright.plans.marts import build_dim_customers, build_fct_orders
from martwright.plans.staging import rejected_orders, stage_customers, stage_orders
from martwright.sources import schemas
from martwright.sources.schemas import document
from martwright.sources.seeds import read_seed, read_seed_sorted, with_load_times, write_seed
from martwright.sources.synthetic import customers_from, orders_from
from martwright.sources.tables import read_table, refresh_table, scratch_path
from verification import tables as t

ROLES = ["DATA_ENGINEER", "DATA_ANALYST_UK", "DATA_ANALYST_EU", "SYSADMIN"]
HISTORY_END = "1999-01-01"  # orders before this day stand for the rows already loaded
SINCE_END = "2023-01-01"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types that two engines print alike: decimals and 32-bit numbers double, days text.

    (A nullable whole number is a float in one engine's pandas output and not in the other's.)
    """

    def plain(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType | T.IntegerType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType | T.TimestampType):
            return c.cast("string").alias(f.name)
        return c

    return df.select(*[plain(f) for f in df.schema])


def query(run: Query) -> Query:
    QUERIES[run.__name__] = lambda spark, folder: comparable(run(spark, folder))
    return run


# Sources, sinks and loading.


@query
def raw_customers(spark, folder):
    return t.raw_customers(spark, folder)


@query
def raw_orders(spark, folder):
    return t.raw_orders(spark, folder)


@query
def projected_scan(spark, folder):
    return t.scan(spark, folder, "orders", "o_orderkey", "o_orderstatus")


def _seed_round_trip(spark, folder, name):
    path = scratch_path(spark, f"seed-{name}")
    write_seed(t.raw(spark, folder, dirty=True)[name], name, path)
    return read_seed(spark, name, path)


@query
def seed_customers(spark, folder):
    return _seed_round_trip(spark, folder, "raw_customers")


@query
def seed_orders(spark, folder):
    return _seed_round_trip(spark, folder, "raw_orders")


@query
def full_refresh(spark, folder):
    """The second refresh replaces the first; an analyst's region opens one folder."""
    path = scratch_path(spark, "fct_orders")
    fct = t.marts(spark, folder)["fct_orders"]
    refresh_table(fct, path, "order_region")
    refresh_table(fct.select("order_id", "total_amount", "order_region"), path, "order_region")
    return access.secure(read_table(spark, path), "fct_orders", "DATA_ANALYST_UK")


@query
def first_row_per_key(spark, folder):
    return first_per_key(t.raw_orders(spark, folder, dirty=True), "order_id", ["created_at"])


@query
def insert_raw_orders(spark, folder):
    batch = t.raw_orders(spark, folder, dirty=True)
    loaded = t.raw_orders(spark, folder).filter(F.col("created_at") < HISTORY_END)
    return rows_to_insert(batch, loaded, "order_id", ["created_at"])


@query
def insert_raw_customers(spark, folder):
    batch = t.raw_customers(spark, folder, dirty=True)
    loaded = t.raw_customers(spark, folder).filter(F.col("created_at") < SINCE_END)
    return insert_if_absent(batch, loaded, "customer_id", ["created_at"])


@query
def insert_dim_customers(spark, folder):
    batch = t.dim_customers(spark, folder, dirty=True)
    loaded = t.dim_customers(spark, folder).filter(F.col("customer_since") < SINCE_END)
    return insert_if_absent(batch, loaded, "customer_id", ["customer_since"]).drop("updated_at")


@query
def insert_fct_orders(spark, folder):
    batch = t.marts(spark, folder, dirty=True)["fct_orders"]
    loaded = t.marts(spark, folder)["fct_orders"].filter(F.col("order_date") < HISTORY_END)
    return rows_to_insert(batch, loaded, "order_id", ["order_date"])


def _warehouse(spark, folder, since: str | None = None) -> Warehouse:
    """Stored raw tables: all orders, and the customers created before a day."""
    raw = t.raw(spark, folder)
    people = raw["raw_customers"]
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    load_raw(warehouse, people.filter(F.col("created_at") < since) if since else people, raw["raw_orders"])
    return warehouse


@query
def insert_late_orders(spark, folder):
    """Orders reach the fact once their customers, which come later, are there."""
    warehouse = _warehouse(spark, folder, SINCE_END)
    add_to_marts(warehouse, t.AS_OF)
    add_raw(warehouse, *t.raw(spark, folder).values())
    add_to_marts(warehouse, t.AS_OF)
    return warehouse.read("fct_orders")


@query
def insert_sequence_keys(spark, folder):
    """Integer keys of later customers go on from the largest."""
    warehouse = _warehouse(spark, folder, SINCE_END)
    build_marts(warehouse, t.AS_OF, keys="sequence")
    add_raw(warehouse, *t.raw(spark, folder).values())
    add_to_marts(warehouse, t.AS_OF)
    orders = warehouse.read("fct_orders").groupBy("customer_key").agg(F.count("*").alias("total_orders"))
    return warehouse.read("dim_customers").join(orders, "customer_key").select("customer_key", "customer_id", "total_orders")


# Versions of the stored tables.


@query
def interrupted_refresh(spark, folder):
    """A load that dies while it writes the orders leaves the tables of before."""
    warehouse = _warehouse(spark, folder)
    build_marts(warehouse, t.AS_OF)
    raw = t.raw(spark, folder)
    broken = F.when(F.col("quantity") > 6, F.raise_error(F.lit("lost"))).otherwise(F.col("order_id"))
    try:
        load_raw(warehouse, raw["raw_customers"], raw["raw_orders"].withColumn("order_id", broken))
    except (PySparkException, Py4JJavaError):  # several tasks may have failed
        return warehouse.read("fct_orders")
    raise AssertionError("the load should have failed")


@query
def older_versions(spark, folder):
    """The orders per region before and after later customers were added, each read by its version."""
    warehouse = _warehouse(spark, folder, SINCE_END)
    first = add_to_marts(warehouse, t.AS_OF)
    add_raw(warehouse, *t.raw(spark, folder).values())
    second = add_to_marts(warehouse, t.AS_OF)
    parts = [
        reports.revenue_by_region(warehouse.at(version).read("fct_orders")).select(F.lit(name).alias("version"), "order_region", "total_orders", "total_revenue")
        for name, version in (("first", first), ("second", second))
    ]
    return parts[0].unionByName(parts[1])


@query
def guarded_refresh(spark, folder):
    """A build whose rows break rules is not shown: the report of the refused build."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    load_raw(warehouse, *t.raw(spark, folder, dirty=True).values())
    try:
        build_marts(warehouse, t.AS_OF, guard=suites.asserted_marts())
    except quality.ChecksFailed as refused:
        assert warehouse.read("fct_orders").isEmpty()
        return spark.createDataFrame(refused.report, "check_name string, table_name string, column_name string, failed_rows bigint, status string")
    raise AssertionError("the build should have been refused")


@query
def rejected_ids(spark, folder):
    """The ids that staging left out are stored, and no later load looks at them again."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    load_raw(warehouse, *t.raw(spark, folder, dirty=True).values())
    add_to_marts(warehouse, t.AS_OF)
    add_to_marts(warehouse, t.AS_OF)
    return warehouse.read(REJECTED)


# Seeds with bad lines.

SEED_CYCLE = 97
# remainder of the order's number -> the line as it should not be
BAD_LINES = {
    1: "replace(line, ',' || order_day || ',', ',someday,')",
    2: "line || ',one more'",
    3: "substr(line, 1, 9)",
    4: "replace(line, ',' || items || ',', ',several,')",
}


def order_lines(orders, number: str) -> str:
    """SQL of a seed line for an order, with BAD_LINES put in by a rule on the order's number."""
    cases = " ".join(f"WHEN {number} % {SEED_CYCLE} = {rest} THEN {bad}" for rest, bad in BAD_LINES.items())
    return f"CASE {cases} ELSE line END"


def _spoiled_seed(spark, folder) -> str:
    numbered = t.numbered_orders(spark, folder)
    text = {"order_day": F.col("order_date").cast("string"), "items": F.col("quantity").cast("string")}
    line = F.concat_ws(
        ",", "order_id", "customer_id", text["order_day"], "order_status", "payment_method", "product_category",
        F.concat(F.lit('"'), "product_description", F.lit('"')), text["items"], F.col("unit_price").cast("string"), "region",
        F.concat(text["order_day"], F.lit("T00:00:00.000Z")),
    )
    named = numbered.select("n", *(c.alias(k) for k, c in text.items()), line.alias("line"))
    lines = named.select(F.expr(order_lines("", "n")).alias(",".join(schemas.columns(schemas.RAW_ORDERS))))
    path = scratch_path(spark, "seed-lines")
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "\u0000").csv(path)
    return path


@query
def quarantined_orders(spark, folder):
    """Seed lines that do not parse, with what is wrong with them."""
    _, quarantine = read_seed_sorted(spark, "raw_orders", _spoiled_seed(spark, folder))
    return quarantine.select("seed", "line", "reason")


@query
def parsed_orders(spark, folder):
    """The other lines of the same seed, typed."""
    return read_seed_sorted(spark, "raw_orders", _spoiled_seed(spark, folder))[0]


@query
def default_timestamps(spark, folder):
    raw = t.raw_customers(spark, folder, dirty=True)
    filled = with_load_times(raw.withColumn("given", F.col("created_at").cast("string")))
    now_set = F.col("created_at").isNotNull().cast("int").alias("filled")
    kept = (F.col("given") == F.col("created_at").cast("string")).cast("int").alias("kept")
    return filled.select("customer_id", now_set, kept)


@query
def synthetic_customers(spark, folder):
    return customers_from(t.scan(spark, folder, "customer", "c_custkey"), "c_custkey")


@query
def synthetic_orders(spark, folder):
    numbers = t.scan(spark, folder, "orders", "o_orderkey")
    return orders_from(numbers, "o_orderkey", customers=1000)


# Staging and scalars.


@query
def stg_customers(spark, folder):
    return t.staging(spark, folder, dirty=True)["stg_customers"]


@query
def stg_customers_calendar_age(spark, folder):
    raw = t.raw_customers(spark, folder, dirty=True)
    staged = stage_customers(raw, t.AS_OF, age="calendar", salt="pepper")
    return staged.select("customer_id", "customer_age", "customer_email_hash", "customer_phone_hash")


@query
def stg_orders(spark, folder):
    return t.staging(spark, folder, dirty=True)["stg_orders"]


@query
def stg_orders_upper_status(spark, folder):
    staged = t.staging(spark, folder, dirty=True, status_case="upper")["stg_orders"]
    return staged.select("order_id", "order_status", "payment_method", "region")


@query
def rejected_rows(spark, folder):
    rejected = rejected_orders(t.raw_orders(spark, folder, dirty=True))
    return rejected.select("order_id", "quantity", "unit_price", "order_date", "reject_reason")


@query
def order_amounts(spark, folder):
    q, p = F.col("quantity"), F.col("unit_price")
    return t.raw_orders(spark, folder).select(
        "order_id",
        money.gross_amount(q, p).alias("gross_amount"),
        money.tax_amount(q, p).alias("tax_amount"),
        money.total_amount(q, p).alias("total_amount"),
    )


@query
def customer_ages(spark, folder):
    """Both age rules on two days, one of them 28 February."""
    birth = F.col("date_of_birth")
    columns = [
        rule(birth, F.lit(day).cast("date")).alias(f"{name}_{day[:4]}")
        for day in (t.AS_OF, "2021-02-28")
        for name, rule in (
            ("completed", dates.age_completed_years),
            ("calendar", dates.age_calendar_years),
        )
    ]
    raw = t.raw_customers(spark, folder, dirty=True)
    return raw.filter(birth.isNotNull()).select("customer_id", "date_of_birth", *columns)


@query
def email_addresses(spark, folder):
    customer = t.scan(spark, folder, "customer", "c_custkey", "c_mktsegment", "c_name")
    address = text.email_address(
        F.col("c_mktsegment"),
        F.concat(F.lit("Sørby Öz "), F.col("c_name")),
        F.col("c_custkey"),
        F.lit("example.com"),
    )
    return customer.select("c_custkey", address.alias("email"))


@query
def missing_labels(spark, folder):
    raw = t.raw_customers(spark, folder, dirty=True)
    labels = [
        text.label(raw, "region").alias("region"),
        text.label(raw, "region", fill_nulls=True).alias("region_filled"),
        text.label(raw, "loyalty_tier").alias("loyalty_tier"),
    ]
    return raw.groupBy(*labels).agg(F.count("*").alias("customers"))


# Keys, hashes and masks.


@query
def pii_hashes(spark, folder):
    email = F.col("customer_email")
    return t.raw_customers(spark, folder, dirty=True).select(
        "customer_id",
        keys.pii_hash(email).alias("email_hash"),
        keys.pii_hash(email, "pepper").alias("salted_hash"),
    )


@query
def hash_keys(spark, folder):
    order, customer = F.col("order_id"), F.col("customer_id")
    return t.raw_orders(spark, folder, dirty=True).select(
        "order_id",
        keys.hash_key(order).alias("order_key"),
        keys.hash_key(order, customer).alias("pair_key"),
    )


@query
def sequence_keys_customers(spark, folder):
    staged = stage_customers(t.raw_customers(spark, folder), t.AS_OF)
    dim = build_dim_customers(staged, keys="sequence")
    return dim.select("customer_key", "customer_id", "region")


@query
def sequence_keys_orders(spark, folder):
    ids = t.raw_orders(spark, folder).select("order_id", "quantity")
    return with_sequence_key(ids, "order_id", "order_key")


def _masks(spark, folder, column, mask):
    return t.raw_customers(spark, folder, dirty=True).select(
        "customer_id",
        mask(F.col(column)).alias("strict_mask"),
        mask(F.col(column), strict=False).alias("loose_mask"),
    )


@query
def mask_emails(spark, folder):
    return _masks(spark, folder, "customer_email", masks.mask_email)


@query
def mask_phones(spark, folder):
    return _masks(spark, folder, "customer_phone", masks.mask_phone)


@query
def mask_full_names(spark, folder):
    return _masks(spark, folder, "customer_full_name", masks.mask_full_name)


# Access by role.


def _dim_for(role: str, strict: bool = True) -> Query:
    def run(spark, folder):
        dim = t.dim_customers(spark, folder, dirty=True).drop("updated_at")
        return access.secure(dim, "dim_customers", role, strict)

    return run


def _fct_for(role: str) -> Query:
    def run(spark, folder):
        return access.secure(t.marts(spark, folder, dirty=True)["fct_orders"], "fct_orders", role)

    return run


SHORT_ROLES = dict(zip(("engineer", "uk_analyst", "eu_analyst", "other_role"), ROLES))
for _short, _role in SHORT_ROLES.items():
    for _table, _make in (("dim_customers", _dim_for), ("fct_orders", _fct_for)):
        _run = _make(_role)
        _run.__name__ = f"{_table}_as_{_short}"
        query(_run)


@query
def dim_customers_loose_masks(spark, folder):
    return _dim_for("DATA_ANALYST_UK", strict=False)(spark, folder)


@query
def policy_report_customers(spark, folder):
    dim = t.dim_customers(spark, folder, dirty=True)
    return access.policy_report(dim, "dim_customers", ROLES)


@query
def policy_report_orders(spark, folder):
    fct = t.marts(spark, folder, dirty=True)["fct_orders"]
    return access.policy_report(fct, "fct_orders", ROLES)


@query
def masked_samples(spark, folder):
    dim = t.dim_customers(spark, folder)
    shown = [access.masked_sample(dim, "dim_customers", r, 5, "customer_id") for r in ROLES]
    return shown[0].unionByName(shown[1]).unionByName(shown[2]).unionByName(shown[3])


@query
def layer_gate(spark, folder):
    """Which tables each role may read, and the rows it then sees."""
    tables = t.raw(spark, folder, dirty=True) | t.staging(spark, folder, dirty=True)
    return access.layer_report(tables | t.marts(spark, folder, dirty=True), ROLES)


@query
def data_dictionary(spark, folder):
    """The described columns of the raw tables, with the rows that have a value."""
    tables = {n: document(df, SCHEMAS[n]) for n, df in t.raw(spark, folder, dirty=True).items()}
    described = schemas.data_dictionary(tables).filter("description IS NOT NULL")
    known = schemas.known_rows(tables)
    found = described.join(known, ["table_name", "column_name"])
    return found.select("table_name", "position", "column_name", "known_rows")


@query
def uk_analyst_revenue(spark, folder):
    fct = access.secure(t.marts(spark, folder)["fct_orders"], "fct_orders", "DATA_ANALYST_UK")
    return reports.revenue_by_region(fct)


@query
def eu_analyst_top_customers(spark, folder):
    mart = {
        name: access.secure(df, name, "DATA_ANALYST_EU")
        for name, df in t.marts(spark, folder).items()
    }
    return reports.top_customers(mart["dim_customers"], mart["fct_orders"])


@query
def sql_over_secured_views(spark, folder):
    tables = t.raw(spark, folder) | t.marts(spark, folder)
    access.register_views(tables, "DATA_ANALYST_EU")
    return spark.sql(
        """SELECT d.country, count(*) AS orders, sum(f.total_amount) AS spend
           FROM dim_customers d JOIN fct_orders f ON d.customer_key = f.customer_key
           GROUP BY d.country ORDER BY spend DESC, d.country"""
    )


def _functions(spark, folder, dirty) -> None:
    mart = t.marts(spark, folder, dirty)
    policies.register_functions({"dim_customers": mart["dim_customers"].drop("updated_at"), "fct_orders": mart["fct_orders"]})


@query
def dim_customers_by_function(spark, folder):
    """The customers that each role sees through the SQL function, with strict and loose masks."""
    _functions(spark, folder, dirty=True)
    parts = [
        spark.sql(f"SELECT '{short}' AS role, {str(strict).lower()} AS strict, * FROM secured_dim_customers('{role}', {str(strict).lower()})")
        for short, role in SHORT_ROLES.items()
        for strict in (True, False)
    ]
    return reduce(DataFrame.unionAll, parts)


@query
def sql_over_functions(spark, folder):
    """Plain SQL over the secured tables of an analyst; the masks as functions of single values."""
    _functions(spark, folder, dirty=False)
    return spark.sql(
        """SELECT d.country, count(*) AS orders, sum(f.total_amount) AS spend,
             max(mask_email('x.y@z.example', 'DATA_ANALYST_EU')) AS shown, max(may_see('UK', 'DATA_ANALYST_EU')) AS uk
           FROM secured_dim_customers('DATA_ANALYST_EU') d
           JOIN secured_fct_orders('DATA_ANALYST_EU') f ON d.customer_key = f.customer_key
           GROUP BY d.country"""
    )


@query
def catalog_dictionary(spark, folder):
    """Columns, types and keys of the stored tables as the catalog has them, after a refresh."""
    warehouse, database = _warehouse(spark, folder), f"mart_{uuid4().hex[:12]}"
    catalog.register(warehouse, database)
    build_marts(warehouse, t.AS_OF)
    tables = catalog.register(warehouse, database)
    found = catalog.dictionary(spark, database).filter("description IS NOT NULL AND table_description IS NOT NULL")
    known = catalog.known_values(spark, database, tables)
    return found.join(known, ["table_name", "column_name"]).select("table_name", "position", "column_name", "data_type", "key", "known_rows")


# Marts and joins.


@query
def dim_customers(spark, folder):
    raw = t.raw_customers(spark, folder, dirty=True)
    return build_dim_customers(stage_customers(raw, t.AS_OF), birth_date=True)


@query
def fct_orders(spark, folder):
    return t.marts(spark, folder, dirty=True)["fct_orders"]


@query
def orphan_raw_orders(spark, folder):
    tables = t.raw(spark, folder, dirty=True)
    lost = orphans(tables["raw_orders"], tables["raw_customers"], "customer_id", "customer_id")
    return lost.select("order_id", "customer_id", "order_date")


@query
def orphan_customer_ids(spark, folder):
    tables = t.raw(spark, folder, dirty=True)
    return orphan_keys(tables["raw_orders"], tables["raw_customers"], "customer_id", "customer_id")


@query
def split_fct_orders(spark, folder):
    """The fact with the orders of frequent buyers dealt to several tasks."""
    tables = t.staging(spark, folder, dirty=True)
    return build_fct_orders(tables["stg_orders"], build_dim_customers(tables["stg_customers"]), split_share=0.0008)


# Reports over the marts.


def _over_marts(report: Callable[..., DataFrame], *needed: str, name: str | None = None) -> None:
    def run(spark, folder):
        built = t.marts(spark, folder)
        return report(*[built[n] for n in needed])

    run.__name__ = name or report.__name__
    query(run)


_over_marts(reports.revenue_by_region, "fct_orders")
_over_marts(reports.revenue_by_category_and_region, "fct_orders")
_over_marts(reports.customer_spend, "dim_customers", "fct_orders")
_over_marts(reports.monthly_revenue, "fct_orders")
_over_marts(reports.status_distribution, "fct_orders")
_over_marts(reports.top_customers, "dim_customers", "fct_orders")
_over_marts(reports.orphan_orders, "dim_customers", "fct_orders")


@query
def orphan_mart_orders(spark, folder):
    """Orders whose customer has left the dimension."""
    mart = t.marts(spark, folder)
    stayed = mart["dim_customers"].filter(F.col("customer_since") >= SINCE_END)
    return reports.orphan_orders(stayed, mart["fct_orders"])


@query
def hierarchy_counts(spark, folder):
    raw, mart = t.raw(spark, folder, dirty=True), t.marts(spark, folder, dirty=True)
    return reports.hierarchy_counts(
        raw["raw_customers"], raw["raw_orders"], mart["dim_customers"], mart["fct_orders"]
    )


@query
def bucketed_customer_spend(spark, folder):
    """Spend over marts in buckets, part of whose orders were appended."""
    mart, database = t.marts(spark, folder), f"buckets_{uuid4().hex[:12]}"
    old = F.col("order_date") < HISTORY_END
    bucketed.store_buckets({"dim_customers": mart["dim_customers"], "fct_orders": mart["fct_orders"].filter(old)}, database, scratch_path(spark, "buckets"), 4)
    bucketed.append_buckets("fct_orders", mart["fct_orders"].filter(~old), database, 4)
    return reports.customer_spend(*bucketed.read_buckets(spark, database).values())


BUYERS_FROM, BUYERS_TO = "1996-01-01", "1996-12-31"


@query
def buyers_of_a_year(spark, folder):
    """Distinct buyers in a span of days, from states per day: whether the estimate lies in its bound."""
    fct = t.marts(spark, folder)["fct_orders"]
    found = reports.distinct_buyers(stored(reports.buyer_states(fct), "buyers"), BUYERS_FROM, BUYERS_TO)
    exact = reports.exact_buyers(fct, BUYERS_FROM, BUYERS_TO).select("order_region", F.col("buyers").alias("exact"))
    near = F.abs(F.col("buyers") - F.col("exact")) <= 3 * 1.04 / 64 * F.col("exact") + 1
    return found.join(exact, "order_region").select("order_region", "orders", near.alias("near"))


@query
def exact_buyers_of_a_year(spark, folder):
    return reports.exact_buyers(t.marts(spark, folder)["fct_orders"], BUYERS_FROM, BUYERS_TO)


# Reports over the raw tables.


@query
def order_distributions(spark, folder):
    return reports.order_distributions(t.raw_orders(spark, folder, dirty=True))


@query
def customer_distributions(spark, folder):
    return reports.customer_distributions(t.raw_customers(spark, folder, dirty=True))


@query
def customers_by_region(spark, folder):
    return reports.customers_by(t.raw_customers(spark, folder), "region")


@query
def customers_by_country(spark, folder):
    return reports.customers_by(t.raw_customers(spark, folder), "country")


@query
def customers_by_gender(spark, folder):
    return reports.gender_shares(t.raw_customers(spark, folder))


@query
def top_countries(spark, folder):
    return reports.top_countries(t.raw_customers(spark, folder))


@query
def orders_by_status(spark, folder):
    return reports.orders_by(t.raw_orders(spark, folder), "order_status")


@query
def orders_by_payment_method(spark, folder):
    return reports.orders_by(t.raw_orders(spark, folder), "payment_method")


@query
def net_revenue_by_region(spark, folder):
    return reports.net_revenue_by_region(t.raw_orders(spark, folder))


@query
def net_revenue_by_category(spark, folder):
    return reports.net_revenue_by_category(t.raw_orders(spark, folder))


@query
def top_categories(spark, folder):
    return reports.net_revenue_by_category(t.raw_orders(spark, folder, dirty=True), rows=8)


@query
def net_revenue_by_month(spark, folder):
    return reports.net_revenue_by_month(t.raw_orders(spark, folder))


@query
def net_revenue_by_month_pivot(spark, folder):
    return reports.net_revenue_by_month_pivot(t.raw_orders(spark, folder, dirty=True))


@query
def months(spark, folder):
    return reports.months(t.raw_orders(spark, folder))


@query
def quantity_histogram(spark, folder):
    return reports.quantity_histogram(t.raw_orders(spark, folder))


@query
def kpis(spark, folder):
    return reports.kpis(**t.raw(spark, folder))


@query
def table_counts(spark, folder):
    return reports.table_counts(t.raw(spark, folder))


# Data quality.


@query
def failing_emails(spark, folder):
    raw = t.raw_customers(spark, folder, dirty=True)
    bad = quality.failing_rows(raw, quality.contains("customer_email", "@"))
    return bad.select("customer_id", "customer_email")


@query
def failing_regions(spark, folder):
    raw = t.raw_customers(spark, folder, dirty=True)
    bad = quality.failing_rows(raw, quality.accepted_values("region", REGIONS, null_fails=True))
    return bad.select("customer_id", "region")


@query
def failing_statuses(spark, folder):
    staged = t.staging(spark, folder, dirty=True)["stg_orders"]
    bad = quality.failing_rows(staged, quality.accepted_values("order_status", ORDER_STATUSES))
    return bad.select("order_id", "order_status")


@query
def failing_ages(spark, folder):
    dim = t.dim_customers(spark, folder, dirty=True)
    bad = quality.accepted_range("customer_age", MIN_AGE, MAX_AGE)
    return quality.failing_rows(dim, bad).select("customer_id", "customer_age")


@query
def failing_totals(spark, folder):
    fct = t.spoiled_fact(t.marts(spark, folder)["fct_orders"])
    bad = quality.total_is_sum("total_amount", "gross_amount", "tax_amount")
    return quality.failing_rows(fct, bad).select(
        "order_id", "gross_amount", "tax_amount", "total_amount"
    )


@query
def failing_tax_rates(spark, folder):
    fct = t.marts(spark, folder, dirty=True)["fct_orders"]
    bad = quality.tax_rate("tax_amount", "gross_amount")
    return quality.failing_rows(fct, bad).select("order_id", "gross_amount", "tax_amount")


@query
def repeated_keys(spark, folder):
    counts = quality.key_counts(t.raw_orders(spark, folder, dirty=True), ["order_id", "customer_id"])
    return counts.filter(F.col("rows") > 1)


def stored(df, name):
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def _all_tables(spark, folder, dirty, keep=lambda df, name: df):
    """Every layer, derived from what ``keep`` makes of the layer before."""
    tables = {n: keep(df, n) for n, df in t.raw(spark, folder, dirty).items()}
    tables["stg_customers"] = keep(stage_customers(tables["raw_customers"], t.AS_OF), "stg_customers")
    tables["stg_orders"] = keep(stage_orders(tables["raw_orders"]), "stg_orders")
    tables["dim_customers"] = keep(build_dim_customers(tables["stg_customers"]), "dim_customers")
    fct = build_fct_orders(tables["stg_orders"], tables["dim_customers"])
    tables["fct_orders"] = keep(t.spoiled_fact(fct) if dirty else fct, "fct_orders")
    return tables


def _suite(name: str, suite: Callable, dirty: bool = True) -> None:
    def run(spark, folder):
        return quality.run_checks(_all_tables(spark, folder, dirty), suite())

    run.__name__ = name
    query(run)


_suite("declared_source_checks", suites.declared_sources)
_suite("declared_staging_checks", suites.declared_staging)
_suite("declared_mart_checks", suites.declared_marts)
_suite("asserted_raw_checks", suites.asserted_raw)
_suite("asserted_mart_checks", suites.asserted_marts)
_suite("defined_checks", suites.defined)
_suite("clean_mart_checks", suites.asserted_marts, dirty=False)


@query
def quality_report(spark, folder):
    """All suites together, sharing their passes, over tables that are derived and stored once."""
    tables = _all_tables(spark, folder, True, stored)
    return quality.run_checks(tables, suites.declared() + suites.asserted())


@query
def quality_summary(spark, folder):
    report = quality.run_checks(_all_tables(spark, folder, True), suites.asserted())
    return quality.summary(report)
