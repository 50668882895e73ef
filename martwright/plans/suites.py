"""The check suites for the raw, staging and mart tables.

``DECLARED`` holds the rules declared with the tables; nulls pass them unless a not-null rule says
otherwise. ``ASSERTED`` holds the assertions made on the loaded data; nulls fail them.
"""

from __future__ import annotations

from martwright.domain import MAX_AGE, MIN_AGE, ORDER_STATUSES, REGIONS
from martwright.operators import quality as q


def declared_sources() -> list[q.TableChecks]:
    return [
        q.TableChecks(
            "raw_customers",
            [
                q.unique("customer_id"),
                q.not_null("customer_id"),
                q.not_null("customer_email"),
                q.accepted_values("region", REGIONS),
                q.not_null("country"),
            ],
        ),
        q.TableChecks(
            "raw_orders",
            [
                q.unique("order_id"),
                q.not_null("order_id"),
                q.relationship("customer_id", "raw_customers", "customer_id"),
                q.not_null("quantity"),
                q.accepted_range("quantity", low=1),
                q.not_null("unit_price"),
                q.accepted_range("unit_price", low=0),
                q.accepted_values("region", REGIONS),
            ],
        ),
    ]


def declared_staging() -> list[q.TableChecks]:
    return [
        q.TableChecks(
            "stg_customers",
            [
                q.unique("customer_id"),
                q.not_null("customer_id"),
                q.accepted_values("region", REGIONS),
            ],
        ),
        q.TableChecks(
            "stg_orders",
            [
                q.unique("order_id"),
                q.not_null("order_id"),
                q.not_null("customer_id"),
                q.accepted_range("quantity", low=1),
                q.accepted_range("total_amount", low=0),
            ],
        ),
    ]


def declared_marts() -> list[q.TableChecks]:
    return [
        q.TableChecks(
            "dim_customers",
            [
                q.unique("customer_key"),
                q.not_null("customer_key"),
                q.unique("customer_id"),
                q.not_null("customer_id"),
                q.not_null("customer_email"),
                q.not_null("region"),
                q.accepted_values("region", REGIONS),
                q.accepted_range("customer_age", MIN_AGE, MAX_AGE),
                q.not_null("country"),
                q.not_null("customer_since"),
            ],
        ),
        q.TableChecks(
            "fct_orders",
            [
                q.unique("order_key"),
                q.not_null("order_key"),
                q.unique("order_id"),
                q.not_null("order_id"),
                q.not_null("customer_key"),
                q.relationship("customer_key", "dim_customers", "customer_key"),
                q.not_null("customer_id"),
                q.not_null("order_status"),
                q.accepted_values("order_status", ORDER_STATUSES),
                q.not_null("quantity"),
                q.accepted_range("quantity", 1, 1000),
                q.not_null("unit_price"),
                q.accepted_range("unit_price", 0, 1000),
                q.not_null("total_amount"),
                q.accepted_range("total_amount", 0, 100000),
                q.not_null("order_region"),
                q.accepted_values("order_region", REGIONS),
                q.not_null("order_date"),
            ],
        ),
    ]


def asserted_raw() -> list[q.TableChecks]:
    return [
        q.TableChecks(
            "raw_customers",
            [
                q.all_different("customer_id"),
                q.not_null("customer_id"),
                q.contains("customer_email", "@"),
                q.not_blank("customer_email"),
                q.accepted_values("region", REGIONS, null_fails=True),
                q.not_blank("country"),
                q.non_empty(),
            ],
        ),
        q.TableChecks(
            "raw_orders",
            [
                q.all_different("order_id"),
                q.not_null("order_id"),
                q.positive("quantity"),
                q.non_negative("unit_price"),
                q.accepted_values("region", REGIONS, null_fails=True),
                q.not_null("order_date"),
                q.accepted_values("order_status", ORDER_STATUSES, null_fails=True),
                q.relationship("customer_id", "raw_customers", "customer_id", null_passes=False),
                q.non_empty(),
            ],
        ),
    ]


def asserted_marts() -> list[q.TableChecks]:
    return [
        q.TableChecks(
            "dim_customers",
            [
                q.all_different("customer_key"),
                q.all_different("customer_id"),
                q.accepted_range("customer_age", MIN_AGE, MAX_AGE, null_fails=True),
                q.accepted_values("region", REGIONS, null_fails=True),
                q.not_null("customer_since"),
                q.non_empty(),
            ],
        ),
        q.TableChecks(
            "fct_orders",
            [
                q.all_different("order_key"),
                q.all_different("order_id"),
                q.relationship("customer_key", "dim_customers", "customer_key", null_passes=False),
                q.non_negative("total_amount"),
                q.total_is_sum("total_amount", "gross_amount", "tax_amount"),
                q.tax_rate("tax_amount", "gross_amount"),
                q.accepted_values("order_region", REGIONS, null_fails=True),
                q.non_empty(),
            ],
        ),
    ]


# What the table definitions demand. Columns that may not be null, and the longest texts.
DEFINED = {
    "raw_customers": (
        ("customer_id", "customer_full_name", "customer_email", "country", "region"),
        {"customer_id": 20, "region": 4, "gender": 4},
    ),
    "raw_orders": (
        ("order_id", "customer_id", "order_date", "order_status", "quantity", "unit_price", "region"),
        {"order_id": 20, "customer_id": 20, "order_status": 20, "payment_method": 20, "product_category": 50, "region": 4},
    ),
    "dim_customers": (("customer_id",), {"customer_id": 20, "region": 4, "gender": 4}),
    "fct_orders": (
        (
            "order_id customer_id order_date order_status quantity unit_price gross_amount tax_amount "
            "total_amount order_region"
        ).split(),
        {"order_id": 20, "customer_id": 20, "order_status": 20, "payment_method": 20, "product_category": 50, "order_region": 4},
    ),
}


def defined() -> list[q.TableChecks]:
    """The rules that the tables' definitions would enforce in a database."""
    return [
        q.TableChecks(table, [q.not_null(c) for c in needed] + [q.max_length(c, n) for c, n in longest.items()])
        for table, (needed, longest) in DEFINED.items()
    ]


def declared() -> list[q.TableChecks]:
    return declared_sources() + declared_staging() + declared_marts()


def asserted() -> list[q.TableChecks]:
    return asserted_raw() + asserted_marts()
