"""Who sees which rows, and how personal data looks to them.

The role is resolved in Python, so a policy reaches Spark as a plain ``column = literal`` filter,
which the Parquet scan can use to skip files and row groups. The filter comes before the masks.

A filtered DataFrame is a view of the data, not a security boundary: someone who can read the
files, or run Python in the same session, can read everything. Grant file access accordingly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.domain import ANALYST_REGION, ENGINEER, HIDDEN
from martwright.functions.masks import mask_email, mask_full_name, mask_phone

Mask = Callable[[Column, bool], Column]

ROW_POLICIES: dict[str, str] = {"dim_customers": "region", "fct_orders": "order_region"}

MASKING_POLICIES: dict[str, dict[str, Mask]] = {
    "dim_customers": {
        "customer_email": mask_email,
        "customer_phone": mask_phone,
        "customer_full_name": mask_full_name,
    }
}

MART_TABLES = frozenset(ROW_POLICIES)


class AccessDenied(PermissionError):
    """The role may not read this table."""


def may_see(region: Column, role: str) -> Column:
    """All rows for the engineer, one region for an analyst, none for any other role.

    Role names match exactly; administrators above the engineer see nothing either. A row without
    a region is hidden from analysts.
    """
    if role in ANALYST_REGION:
        return region == F.lit(ANALYST_REGION[role])
    return F.lit(role == ENGINEER)


def visible_rows(df: DataFrame, region_column: str, role: str) -> DataFrame:
    return df.filter(may_see(F.col(region_column), role))


def masked_for(value: Column, mask: Mask, role: str, strict: bool = True) -> Column:
    """Raw for the engineer, partly masked for analysts, hidden for any other role."""
    if role == ENGINEER:
        return value
    if role in ANALYST_REGION:
        return mask(value, strict)
    return F.lit(HIDDEN)


def mask_columns(df: DataFrame, table: str, role: str, strict: bool = True) -> DataFrame:
    policies = MASKING_POLICIES.get(table, {})
    return df.withColumns(
        {
            column: masked_for(F.col(column), mask, role, strict)
            for column, mask in policies.items()
            if column in df.columns
        }
    )


def check_layer(table: str, role: str) -> None:
    """Raw and staging tables are for the engineer only.

    Any role may ask for a mart table: its row policy shows other roles no rows.
    """
    if role != ENGINEER and table not in MART_TABLES:
        raise AccessDenied(f"{role} may not read {table}")


def secure(df: DataFrame, table: str, role: str, strict: bool = True) -> DataFrame:
    """The table as the role sees it: rows filtered, then personal data masked."""
    check_layer(table, role)
    if table in ROW_POLICIES:
        df = visible_rows(df, ROW_POLICIES[table], role)
    return mask_columns(df, table, role, strict)


def register_views(tables: dict[str, DataFrame], role: str, strict: bool = True) -> list[str]:
    """Temp views for SQL, each as the role sees it; tables closed to the role get none."""
    opened = []
    for table, df in tables.items():
        try:
            view = secure(df, table, role, strict)
        except AccessDenied:
            df.sparkSession.catalog.dropTempView(table)
            continue
        view.createOrReplaceTempView(table)
        opened.append(table)
    return opened


def layer_report(tables: dict[str, DataFrame], roles: Sequence[str]) -> DataFrame:
    """Whether each role may read each table, and how many rows it sees; one pass over each table.

    A table that is closed to a role shows it 0 rows.
    """
    parts = []
    for table, df in tables.items():
        region = F.col(ROW_POLICIES[table]) if table in ROW_POLICIES else F.lit(None)
        seen = []
        for role in roles:
            try:
                check_layer(table, role)
            except AccessDenied:
                seen.append((role, False, F.lit(False)))
            else:
                shown = may_see(region, role) if table in ROW_POLICIES else F.lit(True)
                seen.append((role, True, shown))
        counts = df.agg(*(F.count_if(shown).alias(f"n{i}") for i, (_, _, shown) in enumerate(seen)))
        rows = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(role).alias("role"),
                F.lit(allowed).alias("allowed"),
                F.col(f"n{i}").alias("visible_rows"),
            )
            for i, (role, allowed, _) in enumerate(seen)
        ]
        parts.append(counts.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionAll, parts)


def policy_report(df: DataFrame, table: str, roles: Sequence[str]) -> DataFrame:
    """Every region a role sees and its rows, one row each; one pass over the table for all roles.

    A role that sees nothing has one row, without a region and with 0 rows.
    """
    region = F.col(ROW_POLICIES[table])
    by_region = df.groupBy(region.alias(ROW_POLICIES[table])).agg(F.count("*").alias("visible_rows"))
    seeing = F.filter(F.array(*[F.when(may_see(region, role), F.lit(role)) for role in roles]), F.isnotnull)
    seen = by_region.select(F.explode(seeing).alias("role"), region.alias("region"), "visible_rows")
    asked = df.sparkSession.createDataFrame([(table, role) for role in roles], "table_name string, role string")
    found = asked.join(seen, "role", "left").select("table_name", "role", "region", "visible_rows")
    return found.na.fill({"visible_rows": 0})


def masked_sample(df: DataFrame, table: str, role: str, rows: int, order_by: str) -> DataFrame:
    """The first few rows of the masked columns, to look at a policy's effect."""
    shown = [c for c in MASKING_POLICIES.get(table, {}) if c in df.columns]
    seen = secure(df, table, role)
    return seen.orderBy(order_by).limit(rows).select(F.lit(role).alias("role"), order_by, *shown)
