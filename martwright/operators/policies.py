"""Masks and row policies as SQL functions, for those who write SQL only.

Each function's body is one expression, or one query, that Spark puts in the place of the call, so a
role that is given as a literal leaves a plain ``region = 'UK'`` filter that reaches the scan. The
functions belong to the session. As with views, they are no protection against someone who can read
the files.

    SELECT * FROM secured_dim_customers('DATA_ANALYST_UK')
    SELECT mask_email(customer_email, 'DATA_ANALYST_EU', true) FROM ...
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from martwright.domain import (
    ANALYST_REGION,
    EMAIL_PATTERN,
    ENGINEER,
    HIDDEN,
    NAME_PATTERN,
    PHONE_PATTERN,
)
from martwright.functions.masks import EMAIL_SHOWN, NAME_SHOWN, PHONE_SHOWN, STRICT_EMAIL, STRICT_NAME, STRICT_PHONE
from martwright.operators.access import MASKING_POLICIES, ROW_POLICIES

PATTERNS = {
    "mask_email": (EMAIL_PATTERN, STRICT_EMAIL, EMAIL_SHOWN),
    "mask_phone": (PHONE_PATTERN, STRICT_PHONE, PHONE_SHOWN),
    "mask_full_name": (NAME_PATTERN, STRICT_NAME, NAME_SHOWN),
}


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _analysts() -> str:
    return ", ".join(map(_text, ANALYST_REGION))


def mask_sql(value: str, name: str, role: str, strict: str) -> str:
    """What a role sees of a value: raw for the engineer, masked for analysts, hidden for others."""
    loose, whole, shown = map(_text, PATTERNS[name])
    return f"""CASE WHEN {role} = {_text(ENGINEER)} THEN {value}
      WHEN {role} IN ({_analysts()}) AND NOT {strict} THEN regexp_replace({value}, {loose}, {shown})
      WHEN {role} IN ({_analysts()}) AND {value} RLIKE {whole} THEN regexp_replace({value}, {whole}, {shown})
      WHEN {role} IN ({_analysts()}) AND {value} IS NULL THEN NULL
      ELSE {_text(HIDDEN)} END"""


def may_see_sql(region: str, role: str) -> str:
    """Whether a role sees a region's rows, as alternatives of which a given role leaves one."""
    sides = [f"{role} = {_text(ENGINEER)}"]
    sides += [f"({role} = {_text(analyst)} AND {region} = {_text(own)})" for analyst, own in ANALYST_REGION.items()]
    return "(" + " OR ".join(sides) + ")"


def register_functions(tables: dict[str, DataFrame]) -> list[str]:
    """Session functions for the masks, the row rule and every table that has a row policy.

    ``mask_*(value, role, strict)``, ``may_see(region, role)``, and ``secured_<table>(role, strict)``, which
    gives the table as the role sees it; ``strict`` is true by default. The tables' rows are read when
    the functions are called. The names of the functions.
    """
    spark = next(iter(tables.values())).sparkSession
    made = []

    def create(name: str, arguments: str, returns: str, body: str) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {returns} RETURN {body}")
        made.append(name)

    for name in PATTERNS:
        body = mask_sql("value", name, "role", "coalesce(strict, true)")
        create(name, "value STRING, role STRING, strict BOOLEAN DEFAULT true", "STRING", body)
    create("may_see", "region STRING, role STRING", "BOOLEAN", f"coalesce({may_see_sql('region', 'role')}, false)")
    for table, region in ROW_POLICIES.items():
        if table not in tables:
            continue
        df = tables[table]
        source = f"_rows_of_{table}"
        df.createOrReplaceTempView(source)
        masks = MASKING_POLICIES.get(table, {})

        def shown(column: str, masks: dict = masks) -> str:
            if column not in masks:
                return f"t.`{column}`"
            return f"{mask_sql(f't.`{column}`', masks[column].__name__, 'role', 'coalesce(strict, true)')} AS `{column}`"

        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        body = f"SELECT {', '.join(map(shown, df.columns))} FROM {source} AS t WHERE {may_see_sql(f't.`{region}`', 'role')}"
        create(f"secured_{table}", "role STRING, strict BOOLEAN DEFAULT true", f"TABLE({columns})", body)
    return made
