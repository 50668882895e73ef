"""Run the registered queries on Spark and DuckDB and compare the results.

``python -m verification.compare [FOLDER] [QUERY ...]``
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from martwright.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _sorted(rows: list[tuple], names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between the two results, or None."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = _sorted(cursor.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    for field in df.schema:
        if TYPES.get(field.dataType.simpleString()) != types[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()}, {types[field.name]}"
    got = _sorted([tuple(r) for r in df.collect()], df.columns)
    if len(got) != len(expected):
        return f"{len(got)} rows against {len(expected)}"
    for mine, theirs in zip(got, expected):
        if mine != theirs:
            return f"{mine} against {theirs}"
    return None


def main() -> int:
    from verification.oracle import ORACLE
    from verification.queries import QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection = local_session(), connect(folder)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            found = difference(df, connection, ORACLE[name]) if name in ORACLE else "no SQL"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        mark = "ok  " if found is None else "DIFF"
        print(f"{mark} {time.time() - start:6.2f}s {name} {found or ''}", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or QUERIES)} differ")
    return min(bad, 1)


if __name__ == "__main__":
    sys.exit(main())
