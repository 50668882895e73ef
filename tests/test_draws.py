"""Drawn attributes are digests of the row's number, in the library and in the SQL."""

import hashlib

import duckdb
from pyspark.sql import functions as F

from martwright.sources.synthetic import draw
from verification.oracle import _draw


def test_draws_are_digests_in_spark_and_in_sql(spark):
    numbers = [0, 1, 42, 149_999, 2**31 - 1, 2**40]

    def expected(n, attribute, size):
        return int(hashlib.md5(f"{n}/{attribute}".encode()).hexdigest()[:8], 16) % size

    for attribute, size in (("region", 100), ("birth_year", 56), ("phone_c", 9000)):
        wanted = [expected(n, attribute, size) for n in numbers]
        rows = spark.createDataFrame([(n,) for n in numbers], "n bigint").select("n", draw(F.col("n"), attribute, size))
        assert [value for _, value in sorted(rows.collect())] == wanted
        sql = f"SELECT n, {_draw('n', attribute, size)} FROM (SELECT unnest({numbers}::BIGINT[]) AS n) ORDER BY n"
        assert [value for _, value in duckdb.sql(sql).fetchall()] == wanted


def test_a_null_number_draws_nothing(spark):
    rows = spark.createDataFrame([(None,)], "n bigint").select(draw(F.col("n"), "region", 100))
    assert rows.first()[0] is None
