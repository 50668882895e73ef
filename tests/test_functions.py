import datetime as dt
import hashlib
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martwright.functions import dates, keys, masks, money, text


def values(spark, rows, schema, *columns):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_title_case(spark):
    cases = {
        " credit card ": "Credit Card",
        "PayPal": "Paypal",
        "apple-pay": "Apple-Pay",
        "a  b -c/d": "A  B -C/D",
        "o'neil 3rd x2y": "O'Neil 3rd X2y",
        "élan vital": "Élan Vital",
        "": "",
        None: None,
    }
    got = values(spark, list(cases), "c string", text.title_case(F.col("c")))
    assert got == list(cases.values())


def test_upper_trim(spark):
    got = values(spark, [" uk ", "eu", None], "c string", text.upper_trim(F.col("c")))
    assert got == ["UK", "EU", None]


def test_email_address_and_padded_id(spark):
    row = [("Åsa Eva", "van Dér Müø", 123456, "web.de")]
    got = values(
        spark,
        row,
        "f string, l string, n long, d string",
        text.email_address(F.col("f"), F.col("l"), F.col("n"), F.col("d")),
        text.padded_id("CUST", F.col("n")),
        text.padded_id("CUST", F.lit(7)),
    )
    assert got == [("åsa.eva.van.der.muo_123456@web.de", "CUST-123456", "CUST-00007")]


def test_label(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert [r[0] for r in df.select(text.label(df, "c")).collect()] == ["a", None]
    assert [r[0] for r in df.select(text.label(df, "c", fill_nulls=True)).collect()] == [
        "a",
        "Unknown",
    ]
    assert [r[0] for r in df.select(text.label(df, "d")).collect()] == ["Unknown", "Unknown"]


def rounded(x):
    return x.quantize(Decimal("0.01"), ROUND_HALF_UP)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(1, 1000), st.integers(0, 100000)), min_size=1, max_size=50
    )
)
def test_amounts_round_half_up_from_the_exact_product(spark, pairs):
    rows = [(q, Decimal(p) / 100) for q, p in pairs]
    q, p = F.col("q"), F.col("p")
    got = values(
        spark,
        rows,
        "q int, p decimal(10,2)",
        money.gross_amount(q, p),
        money.tax_amount(q, p),
        money.total_amount(q, p),
    )
    assert got == [
        (rounded(a * b), rounded(a * b * Decimal("0.2")), rounded(a * b * Decimal("1.2")))
        for a, b in rows
    ]


def test_amount_types(spark):
    df = spark.createDataFrame([(1, Decimal("0.03"))], "q int, p decimal(10,2)")
    total = df.select(money.total_amount(F.col("q"), F.col("p")).alias("t"))
    assert total.schema["t"].dataType.simpleString() == "decimal(12,2)"


def test_mean_rounds_once(spark):
    # 0.00499999... must not become 0.01 by way of 0.005000.
    rows = [(Decimal("0.01"), 2), (Decimal("1.00"), 201), (Decimal("49999.99"), 10000000), (None, 0)]
    got = values(
        spark, rows, "s decimal(22,2), n long", money.mean_amount(F.col("s"), F.col("n"))
    )
    assert got == [Decimal("0.01"), Decimal("0.00"), Decimal("0.00"), None]


def test_percent(spark):
    got = values(
        spark,
        [(1, 3), (1, 2000), (3, 2000), (5, 5), (0, 0)],
        "a long, b long",
        money.percent(F.col("a"), F.col("b")),
    )
    assert got == [Decimal("33.3"), Decimal("0.1"), Decimal("0.2"), Decimal("100.0"), None]


def test_quantity_buckets(spark):
    bucket = money.quantity_bucket(F.col("q"))
    rows = [0, 1, 2, 3, 4, 6, 7, 12, 13, 24, 25, 1000, None]
    got = values(spark, rows, "q int", bucket, money.quantity_bucket_rank(bucket))
    names = ["1", "1", "2-3", "2-3", "4-6", "4-6", "7-12", "7-12", "13-24", "13-24", "25+", "25+"]
    ranks = [1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6]
    assert got == list(zip(names, ranks)) + [(None, None)]


def completed(birth, day):
    if birth > day:
        return -completed(day, birth)
    return day.year - birth.year - ((day.month, day.day) < (birth.month, birth.day))


DAYS = st.dates(dt.date(1900, 1, 1), dt.date(2060, 12, 31))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(DAYS, DAYS), min_size=1, max_size=60))
def test_ages(spark, pairs):
    birth, day = F.col("b"), F.col("d")
    got = values(
        spark,
        pairs,
        "b date, d date",
        dates.age_completed_years(birth, day),
        dates.age_calendar_years(birth, day),
    )
    assert got == [(completed(b, d), d.year - b.year) for b, d in pairs]


def test_leap_day_age_and_nulls(spark):
    leap = dt.date(2000, 2, 29)
    rows = [(leap, dt.date(2021, 2, 28)), (leap, dt.date(2021, 3, 1)), (None, leap), (leap, None)]
    got = values(
        spark, rows, "b date, d date", dates.age_completed_years(F.col("b"), F.col("d"))
    )
    assert got == [20, 21, None, None]


def test_month_key(spark):
    rows = [dt.date(2021, 1, 3), dt.date(2020, 12, 31), None]
    assert values(spark, rows, "d date", dates.month_key(F.col("d"))) == ["2021-01", "2020-12", None]


def test_hashes(spark):
    got = values(
        spark,
        [("x", 7), (None, 7)],
        "a string, b int",
        keys.hash_key(F.col("a")),
        keys.hash_key(F.col("a"), F.col("b")),
        keys.pii_hash(F.col("a")),
        keys.pii_hash(F.col("a"), "s"),
    )

    def md5(v):
        return hashlib.md5(v.encode()).hexdigest()

    def sha(v):
        return hashlib.sha256(v.encode()).hexdigest()

    none = "_dbt_utils_surrogate_key_null_"
    assert got == [(md5("x"), md5("x-7"), sha("x"), sha("sx")), (md5(none), md5(none + "-7"), None, None)]


MASKED = [
    # mask, value, strict, loose
    (masks.mask_email, "john.smith@gmail.com", "j***@gmail.com", "j***@gmail.com"),
    (masks.mask_email, "a@b@c.com", "a***@c.com", "a***@c.com"),
    (masks.mask_email, "_x@y.com", "***", "_x@y.com"),
    (masks.mask_email, "nobody", "***", "nobody"),
    (masks.mask_email, "ab\nc@x.com", "a***@x.com", "ab\nc@x.com"),
    (masks.mask_email, "", "***", ""),
    (masks.mask_email, None, None, None),
    (masks.mask_phone, "+44 7123 456 7890", "+44 *** *** 7890", "+44 *** *** 7890"),
    (masks.mask_phone, "07123 456789", "***", "07123 456789"),
    (masks.mask_phone, "at +44 7123 456 7890, home", "***", "at +44 *** *** 7890, home"),
    (masks.mask_phone, None, None, None),
    (masks.mask_full_name, "John Smith", "J***", "J***"),
    (masks.mask_full_name, "Émile Zola", "É***", "Émile Zola"),
    (masks.mask_full_name, "John\nSmith", "J***", "J***\nSmith"),
    (masks.mask_full_name, "7th Man", "***", "7th Man"),
    (masks.mask_full_name, None, None, None),
]


@pytest.mark.parametrize("mask", [masks.mask_email, masks.mask_phone, masks.mask_full_name])
def test_masks(spark, mask):
    cases = [c for c in MASKED if c[0] is mask]
    got = values(
        spark, [c[1] for c in cases], "v string", mask(F.col("v")), mask(F.col("v"), strict=False)
    )
    assert got == [(c[2], c[3]) for c in cases]
