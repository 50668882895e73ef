"""Synthetic customers and orders from a table of numbers.

Every value is a pure function of the row's number, so any partitioning gives the same rows, a
lost task can be run again, and no driver-side list is built. It is not bit-equal to a generator
that draws from one sequential random stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright import domain
from martwright.functions.text import email_address, padded_id

UK_FIRST = ("Alice", "Arthur", "Beth", "Callum", "Daisy", "Ewan", "Freya", "Gareth")
UK_LAST = ("Ashby", "Barlow", "Carter", "Dunmore", "Ellery", "Fletcher", "Garside", "Hollis")
EU_FIRST = ("Anneke", "Bruno", "Chiara", "Dieter", "Elise", "Fabio", "Greta", "Henrik")
EU_LAST = ("Böhm", "Sørby", "André", "Kühn", "van Dam", "Moreau", "Conti", "Lindqvist")
# Domains that are reserved for examples.
UK_MAIL = ("post.example", "letters.example.org", "inbox.example.com")
EU_MAIL = ("brief.example", "courrier.example.net", "posta.example.org", "correo.example.com")
# Country and its weight in percent.
UK_COUNTRIES = (("United Kingdom", 80), ("Jersey", 12), ("Guernsey", 8))
EU_COUNTRIES = (
    ("Portugal", 17),
    ("Czechia", 15),
    ("Greece", 14),
    ("Finland", 13),
    ("Hungary", 12),
    ("Croatia", 10),
    ("Slovakia", 8),
    ("Latvia", 6),
    ("Malta", 5),
)

ITEMS_PER_CATEGORY = 6


def draw(number: Column, attribute: str, size: int) -> Column:
    """A repeatable number in ``[0, size)`` for a row and an attribute.

    The leading 32 bits of an md5 over both, so the attributes of a row are independent draws.
    """
    digest = F.md5(F.concat(number.cast("string"), F.lit(f"/{attribute}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(size)


def pick(values: Sequence, index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def weighted(values: Sequence, weights: Sequence[int], point: Column) -> Column:
    """The value whose slice of the summed weights holds ``point``."""
    chain = F
    for value, end in zip(values, accumulate(weights), strict=True):
        chain = chain.when(point < end, F.lit(value))
    return chain


def region_of(customer: Column) -> Column:
    return F.when(draw(customer, "region", 100) < domain.UK_SHARE_PERCENT, "UK").otherwise("EU")


def customers_from(
    numbers: DataFrame, number: str, country: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Raw customers, one for each row of ``numbers``; ``keep`` names columns to carry along."""
    n = F.col("_n")

    def by_region(uk: Column, eu: Column) -> Column:
        return F.when(F.col("_region") == "UK", uk).otherwise(eu)

    def picked(uk: Sequence[str], eu: Sequence[str], attribute: str) -> Column:
        return by_region(*(pick(v, draw(n, attribute, len(v))) for v in (uk, eu)))

    if country is None:
        point = draw(n, "country", 100)
        country = by_region(*(weighted(*zip(*c), point) for c in (UK_COUNTRIES, EU_COUNTRIES)))
    numbers = numbers.withColumn("_n", F.col(number).cast("bigint")).withColumn("_region", region_of(n))
    drawn = numbers.select(
        "_n",
        "_region",
        picked(UK_FIRST, EU_FIRST, "first").alias("_first"),
        picked(UK_LAST, EU_LAST, "last").alias("_last"),
        picked(UK_MAIL, EU_MAIL, "mail").alias("_mail"),
        country.alias("country"),
        F.date_add(F.lit("2022-01-01").cast("date"), draw(n, "joined", 801).cast("int")).alias("_joined"),
        *keep,
    )
    parts = [draw(n, "phone_a", 900) + 100, draw(n, "phone_b", 900) + 100, draw(n, "phone_c", 9000) + 1000]
    digits = F.concat_ws(" ", *(part.cast("string") for part in parts))
    phone = by_region(
        F.concat(F.lit("+44 7"), digits),
        F.concat(F.lit("+"), (draw(n, "prefix", 19) + 31).cast("string"), F.lit(" "), digits),
    )
    birth = F.make_date(
        (draw(n, "birth_year", 56) + 1950).cast("int"),
        (draw(n, "birth_month", 12) + 1).cast("int"),
        (draw(n, "birth_day", 28) + 1).cast("int"),
    )
    names = F.col("_first"), F.col("_last")
    return drawn.select(
        padded_id("CUST", n).alias("customer_id"),
        F.concat_ws(" ", *names).alias("customer_full_name"),
        email_address(*names, n, F.col("_mail")).alias("customer_email"),
        phone.alias("customer_phone"),
        "country",
        F.col("_region").alias("region"),
        pick(domain.GENDERS, draw(n, "gender", len(domain.GENDERS))).alias("gender"),
        birth.alias("date_of_birth"),
        F.col("_joined").cast("timestamp").alias("created_at"),
        F.col("_joined").cast("timestamp").alias("updated_at"),
        *keep,
    )


def orders_from(
    numbers: DataFrame,
    number: str,
    customer: Column | None = None,
    order_date: Column | None = None,
    customers: int | None = None,
    keep: Sequence[str] = (),
    status: Column | None = None,
    pence: Column | None = None,
    hot_percent: int = 0,
) -> DataFrame:
    """Raw orders, one for each row of ``numbers``; given columns take the place of draws.

    The buyer is the given customer number, or one drawn from ``1 .. customers``, of whom the first
    has ``hot_percent`` of all orders besides. A product costs between 1.25 and 12.95, varied by a
    factor of 0.9 to 1.2 per order.
    """
    n = F.col("_n")
    if customer is None:
        customer = draw(n, "buyer", customers) + 1
        if hot_percent:
            customer = F.when(draw(n, "hot", 100) < hot_percent, 1).otherwise(customer)
    if order_date is None:
        order_date = F.date_add(F.lit("2022-01-01").cast("date"), draw(n, "day", 1001).cast("int"))
    products = len(domain.PRODUCT_CATEGORIES) * ITEMS_PER_CATEGORY
    product = F.col("_product")
    if pence is None:
        varied = (F.lit(125) + product * 397 % 1171) * (draw(n, "price", 301) + 900) + 500
        pence = F.floor(varied / 1000)
    if status is None:
        status = weighted(domain.ORDER_STATUSES, domain.ORDER_STATUS_WEIGHTS, draw(n, "status", 100))
    drawn = numbers.withColumn("_n", F.col(number).cast("bigint")).select(
        "*",
        customer.cast("bigint").alias("_customer"),
        order_date.alias("_date"),
        draw(n, "product", products).alias("_product"),
    )
    category = pick(domain.PRODUCT_CATEGORIES, F.floor(product / ITEMS_PER_CATEGORY))
    item = (product % ITEMS_PER_CATEGORY + 1).cast("string")
    price = (pence.cast("decimal(10,0)") * F.lit(Decimal("0.01"))).cast("decimal(10,2)")
    payment = pick(domain.PAYMENT_METHODS, draw(n, "payment", len(domain.PAYMENT_METHODS)))
    return drawn.select(
        padded_id("ORD", n).alias("order_id"),
        padded_id("CUST", F.col("_customer")).alias("customer_id"),
        F.col("_date").alias("order_date"),
        status.alias("order_status"),
        payment.alias("payment_method"),
        category.alias("product_category"),
        F.concat(F.upper(category), F.lit(", ITEM "), item).alias("product_description"),
        weighted(domain.QUANTITIES, domain.QUANTITY_WEIGHTS, draw(n, "quantity", 100)).alias("quantity"),
        price.alias("unit_price"),
        region_of(F.col("_customer")).alias("region"),
        F.col("_date").cast("timestamp").alias("created_at"),
        *keep,
    )


def generate(
    spark: SparkSession, customers: int, orders: int, hot_percent: int = 0
) -> tuple[DataFrame, DataFrame]:
    """``customers`` and ``orders`` synthetic rows, numbered from 1."""
    buyers = spark.range(1, customers + 1)
    sales = spark.range(1, orders + 1)
    made = orders_from(sales, "id", customers=customers, hot_percent=hot_percent)
    return customers_from(buyers, "id"), made
