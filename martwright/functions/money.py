"""Order amounts and ratios in exact decimal arithmetic."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from martwright.domain import OPEN_QUANTITY_BUCKET, QUANTITY_BUCKETS, VAT_FACTOR, VAT_RATE

AMOUNT = "decimal(12,2)"
PRICE = "decimal(10,2)"


def _goods_value(quantity: Column, unit_price: Column) -> Column:
    return quantity.cast("decimal(10,0)") * unit_price.cast(PRICE)


def gross_amount(quantity: Column, unit_price: Column) -> Column:
    """Null if it does not fit, as are the other amounts; staging rejects such an order."""
    return F.round(_goods_value(quantity, unit_price), 2).try_cast(AMOUNT)


def tax_amount(quantity: Column, unit_price: Column) -> Column:
    return F.round(_goods_value(quantity, unit_price) * F.lit(Decimal(VAT_RATE)), 2).try_cast(AMOUNT)


def total_amount(quantity: Column, unit_price: Column) -> Column:
    """Rounded from the unrounded product, so it can differ by a penny from gross + tax."""
    return F.round(_goods_value(quantity, unit_price) * F.lit(Decimal(VAT_FACTOR)), 2).try_cast(AMOUNT)


def net_value(quantity: Column, unit_price: Column) -> Column:
    """Quantity times price without tax, unrounded."""
    return _goods_value(quantity, unit_price)


def ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """``numerator / denominator`` rounded half up once; null when the denominator is 0.

    The division keeps at least 14 decimals, so no result is rounded twice the way
    ``round(avg(decimal))`` is (Spark's ``avg`` already rounds to six decimals).
    """
    bottom = denominator.cast("decimal(20,0)")
    return F.round(numerator / F.nullif(bottom, F.lit(Decimal(0))), scale)


def mean_amount(total: Column, count: Column) -> Column:
    """Average amount in pence precision from a sum and a count."""
    return ratio(total.cast("decimal(22,2)"), count, 2).cast("decimal(14,2)")


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with one decimal."""
    return ratio(part.cast("decimal(20,0)") * F.lit(Decimal(100)), whole, 1).cast("decimal(6,1)")


def quantity_bucket(quantity: Column) -> Column:
    """Histogram label; a null quantity stays null instead of falling into the open bucket."""
    top = QUANTITY_BUCKETS[-1][0]
    chain = F.when(quantity > top, F.lit(OPEN_QUANTITY_BUCKET))
    for bound, name in QUANTITY_BUCKETS:
        chain = chain.when(quantity <= bound, F.lit(name))
    return chain


def quantity_bucket_rank(bucket: Column) -> Column:
    """Position of a bucket by size, for numeric instead of text order."""
    chain = F.when(bucket == OPEN_QUANTITY_BUCKET, F.lit(len(QUANTITY_BUCKETS) + 1))
    for position, (_, name) in enumerate(QUANTITY_BUCKETS, start=1):
        chain = chain.when(bucket == name, F.lit(position))
    return chain
