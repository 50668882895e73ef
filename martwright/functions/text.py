"""Cleaning and assembling strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.domain import ACCENTS_FROM, ACCENTS_TO

def upper_trim(c: Column) -> Column:
    return F.upper(F.trim(c))


def title_case(c: Column) -> Column:
    """First letter of every word upper, the rest lower; ``PayPal`` becomes ``Paypal``.

    A word is a run of letters and digits, so ``apple-pay`` becomes ``Apple-Pay``. Spark's
    ``initcap`` starts words at blanks only; values with other separators get a blank after each
    of them for its sake, which is taken out again.
    """
    text = F.trim(c)
    spaced = F.initcap(F.regexp_replace(text, r"([^\p{L}\p{N}])", "$1 "))
    by_separator = F.regexp_replace(spaced, r"([^\p{L}\p{N}]) ", "$1")
    return F.when(text.rlike(r"[^\p{L}\p{N} ]"), by_separator).otherwise(F.initcap(text))


def email_address(first: Column, last: Column, number: Column, domain: Column) -> Column:
    """``first.last_number@domain`` in lower case, accents replaced and blanks turned to dots."""
    surname = F.translate(F.lower(last), ACCENTS_FROM, ACCENTS_TO)
    address = F.concat(
        F.lower(first), F.lit("."), surname, F.lit("_"), number.cast("string"), F.lit("@"), domain
    )
    return F.replace(address, F.lit(" "), F.lit("."))


def padded_id(prefix: str, number: Column) -> Column:
    """``CUST-00042``: at least five digits, longer numbers are never cut."""
    digits = number.cast("string")
    short = (number >= 0) & (number < 100_000)
    padded = F.when(short, F.lpad(digits, 5, "0")).when(number >= 0, digits)
    return F.concat(F.lit(f"{prefix}-"), F.coalesce(padded, F.format_string("%05d", number)))


def label(df: DataFrame, column: str, missing: str = "Unknown", fill_nulls: bool = False) -> Column:
    """``column`` as a group label; ``missing`` when the table has no such column.

    A null in an existing column stays its own (null) group unless ``fill_nulls`` is set.
    """
    if column not in df.columns:
        return F.lit(missing)
    return F.coalesce(F.col(column), F.lit(missing)) if fill_nulls else F.col(column)
