"""Hashed keys and hashed personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martwright.domain import NULL_KEY_TOKEN


def hash_key(*parts: Column) -> Column:
    """Surrogate key: md5 over the parts, joined by ``-``, nulls replaced by a token.

    It needs no order, no counter and no shuffle, so it is the default at any size.
    """
    texts = [F.coalesce(p.cast("string"), F.lit(NULL_KEY_TOKEN)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def pii_hash(value: Column, salt: str | None = None) -> Column:
    """SHA-256 in hex; null stays null. Unsalted unless a salt is given."""
    return F.sha2(value if salt is None else F.concat(F.lit(salt), value), 256)
