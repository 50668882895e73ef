"""Partial masks for personal data.

A pattern mask leaves a value that does not match its pattern readable. The strict form, the
default, hides such values altogether; ``strict=False`` gives the plain pattern replacement.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martwright.domain import EMAIL_PATTERN, HIDDEN, NAME_PATTERN, PHONE_PATTERN

# The strict forms match the whole value (also over line breaks) and accept any letter.
STRICT_EMAIL = r"(?s)\A([a-zA-Z0-9]).*(@[^@\s]+)\z"
STRICT_PHONE = r"\A\s*(\+\d{1,3})\s+\d{3,}\s+\d{3,}\s+(\d{4})\s*\z"
STRICT_NAME = r"(?s)\A(\p{L}).*\z"
EMAIL_SHOWN, PHONE_SHOWN, NAME_SHOWN = "$1***$2", "$1 *** *** $2", "$1***"


def _mask(value: Column, loose: str, strict_form: str, replacement: str, strict: bool) -> Column:
    if not strict:
        return F.regexp_replace(value, loose, replacement)
    masked = F.regexp_replace(value, strict_form, replacement)
    return F.when(value.rlike(strict_form), masked).when(value.isNotNull(), F.lit(HIDDEN))


def mask_email(value: Column, strict: bool = True) -> Column:
    """``john.smith@gmail.com`` becomes ``j***@gmail.com``."""
    return _mask(value, EMAIL_PATTERN, STRICT_EMAIL, EMAIL_SHOWN, strict)


def mask_phone(value: Column, strict: bool = True) -> Column:
    """``+44 7123 456 7890`` becomes ``+44 *** *** 7890``."""
    return _mask(value, PHONE_PATTERN, STRICT_PHONE, PHONE_SHOWN, strict)


def mask_full_name(value: Column, strict: bool = True) -> Column:
    """``John Smith`` becomes ``J***``."""
    return _mask(value, NAME_PATTERN, STRICT_NAME, NAME_SHOWN, strict)
