"""Validators written as native expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the e-mail shape accepted by the reference's validator.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def valid_email(c) -> Column:
    """True when the text looks like an e-mail address; NULL -> false."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.rlike(EMAIL_PATTERN), F.lit(False))
