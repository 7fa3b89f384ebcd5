"""Arithmetic that survives dirty data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (plain ``/`` raises under ANSI)."""
    return F.try_divide(_col(num).cast("double"), _col(den))


def convert_currency(price, area, rates: dict[str, float]) -> Column:
    """Multiply ``price`` by the rate of its ``area`` when the price is
    non-NULL and non-zero; other rows keep their price.

    ``rates`` is a small, bounded mapping, so it becomes one CASE expression
    (no join). The direction of each rate is the caller's choice.
    """
    price, area = _col(price), _col(area)
    if not rates:
        return price
    # NULL and 0 prices are unchanged by a product, so one multiplication by
    # the area's rate (1.0 for other areas) gives the same values while the
    # price expression is referenced once.
    rate = None
    for name, r in rates.items():
        cond = area == F.lit(name)
        rate = F.when(cond, F.lit(float(r))) if rate is None else rate.when(cond, F.lit(float(r)))
    return price * rate.otherwise(F.lit(1.0))
