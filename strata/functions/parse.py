"""Parsers for dirty text columns.

ANSI mode is on by default in Spark 4, so a plain ``cast`` raises on
``''`` or ``'N/A'``; every parser here uses the ``try_`` forms and yields
NULL for text it cannot read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_number(c, to: str = "double") -> Column:
    """Coerce to a number; unreadable text becomes NULL."""
    return F.expr(f"try_cast({c} AS {to})") if isinstance(c, str) else c.try_cast(to)


def parse_price(c) -> Column:
    """Money text such as ``$1,234.50`` -> 1234.5 (NULL when unreadable)."""
    return F.translate(_col(c), "$,", "").try_cast("double")


def parse_percent(c) -> Column:
    """Percent text such as ``93%`` -> 93.0; ``N/A`` -> NULL."""
    return F.regexp_replace(_col(c), "%$", "").try_cast("double")


# Fixed value: the first number in the text, with an optional fraction.
COUNT_PATTERN = r"(\d+(\.\d+)?)"


def parse_count_text(c) -> Column:
    """Count from text (bathrooms): any mention of "half" is 0.5, otherwise
    the first number in the text; no number -> NULL."""
    c = _col(c)
    number = F.regexp_extract(c, COUNT_PATTERN, 1)
    return F.when(F.lower(F.trim(c)).like("%half%"), F.lit(0.5)).otherwise(number.try_cast("double"))


def parse_flag(c, null_as_false: bool = False, true_value: str = "t") -> Column:
    """'t'/'f' text -> boolean.

    ``null_as_false=False`` keeps NULL as NULL (``col == 't'``);
    ``True`` maps NULL and anything but ``true_value`` to false.
    """
    eq = _col(c) == F.lit(true_value)
    return F.coalesce(eq, F.lit(False)) if null_as_false else eq


def parse_list(c, trim_items: bool = True, empty_as_empty: bool = True) -> Column:
    """List text such as ``["Wifi", "Hot tub"]`` -> array<string>.

    Brackets, backslashes and double quotes are removed, then the text is
    split on commas. ``trim_items=True`` strips the space that follows each
    comma; ``False`` keeps it. ``[]`` gives an empty array, or -- with
    ``empty_as_empty=False``, as a plain split does -- one empty item.
    NULL stays NULL.
    """
    stripped = F.translate(_col(c), '][\\"', "")
    parts = F.split(stripped, ",")
    if empty_as_empty:
        parts = F.when(stripped == "", F.array().cast("array<string>")).otherwise(parts)
    return F.transform(parts, lambda x: F.trim(x)) if trim_items else parts


def parse_date(c, fmt: str = "yyyy-MM-dd", strip_time: bool = True) -> Column:
    """Date text -> date. ``strip_time`` drops a ``T...`` time suffix first
    (``2015-02-11T00:00:00Z``). Text in another layout gives NULL."""
    c = _col(c)
    if strip_time:
        c = F.regexp_replace(c, "T.*", "")
    return F.try_to_date(c, fmt)


def year_of(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Lenient year of a date text (NULL when not a date)."""
    return F.year(parse_date(c, fmt, strip_time=True))


def missing(c, dtype: str | None = None) -> Column:
    """Missing indicator: NULL, or NaN for floating columns."""
    c = _col(c)
    if dtype in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()
