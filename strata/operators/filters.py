"""Filters and predicates: ranges, NULL handling, castability, quantile trims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.aggregate import quantile
from strata.operators.joins import join_on_keys
from strata.operators.reshape import unpivot_pairs


def filter_range(df: DataFrame, col: str, lt=None, le=None, gt=None, ge=None) -> DataFrame:
    """Keep rows inside the bounds; NULLs fall out (SQL comparison)."""
    cond = F.lit(True)
    c = F.col(col)
    if lt is not None:
        cond = cond & (c < F.lit(lt))
    if le is not None:
        cond = cond & (c <= F.lit(le))
    if gt is not None:
        cond = cond & (c > F.lit(gt))
    if ge is not None:
        cond = cond & (c >= F.lit(ge))
    return df.filter(cond)


def count_extreme(df: DataFrame, col: str, threshold) -> DataFrame:
    """One-row count of rows with ``col >= threshold``."""
    return df.filter(F.col(col) >= F.lit(threshold)).agg(F.count(F.lit(1)).alias("n_extreme"))


def filter_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def dropna_subset(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with NULL (or NaN) in any of ``cols``."""
    return df.dropna(subset=cols)


def uncastable_values(df: DataFrame, cols: list[str], to: str = "double") -> DataFrame:
    """Distinct (column_name, value) pairs that are non-NULL yet not castable
    to ``to`` -- all columns in one scan (unpivot + filter + distinct)."""
    text = df.select(*[F.col("`" + c.replace("`", "``") + "`").cast("string").alias(c) for c in cols])
    long = unpivot_pairs(text, [(c, c) for c in cols], "column_name", "value", keep=[])
    return (long.filter(F.col("value").isNotNull() & F.col("value").try_cast(to).isNull())
            .distinct())


def quantile_trim(df: DataFrame, col: str, q: float = 0.99, by: list[str] | None = None,
                  approx: bool = False) -> DataFrame:
    """Keep rows with ``col <= quantile(col, q)`` (per group when ``by``).

    The quantile is exact with linear interpolation, from the distributed
    selection in ``aggregate.quantiles`` (no task holds a whole group). A
    global cut is a scalar subquery; per-group cuts are joined back.
    """
    if not by:
        # Scalar subquery: evaluated once, then a plain filter on each row.
        return df.filter(F.col(col) <= quantile(df, col, q, approx=approx, alias="_cut").scalar())
    cut = quantile(df, col, q, by=by, approx=approx, alias="_cut")
    # one row per group: AQE broadcasts it when its runtime size is small
    return (join_on_keys(df, cut, by)
            .filter(F.col(col) <= F.col("_cut")).drop("_cut"))
