"""Per-group ranking and shares.

``top_n_per_group`` is ``row_number() <= n``; Spark plans it with a
WindowGroupLimit before the shuffle, so every map task forwards at most
``n`` rows per group and a hot group never lands whole in one task.
``share_of_group`` divides by group totals computed with an aggregate
(partial, skew-safe) rather than a window over the whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.joins import join_on_keys



def top_n_per_group(df: DataFrame, by: list[str] | str, metric: str, n: int,
                    descending: bool = True, tie: list[str] | None = None,
                    rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per group after sorting on ``metric``.

    NULL metrics sort last either way (as pandas does); ``tie`` columns
    break ties so the result is deterministic.
    """
    by = [by] if isinstance(by, str) else list(by)
    order = [F.col(metric).desc_nulls_last() if descending else F.col(metric).asc_nulls_last()]
    order += [F.col(t).asc_nulls_last() for t in (tie or [])]
    rn = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    name = rank_col or "_rn"
    out = df.withColumn(name, rn).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def top_n(df: DataFrame, metric: str, n: int, descending: bool = True,
          tie: list[str] | None = None) -> DataFrame:
    """Global top-k (per-task top-k, then a merge of k rows per task)."""
    order = [F.col(metric).desc_nulls_last() if descending else F.col(metric).asc_nulls_last()]
    order += [F.col(t).asc_nulls_last() for t in (tie or [])]
    return df.orderBy(*order).limit(n)


def share_of_group(df: DataFrame, by: list[str] | str, value: str, alias: str = "share") -> DataFrame:
    """``value / sum(value)`` within each group of ``by``. The totals table
    has one row per group; AQE broadcasts it when its runtime size is small
    and otherwise joins it by shuffle."""
    by = [by] if isinstance(by, str) else list(by)
    totals = df.groupBy(*by).agg(F.sum(value).alias("_total"))
    return (join_on_keys(df, totals, by)
            .withColumn(alias, F.try_divide(F.col(value).cast("double"), F.col("_total")))
            .drop("_total"))
