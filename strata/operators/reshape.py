"""Reshaping: wide-to-long unpivot, metric transpose with percent
difference, and unions by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_pairs(df: DataFrame, pairs: list[tuple[str, str]], name_col: str, value_col: str,
                  keep: list[str] | None = None) -> DataFrame:
    """One output row per (label, column) pair, via a generator.

    ``keep=None`` keeps every input column.
    No shuffle: the generator runs inside the scan's stage. Labels and names may hold any characters.
    """
    rows = F.array(*[F.struct(F.lit(label).alias(name_col), F.col(_quoted(c)).alias(value_col)) for label, c in pairs])
    return df.select(*(keep if keep is not None else ["*"]), F.inline(rows))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def transpose_compare(df: DataFrame, key: str, metrics: list[str], base: str, other: str,
                      labels: dict[str, str] | None = None, pct_col: str = "pct_diff",
                      digits: int = 2) -> DataFrame:
    """Metrics x keys -> one row per metric with the two key values and
    ``(other - base) / base * 100`` rounded (NULL when base is 0/NULL).

    Input is a small per-key summary; the transpose is a conditional
    aggregation followed by a generator.
    """
    labels = labels or {}
    wide = df.agg(*[
        F.max(F.when(F.col(_quoted(key)) == F.lit(k), F.col(_quoted(m)).cast("double"))).alias(f"{m}__{tag}")
        for m in metrics for k, tag in ((base, "a"), (other, "b"))
    ])
    rows = [F.struct(F.lit(labels.get(m, m)).alias("metric"), F.col(_quoted(f"{m}__a")).alias(base),
                     F.col(_quoted(f"{m}__b")).alias(other)) for m in metrics]
    long = wide.select(F.inline(F.array(*rows)))
    a, b = F.col(_quoted(base)), F.col(_quoted(other))
    pct = F.try_divide(b - a, a) * F.lit(100.0)
    return long.withColumn(pct_col, F.bround(pct, digits))


def union_by_name(frames: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Bag union by column name; absent columns become NULL when allowed."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
