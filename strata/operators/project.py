"""Projection and schema shaping."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep-list projection (column pruning reaches the scan)."""
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop-list projection; names not present are ignored."""
    return df.drop(*cols)


def cast_map(df: DataFrame, mapping: dict[str, str], strict: bool = False) -> DataFrame:
    """Cast the listed columns that exist, in ONE select (no withColumn chain).

    Dirty text becomes NULL (``try_cast``) unless ``strict``.
    """
    lower = {k.lower(): v for k, v in mapping.items()}
    out = []
    for c in df.columns:
        t = lower.get(c.lower())
        if t is None:
            out.append(F.col(c))
        else:
            out.append((F.col(c).cast(t) if strict else F.col(c).try_cast(t)).alias(c))
    return df.select(*out)


def prefixed(df: DataFrame, prefix: str) -> list[str]:
    """Columns whose name starts with ``prefix`` (resolved at plan-build time)."""
    return [c for c in df.columns if c.startswith(prefix)]


def fill_prefixed(df: DataFrame, prefix: str, value=0.0) -> list:
    """``coalesce(c, value)`` for every column starting with ``prefix``."""
    return [F.coalesce(F.col(c), F.lit(value)).alias(c) for c in prefixed(df, prefix)]


def common_columns(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames restricted to the columns they share (in ``a``'s order)."""
    common = [c for c in a.columns if c in b.columns]
    return a.select(*common), b.select(*common)


def add_metadata(df: DataFrame, timestamp_col: str | None = "processing_datetime", now: Column | datetime | None = None, **labels) -> DataFrame:
    """Stamp load metadata: a processing timestamp and constant labels
    (``area='London'`` or ``source_year=2019, dataset_group='apt_dly'``).

    ``now`` is the clock: the time of the query by default, or that of the run being loaded or repeated."""
    cols = {}
    if timestamp_col:
        cols[timestamp_col] = F.current_timestamp() if now is None else now if isinstance(now, Column) else F.lit(now)
    for k, v in labels.items():
        cols[k] = F.lit(v)
    return df.withColumns(cols)
