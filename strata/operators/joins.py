"""Joins on group keys. Broadcasts are left to Spark: the optimiser and AQE
compare real byte sizes with ``spark.sql.autoBroadcastJoinThreshold``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (a NULL group is a group
    too); the key columns appear once, taken from ``left``."""
    l, r = left.alias("_jl"), right.alias("_jr")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"_jl.{k}").eqNullSafe(F.col(f"_jr.{k}"))
    rest = [F.col(f"_jr.{c}") for c in right.columns if c not in keys]
    return l.join(r, cond, how).select("_jl.*", *rest)
