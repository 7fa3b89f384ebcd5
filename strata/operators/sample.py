"""Repeatable fixed-size sampling.

Rows are ranked by ``md5(key || seed)`` and the first ``n`` kept: the same
seed gives the same rows on any cluster layout. A count per hash prefix finds
the cut that holds them, so only about ``n`` rows are ordered. If fewer than ``n`` rows exist,
all are returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sample_key(key: str, seed: int):
    """md5 of the key text followed by the seed (a NULL key hashes as '')."""
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(seed))))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    ranked = df.withColumn("_sample_rank", sample_key(key, seed))
    # rows per 16-bit hash prefix -> the first prefix by which n rows are reached:
    # what is then ordered is little more than n rows, however many tasks there are
    prefix = F.substring("_sample_rank", 1, 4)
    sizes = ranked.groupBy(prefix.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0))
    cut = sizes.withColumn("_upto", upto).agg(F.coalesce(F.min(F.when(F.col("_upto") >= n, F.col("_p"))), F.lit("ffff")).alias("_cut"))
    return (ranked.where(prefix <= cut.scalar())
            .orderBy(F.col("_sample_rank").asc(), F.col(key).asc_nulls_last()).limit(n).drop("_sample_rank"))
