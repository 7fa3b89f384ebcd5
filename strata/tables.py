"""Reading the driver's parquet tables.

Plain ``spark.read.parquet``: Catalyst prunes columns and pushes filters into
the scan, so callers select only what they need downstream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TPCH_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def footer_stats(spark: SparkSession, path: str, **wanted: tuple[str, str]) -> DataFrame:
    """One row of bare aggregates of a whole parquet table (name=("min" | "max" | "count", column; "*" counts rows)),
    answered from the files' footers: the table's pages are not read. Numbers, dates and booleans only, as the footers of
    text are cut.

    Spark's aggregate push-down works in its newer file source; a session of its own holds that setting."""
    side = spark.newSession()
    side.conf.set("spark.sql.sources.useV1SourceList", "")
    side.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    make = {"min": F.min, "max": F.max, "count": lambda c: F.count(F.lit(1)) if c == "*" else F.count(c)}
    return side.read.parquet(path).agg(*[make[kind](c).alias(name) for name, (kind, c) in wanted.items()])
