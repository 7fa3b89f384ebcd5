"""Written layers: a derived table stored as parquet under the cluster's shared
checkpoint directory and read back.

This is the medallion flow (raw -> silver -> gold tables, reports read the
gold table): it cuts lineage, so later plans start from a parquet scan with
pushdown and pruning instead of re-running the joins and parsing upstream,
and -- unlike an in-memory cache -- the table survives the loss of
executors.

A layer is found again by what it is made of: the application, its name, the
meaning of its plan and the files the plan reads, with their lengths and times. Another plan, or files added
to an input or overwritten, make another layer; ``refresh`` writes it anew in any case.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.session import app_key, scratch_path

_WRITTEN: dict[tuple, str] = {}


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as parquet under the shared checkpoint directory and read back: an intermediate result that
    several plans use, or that a decision on the driver rests on."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _files(df: DataFrame) -> tuple:
    """The files ``df`` reads with their lengths and modification times, listed once per folder: a file overwritten in
    place is another one."""
    spark, folders = df.sparkSession, {}
    conf, Path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    for name in df.inputFiles():
        where = Path(spark._jvm.java.net.URI(name))
        folders.setdefault(where.getParent().toString(), set()).add(where.getName())
    out = []
    for folder, names in folders.items():
        where = Path(folder)
        for f in where.getFileSystem(conf).listStatus(where):
            if f.getPath().getName() in names:
                out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def materialized(spark: SparkSession, key: str, build: Callable[[], DataFrame], refresh: bool = False) -> DataFrame:
    """The table ``build()`` describes, written unless it already is."""
    df = build()
    k = (app_key(spark), key, df.semanticHash(), hash(_files(df)))
    if refresh or k not in _WRITTEN:
        name = "".join(ch if ch.isalnum() else "-" for ch in key)[-80:]
        path = scratch_path(spark, name)
        df.write.mode("errorifexists").parquet(path)
        _WRITTEN[k] = path
    return spark.read.schema(df.schema).parquet(_WRITTEN[k])


def drop_layers(spark: SparkSession) -> int:
    """Delete this application's written layers; returns how many."""
    mine = [k for k in _WRITTEN if k[0] == app_key(spark)]
    for k in mine:
        where = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop(k))
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(mine)
