"""Table writes for layered storage (parquet directories or catalog tables).

- ``create_if_absent``: an empty table from a contract, only when missing.
- ``ctas``: copy a frame into a new table; ``if_exists`` = error | ignore | replace.
- ``append`` / ``overwrite``: by name. Whole tables are replaced by writing beside them and swapping names.
- ``overwrite_batch``: idempotent load -- replaces only the partitions present
  in the batch (dynamic partition overwrite), so re-running a load does not
  double its rows.
- ``insert_into``: positional insert into an existing catalog table.
- ``read_merged``: read a table whose batches added columns over time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.sources.files import is_path


def _exists(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> bool:
    """A table directory at ``path`` (path resolution only, no job). With a
    schema given, an empty partitioned table (no data files yet) counts."""
    try:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        reader.load(path).schema
        return True
    except AnalysisException:
        return False


def table_exists(spark: SparkSession, path: str, schema: StructType | None = None) -> bool:
    if is_path(path):
        return _exists(spark, path, schema=schema)
    return spark.catalog.tableExists(path)


def _writer(df: DataFrame, mode: str, partition_by: list[str] | None, fmt: str):
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def _save(df: DataFrame, target: str, mode: str, partition_by=None, fmt: str = "parquet", **options) -> None:
    w = _writer(df, mode, partition_by, fmt).options(**options)
    if is_path(target):
        w.save(target)
    else:
        w.saveAsTable(target)


def _replace(df: DataFrame, target: str, partition_by=None, bucket_by: tuple[int, list[str]] | None = None) -> None:
    """``target`` replaced by ``df``: written beside it, then swapped by renaming. A write that fails leaves the old rows,
    and ``df`` may read its own target. (A partitioned catalog table is replaced in place: the catalog keeps its
    partitions' places.)"""
    spark, mark = df.sparkSession, uuid.uuid4().hex[:10]
    if not is_path(target):
        if not spark.catalog.tableExists(target) or partition_by:
            w = _writer(df, "overwrite", partition_by, "parquet")
            (w.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1]) if bucket_by else w).saveAsTable(target)
            return
        new, old = f"{target}_new_{mark}", f"{target}_old_{mark}"
        try:
            w = _writer(df, "errorifexists", None, "parquet")
            (w.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1]) if bucket_by else w).saveAsTable(new)
        except Exception:
            spark.sql(f"DROP TABLE IF EXISTS {new}")
            raise
        spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {target}")
        spark.sql(f"DROP TABLE {old}")
        return
    Path, base = spark._jvm.org.apache.hadoop.fs.Path, target.rstrip("/")
    here, new, old = Path(base), Path(f"{base}__new_{mark}"), Path(f"{base}__old_{mark}")
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        _save(df, new.toString(), "errorifexists", partition_by)
    except Exception:
        fs.delete(new, True)
        raise
    if fs.exists(here) and not fs.rename(here, old):
        raise OSError(f"cannot move {target} aside; the new rows are in {new.toString()}")
    if not fs.rename(new, here):
        fs.rename(old, here)
        raise OSError(f"cannot move {new.toString()} to {target}; the old rows are back")
    fs.delete(old, True)
    spark.catalog.refreshByPath(base)


def create_if_absent(spark: SparkSession, target: str, schema: StructType,
                     partition_by: list[str] | None = None) -> None:
    """Empty table from a contract, only when absent. A catalog name becomes
    ``CREATE TABLE IF NOT EXISTS``; a path gets an empty parquet write."""
    if not is_path(target):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {target} ({cols}) USING parquet{parts}")
        return
    if not table_exists(spark, target, schema):
        _save(spark.createDataFrame([], schema), target, "ignore", partition_by)


def clustered(df: DataFrame, by: list[str]) -> DataFrame:
    """``df`` dealt and sorted by ranges of ``by``: written like this, each file and row group spans few values, and a later
    filter on the leading column skips the others by their statistics."""
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def ctas(df: DataFrame, target: str, if_exists: str = "error", partition_by=None,
         bucket_by: tuple[int, list[str]] | None = None, cluster_by: list[str] | None = None) -> None:
    """Copy ``df`` into a new table. ``cluster_by``: see :func:`clustered`. ``bucket_by=(n, cols)`` (catalog tables)
    hash-buckets the copy so later joins and aggregations on ``cols`` between
    tables bucketed the same way need no shuffle."""
    mode = {"error": "errorifexists", "ignore": "ignore", "replace": "overwrite"}[if_exists]
    if cluster_by:
        df = clustered(df, cluster_by)
    if if_exists == "replace" and (bucket_by is None or not is_path(target)):
        _replace(df, target, partition_by, bucket_by)
        return
    if bucket_by is None:
        _save(df, target, mode, partition_by)
        return
    if is_path(target):
        raise ValueError("bucketing needs a catalog table name, not a path")
    n, cols = bucket_by
    w = _writer(df, mode, partition_by, "parquet").bucketBy(n, *cols).sortBy(*cols)
    w.saveAsTable(target)


def append(df: DataFrame, target: str, partition_by=None) -> None:
    _save(df, target, "append", partition_by)


def overwrite(df: DataFrame, target: str, partition_by=None) -> None:
    """All rows replaced; a write that fails leaves the old ones."""
    _replace(df, target, partition_by)


def overwrite_batch(df: DataFrame, target: str, partition_by: list[str]) -> None:
    """Replace only the partitions this batch contains (idempotent re-run).

    A catalog table is created first if absent; its partitions are then overwritten where the table lies and made known
    to the catalog (``saveAsTable`` would replace the whole table, ``insertInto`` needs a setting of the whole session). All its
    columns must be in the batch."""
    if is_path(target):
        _save(df, target, "overwrite", partition_by, partitionOverwriteMode="dynamic")
        return
    spark = df.sparkSession
    if not spark.catalog.tableExists(target):
        _save(df.limit(0), target, "errorifexists", partition_by)
    columns = [f"`{c.name}`" for c in spark.catalog.listColumns(target)]
    where = spark.sql(f"DESCRIBE FORMATTED {target}").where("col_name = 'Location'").first().data_type
    _save(df.select(*columns), where, "overwrite", partition_by, partitionOverwriteMode="dynamic")
    spark.sql(f"ALTER TABLE {target} RECOVER PARTITIONS")
    spark.catalog.refreshTable(target)


def insert_into(df: DataFrame, table_name: str, overwrite_rows: bool = False) -> None:
    """Positional insert into an existing catalog table (INSERT INTO ... SELECT *)."""
    df.write.insertInto(table_name, overwrite=overwrite_rows)


def read_table(spark: SparkSession, target: str, merge_schema: bool = False,
               schema: StructType | None = None) -> DataFrame:
    if is_path(target):
        reader = spark.read.option("mergeSchema", str(merge_schema).lower())
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(target)
    return spark.table(target)


def read_merged(spark: SparkSession, target: str) -> DataFrame:
    """Read a parquet table whose appended batches evolved the schema."""
    return read_table(spark, target, merge_schema=True)


def drop_tables(spark: SparkSession, database: str, prefixes: tuple[str, ...]) -> list[str]:
    """Drop the catalog tables of ``database`` whose names start with one of
    ``prefixes`` (e.g. rebuild the silver/gold layers from scratch).
    Returns the dropped names."""
    names = [t.name for t in spark.catalog.listTables(database) if t.name.startswith(prefixes)]
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    return names
