"""Distributed CSV ingest.

``spark.read.csv`` reads plain, gzip and bz2 files (codec from the
extension) on the executors -- never through pandas on the driver. Files
are read as text and then conformed to the contract with ``try_cast``, so a
dirty value becomes NULL instead of failing the load. A gzip file is not
splittable, so such an input gets one task per file; ``repartition_to``
spreads the rows before heavy work.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from strata.operators.reshape import union_by_name
from strata.sources.contracts import conform
from strata.session import scratch_path

# Fixed value: a four-digit year 19xx/20xx not adjacent to other digits.
YEAR_PATTERN = r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)"


def read_csv(spark: SparkSession, paths: str | list[str], contract: StructType | None = None,
             sep: str = ",", quote: str = '"', header: bool = True, multi_line: bool = True,
             drop_first: bool = False, null_value: str | None = None,
             repartition_to: int | None = None) -> DataFrame:
    """Read CSV files (each under its own header's names, every field as text;
    see :func:`headers`), optionally drop the first column (a row index), then
    conform to ``contract``.

    ``multi_line=True`` (the default) is needed for files whose quoted fields
    hold line breaks (listing descriptions); it parses each file in one task,
    so turn it off for files without them to let large files split."""
    df = _read_raw(spark, paths, sep, quote, header, multi_line, drop_first, null_value)
    if contract is not None:
        df = conform(df, contract)
    if repartition_to:
        df = df.repartition(repartition_to)
    return df


def headers(spark: SparkSession, paths: str | list[str], sep: str = ",", quote: str = '"',
            modified_after: str | None = None) -> dict[tuple[str, ...], str | list[str] | None]:
    """Files by the column names of their header: one Spark job over the files, a task per file that stops after its
    first line. The driver sees the different headers; where there is one, its files are ``paths`` as given (None: no file has a
    line), where there are several, each has the list of its files. ``modified_after``: only files written after
    that time (``2024-01-31T00:00:00``) are looked at."""
    side = spark.newSession()                          # its settings are nobody else's
    for key, value in {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50),
                       "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}.items():
        side.conf.set(key, value)
    reader = side.read.option("modifiedAfter", modified_after) if modified_after else side.read
    lines = reader.text(paths).select("value", F.col("_metadata.file_path").alias("file"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    where = scratch_path(spark, "headers")
    lines.mapInArrow(first, lines.schema).write.parquet(where)
    found = spark.read.schema(lines.schema).parquet(where)
    parse = lambda line: tuple(next(csv.reader([line.lstrip("\ufeff")], delimiter=sep, quotechar=quote)))
    texts = [r.value for r in found.select("value").distinct().collect()]
    names = {parse(t) for t in texts}
    if len(names) <= 1:
        return {n: None if modified_after else paths for n in names}
    out: dict[tuple[str, ...], list[str]] = {}
    for r in found.orderBy("file").collect():          # a reader takes its files as a list from the driver
        out.setdefault(parse(r.value), []).append(unquote(r.file))
    return out


def _read_raw(spark: SparkSession, paths: str | list[str], sep: str, quote: str, header: bool, multi_line: bool,
              drop_first: bool, null_value: str | None, source=()) -> DataFrame:
    """All fields as text. Files with the same header are one read under that
    header's names; reads are united by name, so files may order their columns
    differently or lack some (NULL)."""
    reader = (spark.read.option("sep", sep).option("quote", quote).option("escape", quote)
              .option("multiLine", multi_line).option("inferSchema", False).option("mode", "PERMISSIVE"))
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if not header:
        frames = [reader.option("header", False).csv(paths)]
    else:
        frames = [reader.schema(StructType([StructField(n, StringType()) for n in names])).option("header", True)
                  .option("enforceSchema", True).csv(files) for names, files in headers(spark, paths, sep, quote).items()]
    if not frames:
        return spark.createDataFrame([], StructType([]))
    if drop_first:
        frames = [f.drop(f.columns[0]) for f in frames]
    if source:
        frames = [f.select("*", *source) for f in frames]
    return union_by_name(frames)


def with_source_year(df: DataFrame, col: str = "source_year", pattern: str = YEAR_PATTERN,
                     source: str = "file_name") -> DataFrame:
    """Stamp each row with the year found in its file's name (or path), from
    the hidden ``_metadata`` column of the file scan."""
    year = F.regexp_extract(F.col(f"_metadata.{source}"), pattern, 1)
    return df.withColumn(col, F.when(year != "", year.cast("int")))


def read_yearly_csv(spark: SparkSession, paths: list[str], contract: StructType | None = None,
                    dataset_group: str | None = None, pattern: str = YEAR_PATTERN,
                    source: str = "file_name", multi_line: bool = False, sep: str = ",", quote: str = '"',
                    header: bool = True, drop_first: bool = False, null_value: str | None = None) -> DataFrame:
    """All yearly files in one plan (not a loop of loads), each row stamped
    with ``source_year`` (from the file name or path) and ``dataset_group``.
    Years may order, add or lack columns: each file is read under its own
    header and matched by name.

    These files have no line breaks inside fields, so ``multi_line`` is off
    by default: plain and bz2 files then split into many tasks (a multi-line
    read parses each file in a single task)."""
    year = F.regexp_extract(F.col(f"_metadata.{source}"), pattern, 1)
    stamp = F.when(year != "", year.cast("int")).alias("source_year")
    raw = _read_raw(spark, paths, sep, quote, header, multi_line, drop_first, null_value, source=(stamp,))
    if contract is not None:
        raw = conform(raw, StructType([*contract.fields, StructField("source_year", IntegerType())]))
    if dataset_group is not None:
        raw = raw.withColumn("dataset_group", F.lit(dataset_group))
    return raw
