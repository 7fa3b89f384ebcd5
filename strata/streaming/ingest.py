"""Incremental file ingest with Structured Streaming.

The reference loads yearly files by appending each one in a loop; a re-run
appends them again. Here the raw layer is fed by a file-source stream with a
checkpoint: every file is ingested exactly once, new files dropped into the
landing folder are picked up by the next run, and a re-run of the same
files adds nothing. ``availableNow`` processes the backlog in bounded
micro-batches and stops, so the job can be scheduled like a batch job and
resumes from its checkpoint after an executor or driver loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.sources.contracts import conform
from strata.sources.csv import YEAR_PATTERN, headers


def csv_stream(spark: SparkSession, landing: str, contract: StructType, header: bool = True,
               sep: str = ",", max_files_per_trigger: int | None = None, multi_line: bool = False,
               stamp_year: bool = False, year_pattern: str = YEAR_PATTERN,
               year_source: str = "file_name", headers_after: str | None = None, known: tuple[str, ...] | None = None) -> DataFrame:
    """A streaming frame over CSV files in ``landing``, conformed to the
    contract by column name (fields read as text, then ``try_cast``).

    The columns are those of the header of the files there (extra columns are
    dropped, in whatever place they stand; an empty folder is taken to get
    the contract's own). A file with another header fails the run rather than
    being read into the wrong columns; ``multi_line`` allows line breaks inside
    quoted fields. A later run gives the columns ``known`` from the one before and the time of that one as
    ``headers_after``: then only the headers of files written since are read."""
    names = [f.name for f in contract.fields]
    if header:
        present = headers(spark, landing, sep, modified_after=headers_after)
        if known is not None:
            present.setdefault(tuple(known), None)
        if len(present) > 1:
            raise ValueError(f"{landing} holds files with different headers: {sorted(map(list, present))}")
        names = list(next(iter(present), names))
    text_schema = StructType([StructField(n, StringType(), True) for n in names])
    reader = (spark.readStream.schema(text_schema).option("header", header).option("sep", sep)
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
              .option("enforceSchema", not header))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(landing)
    df = conform(raw, contract)
    if stamp_year:
        year = F.regexp_extract(F.col(f"_metadata.{year_source}"), year_pattern, 1)
        df = df.withColumn("source_year", F.when(year != "", year.cast("int")))
    return df


def ingest_available(stream: DataFrame, target: str, checkpoint: str,
                     partition_by: list[str] | None = None, add_processing_time: bool = False) -> int:
    """Write everything currently available to the parquet ``target``
    (exactly once per file, tracked in ``checkpoint``) and stop. Returns the
    number of the last batch this run worked on (-1: nothing was new)."""
    if add_processing_time:
        stream = stream.withColumn("processing_datetime", F.current_timestamp())
    w = (stream.writeStream.format("parquet").option("path", target)
         .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    last = q.lastProgress
    return last["batchId"] if last and last["numInputRows"] else -1
