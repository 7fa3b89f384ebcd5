"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from strata.session import scratch_path

#: The white space between words, everywhere in this subpackage: the space
#: and the five control characters tab to carriage return (bytes.split()).
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the cluster's shared
    ``spark.checkpoint.dir`` and read back: lineage ends here and a lost
    executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 256) -> None:
    """Arrow batches of at most ``rows`` rows, so that a Python worker holds
    a few hundred texts at a time however long they are. A session that
    already asks for smaller batches keeps its setting."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def row_key(id_col: Column, text_col: Column, id_type: DataType, source_col: Column | None = None) -> Column:
    """A row's id and text hash (and source) as one struct column. In it a null id equals
    itself, so a join on it and a window over it share one shuffle."""
    kind = StructType([StructField("id", id_type), StructField("t", LongType())])
    parts = [id_col.alias("id"), F.xxhash64(text_col.cast("string")).alias("t")]
    if source_col is not None:
        kind, parts = kind.add("s", StringType()), [*parts, source_col.cast("string").alias("s")]
    return F.struct(*parts).cast(kind)


def ship(spark: SparkSession) -> None:
    """The package's source, sent to the executors once per application, so
    that their Python workers can import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_strata_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.TemporaryDirectory(prefix="strata-src-")        # on the driver, gone when it ends
    target = Path(folder.name) / "strata_src.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(target))
    context._strata_shipped = folder


def with_fields(lead: StructField, ddl: str) -> StructType:
    """The schema of ``lead`` followed by the columns of ``ddl``."""
    return StructType([lead, *StructType.fromDDL(ddl)])


def map_texts(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType) -> DataFrame:
    """``fn`` applied to every Arrow batch of ``df``; ``schema`` is that of what it returns."""
    bounded_batches(df.sparkSession)
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; null reads as empty."""
    return [b"" if x is None else x for x in batch.column(name).cast(pa.binary()).to_pylist()]


def id_text(id_col: str, text_col: str) -> list:
    """The two columns most operators read, under fixed names (so that other
    columns of the input cannot clash with the operator's own)."""
    return [F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")]


def labelled_sample(known: DataFrame, docs: DataFrame, rows: int, seed: int) -> DataFrame:
    """(id, text, y int) of at most about ``rows`` labelled texts, chosen by a hash of the id.

    ``known``: (id, y); rows without id or label teach nothing, several labels of one id count as their
    mean, half rounded up. ``docs``: (id, text); an id with several texts teaches the one with the smallest
    hash, so an id that fills the table still adds one row. The chosen ids are a written table of bounded
    size, which Spark broadcasts: texts that were not chosen are never shuffled."""
    label = known.where("id is not null and y is not null").groupBy("id").agg(F.floor(F.avg("y") + 0.5).cast("int").alias("y"))
    label = written(label, "labels")
    pick = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1_000_003)) / 1_000_003.0
    chosen = written(label.where(pick < rows / max(label.count(), 1)), "chosen")
    one = docs.join(chosen, "id").groupBy("id", "y").agg(F.min_by(F.coalesce("text", F.lit("")), F.xxhash64("text")).alias("text"))
    return one.select("id", "text", "y")
