"""Schema contracts: a ``StructType`` saved as JSON, reloaded, extended with
load-metadata fields, and enforced on incoming frames."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StructField, StructType

from strata.sources.files import read_text, write_text


def save_contract(spark: SparkSession, schema: StructType, path: str) -> None:
    """Write a contract as JSON to any path that Spark can reach."""
    write_text(spark, path, schema.json())


def load_contract(spark: SparkSession, path: str) -> StructType:
    return StructType.fromJson(json.loads(read_text(spark, path)))


def with_metadata_fields(schema: StructType, fields: list[tuple[str, DataType]]) -> StructType:
    """A copy of ``schema`` with nullable metadata fields appended (the
    input is not mutated)."""
    return StructType(list(schema.fields) + [StructField(n, t, True) for n, t in fields])


def conform(df: DataFrame, schema: StructType, strict: bool = False) -> DataFrame:
    """Project ``df`` onto the contract in one select: columns in contract
    order, matched by name (case-insensitive), cast with ``try_cast``
    (unreadable -> NULL, NaN -> NULL); absent columns become typed NULLs; extra columns
    are dropped."""
    by_lower = {c.lower(): c for c in df.columns}
    out = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif strict:
            out.append(F.col(f"`{src}`").cast(f.dataType).alias(f.name))
        else:
            col = F.col(f"`{src}`").try_cast(f.dataType)
            if isinstance(f.dataType, (DoubleType, FloatType)):   # the text 'NaN' is a missing number
                col = F.when(~F.isnan(col), col)
            out.append(col.alias(f.name))
    return df.select(*out)
