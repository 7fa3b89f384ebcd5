"""GeoJSON feature collections as rows (one row per feature)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path


def read_geojson_features(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``features`` exploded: feature properties flattened to columns plus the
    geometry type and coordinates (as JSON text, shapes vary). A document over
    several lines is read by one task; ``multi_line=False`` is for files of
    one-line documents, which split."""
    doc = spark.read.option("multiLine", multi_line).json(path)
    return _flat(doc.select(F.explode("features").alias("f")))


def read_geojson_collection(spark: SparkSession, path: str) -> DataFrame:
    """The same rows of large collections, however their lines break: files split.

    The text is read in records that end at a feature's ``"Feature"``, so any task can begin anywhere in a file; what stands
    between two of them is the rest of one feature and the beginning of the next. The features are written one a line and read as JSON
    lines. Features must begin with their type and be the last member of their collection, as the usual writers have it;
    if a record is no feature after all, the files are read as whole documents instead."""
    value = F.col("value")
    parts = spark.read.option("lineSep", '"Feature"').text(path)
    parts = parts.where(F.ltrim(F.regexp_replace(value, r"^\s+", "")).rlike("^[,}]"))       # not what precedes the first feature
    body = F.when(value.rlike(r'\{\s*"type"\s*:\s*$'), F.regexp_replace(value, r',?\s*\{\s*"type"\s*:\s*$', "")).otherwise(
        F.regexp_replace(value, r"\s*\]\s*\}\s*$", ""))
    lines = scratch_path(spark, "geojson-features")
    parts.select(F.regexp_replace(F.concat(F.lit('{"type":"Feature"'), body), r"[\r\n]+", " ")).write.text(lines)
    found = spark.read.json(lines)
    if "_corrupt_record" in found.columns or not {"properties", "geometry"} <= set(found.columns):
        return read_geojson_features(spark, path)
    return _flat(found.select(F.struct("properties", "geometry").alias("f")))


def _flat(feats: DataFrame) -> DataFrame:
    props = [f"f.properties.{c}" for c in feats.select("f.properties.*").columns]
    return feats.select(*props, F.col("f.geometry.type").alias("geometry_type"),
                        F.to_json(F.col("f.geometry.coordinates")).alias("coordinates"))
