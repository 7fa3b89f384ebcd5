"""Small files through Hadoop's file systems: whatever path Spark can read
(``s3a://``, ``hdfs://``, ``abfss://``, plain local paths), this reads too."""

from __future__ import annotations

from pyspark.sql import SparkSession


def is_path(target: str) -> bool:
    """Whether a write target names a place in a file system (a URI or an
    absolute path) rather than a catalog table."""
    return target.startswith("/") or ":/" in target


def _open(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, where, where.getFileSystem(conf)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file (folders are made, an old file is replaced)."""
    _, _, where, fs = _open(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _lines(spark: SparkSession, path: str) -> list[str]:
    jvm, conf, where, fs = _open(spark, path)
    stream = fs.open(where)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        plain = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        out: list[str] = []
        while (line := reader.readLine()) is not None:
            out.append(line)
        return out
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(_lines(spark, path))
