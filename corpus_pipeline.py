"""From raw documents to token ids: five operators in a row.

Each stage takes ``(spark, docs, sf_dir)``, works on every row its
predecessor kept and returns a DataFrame; all but the last return the columns
of ``documents``. ``run`` writes each stage's rows as Parquet under the shared
``spark.checkpoint.dir`` and reads them back for the next.

Null and empty texts fail the quality rules and go there; rows without id are kept like any other, repeated rows are copies
of each other (one of them stays); an empty table gives empty results; columns besides those of ``documents``, whatever their
names, are carried to the last stage and left out by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bpe import encode
from strata.llm.common import written
from strata.llm.mixing import apply_mix
from strata.llm.repetition import keep_good
from strata.llm.secrets import redact
from strata.llm.simhash import keep_one


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked."""
    return keep_one(docs, words=3, max_bits=2)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one that it takes in part is cut."""
    return apply_mix(docs, weights=(3, 1, 2), share=1.5, max_repeat=2)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every document: its token ids, and the digest of the bytes they decode to."""
    found = encode(docs, round_trip=True)
    return found.select(F.col("id").alias("doc_id"), "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("bpe_encode", bpe_encode),
]

#: Fingerprints, the network's findings and token ids have no SQL; the tests
#: hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
