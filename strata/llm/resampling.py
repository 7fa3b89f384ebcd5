"""Importance resampling towards a target distribution.

Texts are bags of hashed features (words and pairs of words, CRC-32 modulo the
number of buckets). Each bucket's gain is the logarithm of its share in the
target over its share in the source, a text's weight the mean gain of its
features; adding Gumbel noise that depends on the id alone and taking the
highest scores draws a sample without replacement in proportion to the weights.

Features come from a head-tail vocabulary. The head, fitted on a bounded
sample, is broadcast: the CRC states of frequent words, from which the CRC of
a pair that begins with one goes on, and the buckets of frequent pairs, one
binary search for a whole batch. Unseen features, the tail, take their CRC
directly. Both give the same exact buckets, counted over all texts: the head
only saves time.

Every feature's bucket is written once (two bytes each); totals and weights
are narrow passes over that table. Ranks come from a range-partitioned sort on
(score, id, row number), whose keys are all different, so that neither equal
scores nor repeated ids meet in one task, and from the partitions' sizes.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.common import id_text, map_texts, ship, text_bytes, with_fields, written

#: A-Z in lower case; what is neither letter, digit nor beyond ASCII becomes a space.
_FOLD = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256)).lower()


def words_of(data: bytes) -> list[bytes]:
    """The words of a text (UTF-8): letters a-z (A-Z lower-cased), digits and characters beyond ASCII."""
    return data.translate(_FOLD).split()


class Head:
    """Frequent words with their CRC states, frequent pairs with their buckets."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int):
        self.buckets = buckets
        self.number = {w: i for i, w in enumerate(words)}
        self.state = np.array([zlib.crc32(w) for w in words], np.uint32)
        self.bucket = self.state % buckets
        known = sorted((self.number[a] * len(words) + self.number[b], zlib.crc32(a + b" " + b) % buckets)
                       for a, b in pairs if a in self.number and b in self.number)
        known.append((len(words) ** 2, 0))                # beyond any pair: a search always ends at an entry
        self.pair = np.array([k for k, _ in known], np.int64)
        self.pair_bucket = np.array([b for _, b in known], np.uint32)

    def features(self, words: list[bytes]) -> np.ndarray:
        """The buckets of all words, then of all pairs of consecutive words."""
        n = len(words)
        if not n:
            return np.zeros(0, np.uint32)
        crc, m = zlib.crc32, self.buckets
        at = np.array(list(map(self.number.get, words, repeat(-1))), np.int64)
        single = np.empty(n, np.uint32)
        head = at >= 0
        single[head] = self.bucket[at[head]]
        single[~head] = np.fromiter(map(crc, [words[i] for i in np.flatnonzero(~head).tolist()]), np.uint32) % m

        first, second = at[:-1], at[1:]
        both = np.empty(n - 1, np.uint32)
        code = first * len(self.state) + second
        place = np.searchsorted(self.pair[:-1], code)
        found = (first >= 0) & (second >= 0) & (self.pair[place] == code)
        both[found] = self.pair_bucket[place[found]]
        rest = ~found & (first >= 0)                     # the CRC goes on from the first word's state
        behind = [b" " + words[i + 1] for i in np.flatnonzero(rest).tolist()]
        both[rest] = np.fromiter(map(crc, behind, self.state[first[rest]].tolist()), np.uint32) % m
        tail = [words[i] + b" " + words[i + 1] for i in np.flatnonzero(first < 0).tolist()]
        both[first < 0] = np.fromiter(map(crc, tail), np.uint32) % m
        return np.concatenate([single, both])


def fit_head(df: DataFrame, buckets: int, words: int = 30_000, pairs: int = 100_000, rows: int = 5_000, seed: int = 7) -> Head:
    """The head of ``df`` (id, text): the most frequent ``words`` words and ``pairs`` pairs among about ``rows``
    rows, chosen by a hash of id and text. What is missing in it costs time, never exactness."""
    n = df.count()
    pick = F.pmod(F.xxhash64(F.lit(seed), "id", "text"), F.lit(1_000_003)) / 1_000_003.0
    sample = df.where(pick < rows / max(n, 1))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: Counter = Counter()
        for t in text_bytes(batch):
            w = words_of(t)
            seen.update(w)
            seen.update(map(b" ".join, zip(w, w[1:])))
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["feature", "n"])

    counted = written(map_texts(sample, count, StructType.fromDDL("feature binary, n long")).groupBy("feature").agg(F.sum("n").alias("n")),
                      "head").where("n > 1").withColumn("pair", F.instr(F.col("feature").cast("string"), " ") > 0)
    top = [counted.where(x).orderBy(F.desc("n"), "feature").limit(k).select("feature").toArrow()["feature"].to_pylist()
           for x, k in ((~F.col("pair"), words), (F.col("pair"), pairs))]
    return Head(top[0], [tuple(p.split(b" ")) for p in top[1]], buckets)


def bucket_table(df: DataFrame, head, name: str) -> DataFrame:
    """(id, n_words, features) of every row of ``df`` (id, text), written once; ``features``: the buckets, two bytes each."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = [words_of(t) for t in text_bytes(batch)]
        features = [head.value.features(w).astype(np.uint16).tobytes() for w in words]
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(w) for w in words], pa.int64()), pa.array(features, pa.binary())],
                                          ["id", "n_words", "features"])

    return written(map_texts(df, run, with_fields(df.schema["id"], "n_words long, features binary")), name)


def totals(table: DataFrame, buckets: int) -> np.ndarray:
    """How many features of ``table`` fall into each bucket: one row per bucket and task, summed by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column("features").to_pylist():
                seen += np.bincount(np.frombuffer(x, np.uint16), minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at])], ["bucket", "n"])

    ship(table.sparkSession)
    got = table.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in got:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain in thousandths, rounded down: the logarithm of its share in ``target`` over that in
    ``source``, one feature added to every bucket of both."""
    m = len(source)
    all_s, all_t = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_s + m) / ((s + 1.0) * (all_t + m))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _noise(id_col: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from the id's digest."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` with column ``rank``: 1, 2, 3... in the given order, whose keys should differ from row to row.
    Rows are sorted in ranges, a row's rank is its place in its range and the sizes of the ranges before it."""
    place = F.monotonically_increasing_id()             # partition << 33 | place in the partition
    rows = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place), "ranges")
    rows = rows.withColumn("_range", F.shiftright("_place", 33))
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))     # a row per range
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    return rows.join(starts, "_range").withColumn("rank", rank).drop("_range", "_place", "_before")


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_id: str = "item_id",
             target_text: str = "text", buckets: int = 10_000, percent: int = 25, min_words: int = 20, seed: int = 7) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row of ``df``. Of the N rows with at least
    ``min_words`` words the floor(``percent`` * N / 100) highest scores are drawn: their ``rank`` is 1, 2, 3...,
    ties to the smaller id; all others' is null. ``buckets``: 65,536 at most.

    Null and empty texts have no features and weight 0; a null id's noise is that of the empty id, and it
    comes last among ties; repeated rows are drawn and returned each on its own; empty tables (either) are no
    special case: no rows, or gains against a target without features; other columns are not read."""
    if not 0 < buckets <= 65_536:
        raise ValueError("buckets must be 1 to 65536")
    docs = df.select(*id_text(id_col, text_col))
    goal = target.select(*id_text(target_id, target_text))
    head = df.sparkSession.sparkContext.broadcast(fit_head(docs, buckets))
    rows = bucket_table(docs, head, "features")
    gain = gains(totals(rows, buckets), totals(bucket_table(goal, head, "target-features"), buckets))

    def weigh(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.frombuffer(x, np.uint16) for x in batch.column("features").to_pylist()]
        weight = [int(gain[x].sum()) // max(1, len(x)) for x in found]
        own = [batch.column("n_words"), pa.array([len(x) for x in found], pa.int64()), pa.array(weight, pa.int64())]
        return pa.RecordBatch.from_arrays([batch.column("id"), *own], ["id", "n_words", "n_features", "weight"])

    weighed = map_texts(rows, weigh, with_fields(rows.schema["id"], "n_words long, n_features long, weight long"))
    scored = weighed.withColumn("score", F.col("weight") + _noise(F.col("id"), seed))
    scored = written(scored.withColumn("_row", F.monotonically_increasing_id()), "scores")
    fit = F.col("n_words") >= min_words
    drawn = scored.where(fit).count() * percent // 100
    order = [fit.desc(), F.desc("score"), F.asc_nulls_last("id"), F.asc("_row")]
    out = ranked(scored, order).drop("_row")
    return out.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
