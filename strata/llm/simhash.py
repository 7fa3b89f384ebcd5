"""SimHash near-duplicates through a byte-position inverted index.

Fingerprints that differ in at most ``max_bits`` bits agree in at least
``8 - max_bits`` of their eight bytes. The index posts every distinct
fingerprint under bytes at fixed positions; pairs that meet in a posting get
their shared positional bytes tallied, pairs below that guaranteed minimum are
dropped, and the rest are verified by counting differing bits.

A posting on one single byte would hold 1/256 of all fingerprints, so the
index posts under *combinations* of positions: the eight positions are dealt
into ``max_bits + 2`` groups, at most ``max_bits`` of which can hold a
difference, so two groups at least agree completely and every pair of groups
is one posting key (about four bytes). Nothing is lost: each linked pair meets
under at least one key.

Postings with more than ``posting_rows`` members (many near copies of one
text) are not paired up. Their members are linked exactly another way: two
fingerprints within two bits share a midpoint at most one bit from either, so
each member names itself and its 64 one-bit neighbours, and all members naming
the same midpoint are linked to the smallest of them. That is linear in the
members, whatever the size of the group.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text, map_texts, row_key, text_bytes, with_fields, written
from strata.llm.components import connected_components

#: Shingles hashed at a time: bounds the memory of a very long text.
_CHUNK = 1 << 18
_SEED = 42


def fingerprint(data: bytes, words: int = 3) -> int:
    """64-bit SimHash of the ``words``-word shingles of a text (UTF-8, A-Z in
    lower case, repeats included; fewer words: the whole sequence; none: 0).
    A bit is set if it is set in over half of the shingles' XXH64."""
    w = data.lower().split()
    if not w:
        return 0
    if len(w) < words:
        return xxhash.xxh64_intdigest(b" ".join(w), _SEED)
    n = len(w) - words + 1
    digest, seed, join = xxhash.xxh64_intdigest, _SEED, b" ".join
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        k = min(_CHUNK, n - at)
        grams = zip(*(w[at + j:at + j + k] for j in range(words)))
        h = np.fromiter((digest(join(g), seed) for g in grams), np.uint64, k)
        ones += np.unpackbits(h.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp long, text_hash) of every row of ``df``; a null or empty text has fingerprint 0."""
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t, words) for t in text_bytes(batch)], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fp), batch.column("text_hash")],
                                          ["id", "fp", "text_hash"])

    src = df.select(*id_text(id_col, text_col)).withColumn("text_hash", F.xxhash64("text"))
    return map_texts(src, one, with_fields(src.schema["id"], "fp long, text_hash long"))


def _byte(col: str, i: int):
    return F.shiftright(col, 8 * i).bitwiseAND(0xFF)


def position_groups(max_bits: int) -> list[list[int]]:
    """The eight byte positions dealt into ``max_bits + 2`` groups."""
    n = max_bits + 2
    return [list(range(8))[g::n] for g in range(n)]


def links(fps: DataFrame, max_bits: int = 2, posting_rows: int = 64) -> DataFrame:
    """Links (a, b) between the distinct longs in column ``fp`` whose
    components are those of "at most ``max_bits`` differing bits" (0 to 2).
    Pairs met in postings are exact links; members of larger postings come as
    stars around shared midpoints, which have the same components."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    groups = position_groups(max_bits)
    byte_of = [_byte("fp", i) for i in range(8)]

    def part(g: list[int]):
        out = byte_of[g[0]]
        for i in g[1:]:
            out = F.shiftleft(out, 8).bitwiseOR(byte_of[i])
        return out

    keys = F.array(*[F.struct(F.lit(k).cast("short").alias("k"), F.shiftleft(part(x), 8 * len(y)).bitwiseOR(part(y)).alias("v"))
                     for k, (x, y) in enumerate(combinations(groups, 2))])
    posted = fps.select("fp", F.explode(keys).alias("p")).select("fp", "p.k", "p.v")
    size = posted.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sized = written(posted.join(size, ["k", "v"]), "postings")

    light = sized.where(F.col("n") <= posting_rows)
    a = light.select("k", "v", F.col("fp").alias("a"))
    b = light.select("k", "v", F.col("fp").alias("b"))
    tally = sum(F.when(_byte("a", i) == _byte("b", i), 1).otherwise(0) for i in range(8))
    met = (a.join(b, ["k", "v"]).where(F.col("a") < F.col("b"))
           .where(tally >= 8 - max_bits)                                     # count filter
           .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)  # verification
           .select("a", "b").distinct())
    if max_bits == 0:
        return met
    heavy = sized.where(F.col("n") > posting_rows).select("fp").distinct()
    bits = [F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)]
    if max_bits == 1:                                 # a neighbour is the other end itself
        near = heavy.select(F.col("fp").alias("a"), F.explode(F.array(*[F.col("fp").bitwiseXOR(x) for x in bits])).alias("b"))
        return met.unionByName(near.join(heavy.select(F.col("fp").alias("b")), "b").select("a", "b"))
    named = heavy.select("fp", F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(x) for x in bits])).alias("mid"))
    least = named.groupBy("mid").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    star = named.join(least, "mid").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return met.unionByName(star)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    max_bits: int = 2, posting_rows: int = 64) -> DataFrame:
    """(id, fp, text_hash, label, component_id) of every row of ``df``: rows are linked if
    their fingerprints differ in at most ``max_bits`` bits, ``component_id`` is the smallest id
    reachable, ``label`` the smallest fingerprint reachable.

    Null and empty texts have fingerprint 0 and are linked like any other; rows without id get a
    component and are never its id (a component of such rows alone has a null id); repeated
    rows are returned as often as they come; an empty table gives an empty result; other columns
    are not read."""
    rows = written(fingerprints(df, id_col, text_col, words), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fps")
    roots = connected_components(links(distinct.select("fp"), max_bits, posting_rows))
    labelled = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    labelled = written(labelled.select("fp", "least", F.coalesce("root", "fp").alias("label")), "labels")
    ids = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    component = labelled.select("fp", "label").join(ids, "label")
    return rows.join(component, "fp").select("id", "fp", "text_hash", "label", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
             max_bits: int = 2) -> DataFrame:
    """The rows of ``df`` with one row of each near-duplicate group: the one with the smallest id
    (rows without id last). Columns stay as they are. The choice is made on narrow rows; full
    rows are shuffled once, on a key of their own (id and text hash), and only one of each key
    and task: neither a large group of copies nor equal rows without id meet in one task."""
    found = near_duplicates(df, id_col, text_col, words, max_bits)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("text_hash").alias("t")))
    chosen = found.groupBy("label").agg(first.alias("first")).select(F.struct("first.id", "first.t").alias("key"))
    row = df.select(F.struct("*").alias("row"))
    row = row.withColumn("key", row_key(F.col(f"row.`{id_col}`"), F.col(f"row.`{text_col}`"), df.schema[id_col].dataType))
    one = row.groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.join(chosen, "key").select("row.*")
