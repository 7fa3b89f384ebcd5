"""Approximate nearest neighbours by inner product: an adaptive dimension scan.

*Reduction.* Each candidate gets one more coordinate, sqrt(M^2 - |x|^2) with M
the largest norm, each query a zero: the largest inner products then are the
smallest distances. A random rotation spreads every difference evenly over the
coordinates, so that the squared distance over the first d of D coordinates
estimates d/D of the whole.

*Lists.* k-means on a bounded sample gives the centroids; every vector is
indexed in the list of its nearest one. A list is cut into segments of about
``segment_rows`` rows, a list's queries into chunks of about ``chunk_queries``,
and every (segment, chunk) is one task's work: neither a crowded list nor a
crowd of equal queries meets in one place.

*Scan.* A segment's rotated vectors lie in blocks of columns. A query reads its
list block by block; after each, a hypothesis test abandons the candidates
whose partial distance says, with high confidence, that they are beyond the
best ``k`` found so far (ties stay). What is left is scored exactly, in double
precision on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ship, written


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part: not null, no null or
    non-finite component, not zero, of the table's commonest length."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))
    return rows


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Centroids of ``x``; a centroid that loses its rows takes a random one."""
    r = np.random.default_rng(seed)
    c = x[r.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=k)
        c = np.zeros_like(c)
        np.add.at(c, near, x)
        empty = n == 0
        c[~empty] /= n[~empty, None]
        c[empty] = x[r.choice(len(x), empty.sum())]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (np.einsum("ij,ij->i", c, c)[None] - 2 * x @ c.T).argmin(1)


def rotation(dims: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def scan(queries: np.ndarray, blocks: list[np.ndarray], k: int, epsilon: float) -> Iterator[np.ndarray]:
    """For each of the (rotated) ``queries``, the positions of the candidates
    that may be among its ``k`` nearest. ``blocks``: the segment's
    coordinates, a block of columns each, rows in column order."""
    n, dims = blocks[0].shape[1], sum(map(len, blocks))
    cuts = np.cumsum([0, *map(len, blocks)])
    probe = min(n, max(2 * k, 64))

    def apart(q: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (q * q).sum(-1)[..., None] - 2 * q @ b + (b * b).sum(0)

    # a first threshold from whole distances to some of the rows
    best = np.full(len(queries), np.inf)
    if probe >= k:
        head = sum(apart(queries[:, s:e], b[:, :probe]) for b, s, e in zip(blocks, cuts, cuts[1:]))
        best = np.partition(head, k - 1, axis=1)[:, k - 1]
    # every query reads the first block; equal vectors must not be parted by rounding
    least = 1e-9 * (1.0 + (queries * queries).sum(1))
    first = apart(queries[:, :cuts[1]], blocks[0])
    for q, top, tiny, partial in zip(queries, best, least, first):
        alive = np.arange(n)
        for b, s, e in zip(blocks, cuts, cuts[1:]):
            if s:
                partial = partial + apart(q[s:e], b[:, alive])
            slack = (1 + epsilon / np.sqrt(e)) ** 2 if e < dims else 1.0
            keep = partial <= top * (e / dims) * slack + tiny
            alive, partial = alive[keep], partial[keep]
        if len(alive) > k:                            # whole distances: the k-th of them, ties staying
            alive = alive[partial <= np.partition(partial, k - 1)[k - 1] + tiny]
        yield alive


def top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query in (query_no, query_id, vec_id, score), with ``rank``."""
    place = F.row_number().over(Window.partitionBy("query_no").orderBy(F.desc("score"), "vec_id")).cast("int")
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def search(df: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
           lists: int | None = None, probes: float = 0.75, sample_rows: int = 8192, block: int = 16,
           epsilon: float = 2.1, segment_rows: int = 4096, chunk_queries: int = 2048, seed: int = 42) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found of every query (rows of
    ``df`` where ``is_query``, a condition on column ``vec_id``, holds) with all rows but its own, ties to
    the smaller id.

    ``lists`` (default: a quarter of the square root of the number of rows, 1 to 1024) and ``probes`` (the share of
    them that a query may read, nearest centroids first; more where those hold too few rows) set the balance of time and recall; centroids are
    learned from about ``sample_rows`` rows. A query first reads the nearest lists that hold ``k`` rows; of the others it may read it skips
    each whose distance bound (to the centroid, less the list's radius) is beyond the k-th found, which loses nothing.

    Vectors that are null, zero, of another length than the
    commonest or hold null or non-finite components take no part, nor do rows without id; rows with
    the query's own id are never found; repeated rows are found as often as they come, and each repeated query row has
    its own ``k`` results (different vectors under one id are searched each, equal ones once); an empty table gives an
    empty result; other columns are not read."""
    spark = df.sparkSession
    ship(spark)
    rows = written(usable(df, id_col, vec_col), "vectors")
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).orderBy(F.desc("n"), "d").first()
    out = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], out)
    dims, n, reach = lengths.d, lengths.n, float(lengths.m)
    rows = rows.where(F.size("v") == dims)
    pick = F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(1_000_003)) / 1_000_003.0
    sample = rows.where(pick < sample_rows / n).orderBy("vec_id").limit(2 * sample_rows).select("v").collect()
    x = np.array([r.v for r in sample] or [rows.select("v").first().v])

    def lift(v: np.ndarray) -> np.ndarray:
        return np.concatenate([v, np.sqrt(np.maximum(0.0, reach - (v * v).sum(1)))[:, None]], axis=1)

    x = lift(x)
    count = min(lists or min(1024, max(1, int(np.sqrt(n) / 4))), len(np.unique(x, axis=0)))
    centroids = kmeans(x, count, 8, seed)
    reads = max(1, int(np.ceil(probes * count)))
    turn = rotation(dims + 1, seed)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                v = lift(np.stack(b.v))
                near = nearest(v, centroids)
                yield pd.DataFrame({"vec_id": b.vec_id, "list": near, "far": np.sqrt(((v - centroids[near]) ** 2).sum(1)), "v": b.v})

    indexed = written(rows.mapInPandas(assign, "vec_id long, list int, far double, v array<double>"), "index")
    sizes = indexed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far"))
    held, radius = np.zeros(count, np.int64), np.zeros(count)
    for r in sizes.collect():                         # as many numbers as there are lists
        held[r.list], radius[r.list] = r.n, r.far
    sizes = sizes.withColumn("segments", F.ceil(F.col("n") / segment_rows).cast("int"))

    # each different query once
    asked = rows.where(is_query).groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies"))
    asked = written(asked.select(F.monotonically_increasing_id().alias("query_no"), F.col("vec_id").alias("query_id"), "v"), "queries")
    probed = "query_no long, query_id long, list int, v array<double>"

    def chosen(part: pd.DataFrame, limit: np.ndarray | None) -> pd.DataFrame:
        """The lists that each query reads: the nearest that hold ``k`` rows besides its own or, given the k-th score
        found in those (``limit``), the others among the nearest that can hold a better one."""
        q = np.concatenate([np.stack(part.v), np.zeros((len(part), 1))], axis=1)
        apart = (centroids * centroids).sum(1)[None] - 2 * q @ centroids.T + (q * q).sum(1)[:, None]
        order = np.argsort(apart, axis=1, kind="stable")
        first = ((held[order].cumsum(1) < k + 1).sum(1) + 1).clip(max=count)[:, None]
        place = np.arange(count)[None]
        if limit is None:
            keep = place < first
        else:
            # |q - x|^2 = reach + |q|^2 - 2 <q, x>
            bound = np.maximum(0.0, np.sqrt(np.maximum(0.0, np.take_along_axis(apart, order, 1))) - radius[order])
            worst = reach + (q * q).sum(1) - 2 * limit
            keep = (place >= first) & (place < reads) & (bound ** 2 <= (worst * (1 + 1e-9) + 1e-9)[:, None])
        at, lists_ = np.nonzero(keep)
        return pd.DataFrame({"query_no": part.query_no.to_numpy()[at], "query_id": part.query_id.to_numpy()[at],
                             "list": order[at, lists_].astype(np.int32), "v": [part.v.iloc[i] for i in at]})

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 256):
                part = b.iloc[i:i + 256]
                out = chosen(part, part.worst.to_numpy() if "worst" in part else None)
                if len(out):
                    yield out

    salted = lambda c, parts, s: F.pmod(F.xxhash64(F.lit(s), c), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    def cell(data: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, ...]] = []
        if len(data) and len(query):
            v, ids = np.stack(data.v), data.vec_id.to_numpy()
            turned = np.ascontiguousarray((lift(v) @ turn).T)
            blocks = [turned[i:i + block] for i in range(0, dims + 1, block)]
            qs, numbers, own = np.stack(query.v), query.query_no.to_numpy(), query.query_id.to_numpy()
            for i in range(0, len(qs), 256):          # bounds the first block's distances held at a time
                some = qs[i:i + 256]
                rotated = np.concatenate([some, np.zeros((len(some), 1))], axis=1) @ turn
                near = scan(rotated, blocks, k + 1, epsilon)   # one more: the query's own row may be among them
                for q, at, number, qid in zip(some, near, numbers[i:i + 256], own[i:i + 256]):
                    at = at[ids[at] != qid]
                    score = (v[at] * q).sum(1)
                    if len(at) > k:
                        best = np.lexsort((ids[at], -score))[:k]
                        at, score = at[best], score[best]
                    found.append((np.full(len(at), number), np.full(len(at), qid), ids[at], score))
        types = (np.int64, np.int64, np.int64, np.float64)
        cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, t) for t in types]
        return pd.DataFrame(dict(zip(("query_no", "query_id", "vec_id", "score"), cols)))

    def read(wanted: DataFrame) -> DataFrame:
        """What the queries find in the lists that they want (query_no, query_id, list, v)."""
        crowds = wanted.groupBy("list").agg(F.count(F.lit(1)).alias("q"))
        plan = sizes.join(crowds, "list").withColumn("chunks", F.ceil(F.col("q") / chunk_queries).cast("int"))
        plan = written(plan.select("list", "segments", "chunks"), "plan")
        data = indexed.join(plan, "list").withColumn("segment", salted("vec_id", "segments", seed)).select(
            "list", "segment", every("chunks").alias("chunk"), "vec_id", "v")
        query = wanted.join(plan, "list").withColumn("chunk", salted("query_no", "chunks", seed + 1)).select(
            "list", every("segments").alias("segment"), "chunk", "query_no", "query_id", "v")
        key = ["list", "segment", "chunk"]
        return data.groupBy(*key).cogroup(query.groupBy(*key)).applyInPandas(cell, "query_no long, query_id long, vec_id long, score double")

    first = written(top(read(written(asked.mapInPandas(probe, probed), "probes")), k).drop("rank"), "first-found")
    worst = first.groupBy("query_no").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("worst"))
    limited = asked.join(worst, "query_no", "left").withColumn("worst", F.coalesce("worst", F.lit(-1e300)))
    more = read(written(limited.mapInPandas(probe, probed), "further-probes"))
    found = top(first.unionByName(more), k).join(asked.withColumnRenamed("query_id", "_id"), "query_no")
    each = rows.where(is_query).select(F.col("vec_id").alias("_id"), "v")      # every query row, its copies too
    return each.join(found, ["_id", "v"]).select("query_id", "rank", "vec_id", "score")
