"""Connected components of a large link table, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def _state(edges: DataFrame) -> tuple:
    """Row count and an order-free checksum: two numbers, whatever the size."""
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return (r.n, r.h)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; ``links`` has two columns
    ``a`` and ``b`` of one orderable type, in any order, with repeats, self
    links or nulls (both of which are ignored). ``root`` is the smallest node
    of the component. An empty table gives an empty result.

    Alternating large-star and small-star rounds: each round hooks every
    node's larger neighbours, then its smaller ones, to the smallest neighbour
    it knows, until the edges are stars around the roots. The number of edges
    never grows, each round is two aggregations with map-side combine and two
    joins that adaptive execution can split when a root has many members, and
    every round is written to the shared folder (no growing lineage).
    """
    e = written(links.where("a is not null and b is not null and a <> b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("x"))
        e = written(small.select("x.a", "x.b").where("a <> b").distinct(), "stars")
        after = _state(e)
        if after == before:
            break
        before = after
    return (e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
