"""Layer reconciliation and key checks.

Every check over many tables is ONE plan (a union of per-table aggregates),
not a driver loop of jobs. The content diff compares digests per hash bucket,
level by level like a hash tree, all tables at once, and groups full rows only
of the last buckets that differ.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.aggregate import checksum, checksum_parts, row_hash
from strata.operators.project import common_columns
from strata.sources.layers import written

Pairs = dict[str, tuple[DataFrame, DataFrame]]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def reconcile_counts(pairs: Pairs) -> DataFrame:
    """(table_name, source_count, target_count, row_count_status) per pair."""
    parts = []
    for name, (src, tgt) in pairs.items():
        parts.append(src.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), F.lit("source").alias("side"), "n"))
        parts.append(tgt.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), F.lit("target").alias("side"), "n"))
    counts = _union(parts).groupBy("table_name").agg(
        F.sum(F.when(F.col("side") == "source", F.col("n"))).alias("source_count"),
        F.sum(F.when(F.col("side") == "target", F.col("n"))).alias("target_count"))
    status = F.when(F.col("source_count") == F.col("target_count"), "OK").otherwise("MISMATCH")
    return counts.withColumn("row_count_status", status)


def layer_checksum(pairs: Pairs) -> DataFrame:
    """(table_name, checksum_match): order-insensitive row-hash sums equal."""
    parts = []
    for name, (src, tgt) in pairs.items():
        s, t = common_columns(src, tgt)
        parts.append(checksum(s, "c").select(F.lit(name).alias("table_name"), F.lit("source").alias("side"), "c"))
        parts.append(checksum(t, "c").select(F.lit(name).alias("table_name"), F.lit("target").alias("side"), "c"))
    sums = _union(parts).groupBy("table_name").agg(
        F.max(F.when(F.col("side") == "source", F.col("c"))).alias("s"),
        F.max(F.when(F.col("side") == "target", F.col("c"))).alias("t"))
    return sums.select("table_name", F.coalesce(F.col("s") == F.col("t"), F.lit(False)).alias("checksum_match"))


#: Hash bits that one level of the digest tree adds.
LEVEL_BITS = 12
#: Rows of a differing bucket that are not split further.
LEAF_ROWS = 64


def _hashed(pairs: Pairs) -> DataFrame:
    """(table_name, side, _h) of every row of every pair: its hash over the common columns."""
    parts = []
    for name, (src, tgt) in pairs.items():
        for side, d in zip((0, 1), common_columns(src, tgt)):
            parts.append(d.select(F.lit(name).alias("table_name"), F.lit(side).alias("side"), F.expr(row_hash(d.columns)).alias("_h")))
    return _union(parts)


def _bucket(bits: int):
    return F.expr(f"shiftrightunsigned(_h, {64 - bits})")


def _level(hashed: DataFrame, bits: int, name: str) -> DataFrame:
    """The digests of one level, written: (table_name, _k, _a, _b), a row per bucket of ``bits`` hash bits; _a and _b
    hold the row count, the checksum and the smallest and largest hash of either side. At most a row per bucket and task is shuffled."""
    digest = F.expr(f"struct(count(1) AS n, {checksum_parts()} AS c, min(_h) AS lo, max(_h) AS hi)")
    one = hashed.groupBy("table_name", "side", _bucket(bits).alias("_k")).agg(digest.alias("d"))
    both = one.groupBy("table_name", "_k").agg(F.first(F.when(F.col("side") == 0, F.col("d")), ignorenulls=True).alias("_a"),
                                               F.first(F.when(F.col("side") == 1, F.col("d")), ignorenulls=True).alias("_b"))
    return written(both, name)


def digest_tree(pairs: Pairs, step: int = LEVEL_BITS, leaf_rows: int = LEAF_ROWS) -> tuple[DataFrame, DataFrame, int]:
    """The first level's digests of all pairs, the buckets (table_name, _k) that differ on the last level, and that
    level's number of hash bits.

    Like a hash tree: buckets whose digests differ are split by the next ``step`` bits of the hash, all tables at once,
    until each holds ``leaf_rows`` rows or fewer, or only rows with one hash. A level reads only the rows of the buckets that
    differ on the level before into its digests; equal layers end at the first."""
    hashed = _hashed(pairs)
    bits = step
    first = level = _level(hashed, bits, "digests-0")
    while True:
        differ = level.where(~F.col("_a").eqNullSafe(F.col("_b")))
        rows = F.coalesce("_a.n", F.lit(0)) + F.coalesce("_b.n", F.lit(0))
        several = F.least("_a.lo", "_b.lo") < F.greatest("_a.hi", "_b.hi")
        if bits + step > 60 or differ.where((rows > leaf_rows) & several).isEmpty():
            return first, differ.select("table_name", "_k"), bits
        inside = hashed.withColumn("_k", _bucket(bits)).join(differ.select("table_name", "_k"), ["table_name", "_k"], "left_semi").drop("_k")
        bits += step
        level = _level(inside, bits, f"digests-{bits // step - 1}")


def bag_compare_all(pairs: Pairs, step: int = LEVEL_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(table_name, source_count, target_count, missing_in_target, extra_in_target) per pair: both row counts, rows of the
    source missing from the target and rows of the target absent from the source -- bags over the common columns
    (EXCEPT ALL both ways).

    Counts come from digests; whole rows are shuffled only of the last buckets of the :func:`digest_tree`, so their number
    follows that of the differences, wherever they are, and not the size of the layers."""
    first, differ, bits = digest_tree(pairs, step, leaf_rows)
    names = first.sparkSession.createDataFrame([(n,) for n in pairs], "table_name string")
    counts = first.groupBy("table_name").agg(F.expr("CAST(coalesce(sum(_a.n), 0) AS BIGINT) AS source_count"),
                                             F.expr("CAST(coalesce(sum(_b.n), 0) AS BIGINT) AS target_count"))
    unequal = {r.table_name for r in differ.select("table_name").distinct().collect()}      # names of tables
    none = F.lit(0).cast("bigint")
    parts = [names.where(~F.col("table_name").isin(*unequal) if unequal else F.lit(True)).select(
        "table_name", none.alias("missing_in_target"), none.alias("extra_in_target"))]
    for name, (src, tgt) in pairs.items():
        if name not in unequal:
            continue
        s, t = common_columns(src, tgt)
        cols = [f"`{c}`" for c in s.columns]
        mine = differ.where(F.col("table_name") == name).select("_k")
        tagged = [d.withColumn("_h", F.expr(row_hash(d.columns))).withColumn("_k", _bucket(bits)).join(mine, "_k", "left_semi")
                  .select(*cols, F.lit(a).alias("_x"), F.lit(1 - a).alias("_y")) for d, a in ((s, 1), (t, 0))]
        per_row = tagged[0].unionByName(tagged[1]).groupBy(*cols).agg(F.expr("sum(_x) AS _x"), F.expr("sum(_y) AS _y"))
        parts.append(per_row.agg(F.expr("CAST(coalesce(sum(greatest(_x - _y, 0)), 0) AS BIGINT) AS missing_in_target"),
                                 F.expr("CAST(coalesce(sum(greatest(_y - _x, 0)), 0) AS BIGINT) AS extra_in_target"))
                     .select(F.lit(name).alias("table_name"), "*"))
    return (names.join(counts, "table_name", "left").join(_union(parts), "table_name")
            .select("table_name", F.coalesce("source_count", none).alias("source_count"), F.coalesce("target_count", none).alias("target_count"),
                    "missing_in_target", "extra_in_target"))


def bag_compare(src: DataFrame, tgt: DataFrame, step: int = LEVEL_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """:func:`bag_compare_all` of one pair, without its name."""
    return bag_compare_all({"": (src, tgt)}, step, leaf_rows).drop("table_name")


def bag_diff_counts(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """(missing_in_target, extra_in_target) of ``bag_compare``."""
    return bag_compare(src, tgt).select("missing_in_target", "extra_in_target")


def layer_diff(pairs: Pairs) -> DataFrame:
    """(table_name, missing_in_target, extra_in_target, data_match) per pair.
    ``data_match`` is true only when both directions are empty."""
    return bag_compare_all(pairs).drop("source_count", "target_count").withColumn(
        "data_match", (F.col("missing_in_target") == 0) & (F.col("extra_in_target") == 0))


def quality_log(pairs: Pairs, source_layer: str = "bronze", target_layer: str = "silver",
                with_load_time: bool = True) -> DataFrame:
    """One log row per table: layers, counts, count status, content match --
    counts and both diff directions come from the digests of each table."""
    return bag_compare_all(pairs).select(
        "table_name", F.lit(source_layer).alias("source_layer"), F.lit(target_layer).alias("target_layer"),
        *([F.current_timestamp().alias("load_time")] if with_load_time else []),
        "source_count", "target_count",
        F.when(F.col("source_count") == F.col("target_count"), "OK").otherwise("MISMATCH").alias("row_count_status"),
        ((F.col("missing_in_target") == 0) & (F.col("extra_in_target") == 0)).alias("data_match"))


def data_freshness(df: DataFrame, date_col: str, table_name: str, with_check_time: bool = True) -> DataFrame:
    """Latest date of a table, when it was checked, and days since it."""
    out = df.agg(F.max(date_col).alias("latest_date")).select(F.lit(table_name).alias("table_name"), "latest_date")
    if with_check_time:
        out = out.withColumn("checked_at", F.current_timestamp()).withColumn(
            "days_stale", F.datediff(F.current_date(), F.to_date("latest_date")))
    return out


def pk_duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values violating a primary key: appearing more than once, or with
    a NULL part. (key..., n_rows). Partial aggregation makes a hot key cheap."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter((F.col("n_rows") > 1) | null_key)


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: list[str], parent_key: list[str]) -> DataFrame:
    """Foreign-key values of ``child`` (non-NULL) with no row in ``parent``:
    (key..., n_rows). The child is first reduced to its distinct keys with a
    row count (partial aggregation: a hot key is one row per task), the
    parent to its distinct keys; then a left anti join."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_key])
    child_keys = child.filter(present).groupBy(*child_key).agg(F.count(F.lit(1)).alias("n_rows"))
    parent_keys = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_key, child_key)]).distinct()
    return child_keys.join(parent_keys, on=child_key, how="left_anti")


def append_quality_log(log: DataFrame, target: str) -> None:
    """Append one run's log rows to the monitoring table (one write per run)."""
    from strata.sources.sinks import append
    append(log, target)


def read_quality_log(spark, target: str) -> DataFrame:
    """The monitoring table, newest run first."""
    from strata.sources.sinks import read_table
    return read_table(spark, target).orderBy(F.desc("load_time"), "table_name")


def write_freshness(freshness: DataFrame, target: str) -> None:
    """Replace the freshness table with the latest check (CREATE OR REPLACE)."""
    from strata.sources.sinks import ctas
    ctas(freshness, target, if_exists="replace")
