import pytest
from pyspark.sql import functions as F

from strata.operators import quality
from strata.operators.quality import (bag_diff_counts, data_freshness, fk_orphans, layer_checksum, layer_diff,
                                      pk_duplicates, quality_log, reconcile_counts)


def _df(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def test_bag_diff_both_directions_with_duplicates(spark):
    a = _df(spark, [(1, "a"), (1, "a"), (2, "b"), (3, "c")])
    b = _df(spark, [(1, "a"), (2, "b"), (2, "b"), (4, "d")])
    r = bag_diff_counts(a, b).first()
    assert (r.missing_in_target, r.extra_in_target) == (2, 2)   # {1a, 3c} and {2b, 4d}
    # the one-sided check of the reference misses extra target rows:
    assert b.exceptAll(a).count() == 2 and bag_diff_counts(a, a).first().missing_in_target == 0


def test_seeded_faults_are_found(spark):
    src = _df(spark, [(i, str(i)) for i in range(20)])
    pairs = {
        "clean": (src, src),
        "missing": (src, src.filter("k % 5 <> 0")),
        "changed": (src, src.withColumn("v", F.when(F.col("k") == 3, "x").otherwise(F.col("v")))),
        "extra": (src.filter("k % 5 <> 0"), src),
    }
    counts = {r.table_name: r.row_count_status for r in reconcile_counts(pairs).collect()}
    assert counts == {"clean": "OK", "missing": "MISMATCH", "changed": "OK", "extra": "MISMATCH"}
    diff = {r.table_name: (r.missing_in_target, r.extra_in_target, r.data_match) for r in layer_diff(pairs).collect()}
    assert diff == {"clean": (0, 0, True), "missing": (4, 0, False), "changed": (1, 1, False),
                    "extra": (0, 4, False)}
    sums = {r.table_name: r.checksum_match for r in layer_checksum(pairs).collect()}
    assert sums == {"clean": True, "missing": False, "changed": False, "extra": False}
    log = quality_log(pairs).orderBy(F.desc("load_time"), "table_name")
    assert log.count() == 4 and log.filter("data_match").count() == 1


def test_common_columns_only(spark):
    a = spark.createDataFrame([(1, "a", 9)], "k int, v string, extra int")
    b = _df(spark, [(1, "a")])
    assert bag_diff_counts(a, b).first().missing_in_target == 0


def test_pk_duplicates_and_null_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3)], "a int, b int")
    got = sorted((r.a, r.b, r.n_rows) for r in pk_duplicates(df, ["a", "b"]).collect()
                 if r.a is not None) + [r.n_rows for r in pk_duplicates(df, ["a", "b"]).collect() if r.a is None]
    assert got == [(1, 1, 2), 1]


def test_fk_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "pk int")
    got = [(r.fk, r.n_rows) for r in fk_orphans(child, parent, ["fk"], ["pk"]).collect()]
    assert got == [(9, 1)]


def test_freshness(spark):
    df = spark.createDataFrame([("2024-01-02",), ("2024-03-01",)], "d string").select(F.to_date("d").alias("d"))
    r = data_freshness(df, "d", "t").first()
    assert str(r.latest_date) == "2024-03-01" and r.days_stale > 0 and r.checked_at is not None


def test_quality_log_append_and_newest_first(spark, tmp_dir):
    import os
    import time
    from strata.operators.quality import append_quality_log, read_quality_log, write_freshness
    src = _df(spark, [(1, "a"), (2, "b")])
    target = os.path.join(tmp_dir, "dq_log")
    append_quality_log(quality_log({"t1": (src, src)}), target)
    time.sleep(1.1)
    append_quality_log(quality_log({"t1": (src, src.filter("k = 1"))}), target)
    rows = read_quality_log(spark, target).collect()
    assert len(rows) == 2 and rows[0].load_time > rows[1].load_time
    assert rows[0].row_count_status == "MISMATCH" and rows[1].row_count_status == "OK"
    fresh = os.path.join(tmp_dir, "freshness")
    d = spark.createDataFrame([("2024-01-02",)], "d string").select(F.to_date("d").alias("d"))
    for _ in range(2):
        write_freshness(data_freshness(d, "d", "t"), fresh)
    assert spark.read.parquet(fresh).count() == 1


def _numbers(spark, n, changed=()):
    """n rows, a third of them equal; those whose number is in ``changed`` differ."""
    base = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit("some longer text").alias("t"),
                                 F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 5).alias("x"))
    return base.withColumn("t", F.when(F.col("k").isin([c for c in changed if c % 3]), "other").otherwise(F.col("t"))) if changed else base


@pytest.mark.parametrize("step,leaf_rows", [(2, 1), (4, 8), (12, 64)])
def test_digest_tree_finds_scattered_differences(spark, step, leaf_rows):
    n = 6000
    changed = list(range(1, n, 97))
    src, tgt = _numbers(spark, n), _numbers(spark, n, changed)
    got = quality.bag_compare(src, tgt, step=step, leaf_rows=leaf_rows).first()
    want = len([c for c in changed if c % 3])
    assert tuple(got) == (n, n, want, want)
    # only rows of the last buckets that differ are grouped whole
    _, differ, bits = quality.digest_tree({"x": (src, tgt)}, step, leaf_rows)
    hashed = quality._hashed({"x": (src, tgt)}).withColumn("_k", quality._bucket(bits))
    moved = hashed.join(differ, ["table_name", "_k"], "left_semi").groupBy("_h").count()
    assert moved.count() <= want * (2 + 2 * leaf_rows)


def test_digest_tree_of_equal_and_odd_layers(spark):
    same = _numbers(spark, 500)
    first, differ, bits = quality.digest_tree({"a": (same, same), "b": (same, same.union(same.limit(1)))})
    assert bits == quality.LEVEL_BITS and {r.table_name for r in differ.collect()} == {"b"}
    empty = same.limit(0)
    rows = {r.table_name: tuple(r)[1:] for r in quality.bag_compare_all({
        "equal": (same, same), "none": (empty, empty), "gone": (same, empty), "new": (empty, same), "twice": (same, same.union(same))}).collect()}
    assert rows == {"equal": (500, 500, 0, 0), "none": (0, 0, 0, 0), "gone": (500, 0, 500, 0), "new": (0, 500, 0, 500), "twice": (500, 1000, 0, 500)}
