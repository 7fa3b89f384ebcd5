"""A key holding a third of all rows must not change results (and is split
across tasks by the plans: partial aggregation, partial window limits,
range-partitioned quantile selection)."""

import datetime

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from strata.operators.aggregate import quantiles, value_counts
from strata.operators.quality import bag_compare, fk_orphans, pk_duplicates
from strata.operators.window import top_n_per_group
from strata.plans import testviews


def _skewed(spark, n=3000):
    # key 0 holds a third of the rows; values repeat within groups
    rows = [(0 if i % 3 == 0 else 1 + i % 97, float((i * 7919) % 1013) / 4) for i in range(n)]
    return spark.createDataFrame(rows, "k int, v double").repartition(6), rows


def test_quantiles_on_a_hot_group(spark):
    df, rows = _skewed(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    got = {(r.k, r.q_index): r.quantile for r in quantiles(df, "v", [0.01, 0.5, 0.99], by=["k"]).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "v"])
    for (k, i), val in got.items():
        want = pdf[pdf.k == k].v.quantile([0.01, 0.5, 0.99][i])
        assert abs(val - want) < 1e-9
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hot_key_counts_and_top_n(spark):
    df, rows = _skewed(spark)
    counts = {r.k: r["count"] for r in value_counts(df, "k").collect()}
    assert counts[0] == 1000 and sum(counts.values()) == 3000
    top = top_n_per_group(df.withColumn("id", F.monotonically_increasing_id()), "k", "v", 2, tie=["id"])
    assert top.filter("k = 0").count() == 2 and top.count() == 2 * len(counts)


def test_key_checks_with_a_hot_key(spark):
    df, _ = _skewed(spark)
    dups = {r.k: r.n_rows for r in pk_duplicates(df, ["k"]).collect()}
    assert dups[0] == 1000
    parent = spark.createDataFrame([(k,) for k in range(1, 98)], "pk int")
    orphans = {r.k: r.n_rows for r in fk_orphans(df, parent, ["k"], ["pk"]).collect()}
    assert orphans == {0: 1000}
    r = bag_compare(df, df.filter("k <> 0 OR v > 100")).first()
    assert r.source_count == 3000 and r.extra_in_target == 0
    assert r.missing_in_target == df.filter("k = 0 AND v <= 100").count()


def test_flight_days_of_one_supplier_go_to_many_tasks(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(testviews, "FLIGHT_ROWS", 500, raising=False)
    day = datetime.datetime(1995, 1, 1)
    # supplier 1 holds four fifths of 5,000 line items, one of 500 days has 1,000 of them; keys that repeat, are missing or join nothing
    items = [(1 if i % 5 else None if i % 10 == 0 else 2 + i % 4, i % 40 if i % 97 else None, float(i % 50), "RAN"[i % 3], "FO"[i % 2],
              day if i % 4 == 0 else None if i % 501 == 0 else day + datetime.timedelta(days=i % 500)) for i in range(5000)]
    spark.createDataFrame(items, "l_suppkey long, l_partkey long, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
                          ).repartition(3).write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.createDataFrame([(1, 0), (2, 0), (3, 1), (3, 1), (4, 9)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_dir}/supplier.parquet")
    spark.createDataFrame([(0, "NATION 0", 2), (1, None, None)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_dir}/nation.parquet")
    base = testviews._flight_base(spark, tmp_dir)
    of_task = [r["count"] for r in base.groupBy(F.spark_partition_id()).count().collect()]
    assert len(of_task) >= 8 and max(of_task) < sum(of_task) / 4
    con = duckdb.connect()
    for t in ("lineitem", "supplier", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_dir}/{t}.parquet/*.parquet')")
    want = con.execute(testviews.with_views("SELECT * FROM arrival_like_base", "arrival_like")).fetchall()
    assert sorted(map(tuple, base.collect()), key=repr) == sorted(want, key=repr)
    got = testviews.flight_view(spark, tmp_dir, "arrival_like")
    assert testviews.flight_view(spark, tmp_dir, "atc_like").inputFiles() == got.inputFiles()     # written once for all three
