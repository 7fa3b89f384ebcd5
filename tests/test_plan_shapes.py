"""The physical plans have the properties the design relies on at scale."""

import contextlib
import io

from conftest import SF_SMALL
from pyspark.sql import functions as F

from strata.operators.window import top_n_per_group
from strata.plans import dashboards, flights, tpch
from strata.plans.testviews import flight_view
from strata.tables import table

from strata.plans.registry import all_queries


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_parameter_filter_reaches_the_scan(spark):
    p = plan(tpch.q_customer_total_items(spark, SF_SMALL))
    assert "EqualTo(o_custkey,101)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p   # column pruning


def test_orders_counted_per_customer_before_the_join(spark):
    p = plan(tpch.q_top_nation_by_orders(spark, SF_SMALL))
    first_join = p.index("HashJoin")
    assert "partial_count(1)" in p[first_join:]   # below the join in the printed tree
    assert "ReadSchema: struct<o_custkey:bigint>" in p


def test_top_n_per_group_limits_before_the_shuffle(spark):
    li = table(spark, SF_SMALL, "lineitem")
    p = plan(top_n_per_group(li, "l_suppkey", "l_quantity", 3, tie=["l_orderkey", "l_linenumber"]))
    assert "WindowGroupLimit" in p and "Partial" in p
    partial = p.index("Partial")
    assert "Exchange" in p[:partial]              # the partial limit sits under the shuffle


def test_unpivot_and_daily_kpis_are_narrow(spark):
    silver = flights.silver_airport_arrival_daily(flight_view(spark, SF_SMALL, "arrival_like"))
    assert "Exchange" not in plan(flights.gold_airport_arrival_delay_reason(silver))
    assert "Exchange" not in plan(flights.gold_airport_arrival_kpis_daily(silver))


def test_global_quantile_trim_is_a_scalar_subquery(spark):
    p = plan(all_queries()["trim_q99"](spark, SF_SMALL))
    assert "Subquery" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_dimension_broadcast_only_under_the_bound(spark):
    p = plan(tpch.q_top_nation_by_orders(spark, SF_SMALL))
    assert "BroadcastExchange" in p               # nation: 25 rows, proven small


def test_bucketed_copies_join_without_a_shuffle(spark):
    from strata.sources import sinks
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = table(spark, SF_SMALL, "orders")
        li = table(spark, SF_SMALL, "lineitem")
        sinks.ctas(orders, "silver_orders_b", if_exists="replace", bucket_by=(8, ["o_orderkey"]))
        sinks.ctas(li, "silver_lineitem_b", if_exists="replace", bucket_by=(8, ["l_orderkey"]))
        o, l = spark.table("silver_orders_b"), spark.table("silver_lineitem_b")
        joined = l.join(o, l.l_orderkey == o.o_orderkey).groupBy("o_custkey").count()
        p = plan(joined)
        join_at = p.index("SortMergeJoin")
        assert "Exchange" not in p[join_at:]          # both sides read bucket-aligned
        assert joined.count() == orders.join(li, orders.o_orderkey == li.l_orderkey) \
            .select("o_custkey").distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))


def test_missing_patterns_computed_once_per_row(spark):
    from strata.plans import profiling
    p = plan(profiling.q_missing_correlation(spark, SF_SMALL))
    assert "size(array" not in p          # no inferred explode filter pushed into the scan
    # the matrix of co-missing counts is written once; the pairs come from that small table
    assert "posexplode" not in p and "MapInArrow" not in p and "ReadSchema: struct<i:int,j:int,sab:double>" in p


def test_bare_aggregates_come_from_footers(spark):
    from strata.tables import footer_stats
    path = f"{SF_SMALL}/orders.parquet"
    df = footer_stats(spark, path, n=("count", "*"), low=("min", "o_orderkey"), high=("max", "o_orderkey"), given=("count", "o_custkey"))
    plan = df._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*), MIN(o_orderkey), MAX(o_orderkey), COUNT(o_custkey)]" in plan
    orders = spark.read.parquet(path)
    want = orders.agg(F.count("*"), F.min("o_orderkey"), F.max("o_orderkey"), F.count("o_custkey")).first()
    assert tuple(df.first()) == tuple(want)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_clustered_copies_skip_files(spark, tmp_dir):
    from strata.sources import sinks
    sinks.ctas(spark.range(100_000).select(F.xxhash64("id").alias("k"), "id").repartition(4), f"{tmp_dir}/c", cluster_by=["id"])
    df = spark.read.parquet(f"{tmp_dir}/c").where("id BETWEEN 100 AND 200")
    assert len(df.collect()) == 101
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    read = leaf.metrics().get("numOutputRows").get().value()
    assert 101 <= read <= 50_000                           # the row groups of other ranges are not read


def test_large_geojson_collections_split(spark, tmp_dir):
    import json
    import os
    from strata.sources.geojson import read_geojson_collection, read_geojson_features
    features = [{"type": "Feature", "properties": {"name": f"n{i}, {{a}} ]", "note": "two\nlines"}, "geometry": {"type": "Point", "coordinates": [i, 1.5]}}
                for i in range(4000)]
    doc = {"type": "FeatureCollection", "name": "x", "features": features}
    for name, indent in (("tight", None), ("wide", 2)):
        os.makedirs(f"{tmp_dir}/{name}")
        with open(f"{tmp_dir}/{name}/a.geojson", "w") as f:
            json.dump(doc, f, indent=indent)
        got = read_geojson_collection(spark, f"{tmp_dir}/{name}")
        want = read_geojson_features(spark, f"{tmp_dir}/{name}")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 4000
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    small.conf.set("spark.sql.files.openCostInBytes", "1000")
    split = small.read.option("lineSep", '"Feature"').text(f"{tmp_dir}/wide")
    assert split.rdd.getNumPartitions() > 4
    assert read_geojson_collection(small, f"{tmp_dir}/wide").count() == 4000
    # a collection whose features do not begin with their type is read whole
    os.makedirs(f"{tmp_dir}/odd")
    with open(f"{tmp_dir}/odd/a.geojson", "w") as f:
        json.dump({"type": "FeatureCollection", "features": [dict(reversed(x.items())) for x in features[:50]]}, f)
    assert read_geojson_collection(spark, f"{tmp_dir}/odd").count() == 50
