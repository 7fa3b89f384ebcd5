import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators.aggregate import histogram, quantile, sorted_value_counts, value_counts
from strata.operators.filters import quantile_trim, uncastable_values
from strata.operators.profile import (completeness, missing_correlation, missing_distance, missing_percent,
                                      null_counts, profile_numeric)
from strata.operators.reshape import transpose_compare, union_by_name, unpivot_pairs
from strata.operators.sample import sample_n
from strata.operators.window import share_of_group, top_n_per_group


def test_unpivot_keeps_all_columns_and_sums(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 7.0), (3, None, 2.0)], "k int, a double, b double")
    long = unpivot_pairs(df, [("A", "a"), ("B", "b")], "reason", "minutes")
    assert long.count() == 6 and set(long.columns) == {"k", "a", "b", "reason", "minutes"}
    pos = long.filter("minutes > 0")
    assert sorted((r.k, r.reason) for r in pos.collect()) == [(2, "A"), (2, "B"), (3, "B")]
    wide_sum = df.select(F.sum(F.coalesce("a", F.lit(0.0)) + F.coalesce("b", F.lit(0.0)))).first()[0]
    assert pos.agg(F.sum("minutes")).first()[0] == wide_sum


def test_top_n_ties_nulls_small_groups(spark):
    df = spark.createDataFrame(
        [("x", "a", 3.0), ("x", "b", 3.0), ("x", "c", None), ("x", "d", 1.0), ("y", "e", 2.0)],
        "g string, name string, v double")
    top = top_n_per_group(df, "g", "v", 2, tie=["name"]).orderBy("g", "name").collect()
    assert [(r.g, r.name) for r in top] == [("x", "a"), ("x", "b"), ("y", "e")]
    bottom = top_n_per_group(df, "g", "v", 2, descending=False, tie=["name"]).orderBy("g", "name").collect()
    assert [(r.g, r.name) for r in bottom] == [("x", "a"), ("x", "d"), ("y", "e")]


def test_quantile_matches_linear_interpolation(spark):
    one = spark.createDataFrame([(5.0,)], "x double")
    assert quantile(one, "x", 0.99).first()[0] == 5.0
    two = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    assert abs(quantile(two, "x", 0.5).first()[0] - 2.0) < 1e-12
    assert abs(quantile(two, "x", 0.99).first()[0] - 2.98) < 1e-12
    trimmed = quantile_trim(two, "x", 0.5)
    assert [r.x for r in trimmed.collect()] == [1.0]


def test_quantile_with_duplicates_equals_pandas(spark):
    import pandas as pd
    vals = [1.0, 1.0, 1.0, 2.0, 10.0, 10.0, 3.5, 7.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for q in (0.1, 0.5, 0.9, 0.99):
        assert abs(quantile(df, "x", q).first()[0] - pd.Series(vals).quantile(q)) < 1e-9


def test_histogram_bins(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 19.9, 20.0, 999.9, 1000.0, -1.0, None]], "x double")
    h = {r.bin: r["count"] for r in histogram(df, "x", 0.0, 1000.0, 50).collect()}
    assert h == {0: 2, 1: 1, 49: 1}


def test_sample_n_repeatable_and_bounded(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    a = [r.k for r in sample_n(df, 10, "k", 42).collect()]
    b = [r.k for r in sample_n(df, 10, "k", 42).collect()]
    assert a == b and len(set(a)) == 10
    assert sample_n(df, 5000, "k", 42).count() == 100


def test_share_sums_to_one(spark):
    df = spark.createDataFrame([("L", "a", 3), ("L", "b", 1), ("T", "a", 5)], "c string, t string, n long")
    out = share_of_group(df, "c", "n").groupBy("c").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-12 for r in out)


def test_transpose_compare(spark):
    df = spark.createDataFrame([("London", 100.0, 10), ("Tokyo", 50.0, 0)], "city string, p double, n long")
    rows = {r.metric: r for r in transpose_compare(df, "city", ["p", "n"], "London", "Tokyo").collect()}
    assert rows["p"].pct_diff == -50.0 and rows["n"].pct_diff == -100.0
    z = spark.createDataFrame([("London", 0.0), ("Tokyo", 5.0)], "city string, p double")
    assert transpose_compare(z, "city", ["p"], "London", "Tokyo").first().pct_diff is None


def test_value_counts_keeps_null_group(spark):
    df = spark.createDataFrame([(1.0,), (None,), (None,), (1.0,), (2.0,)], "b double")
    got = [(r.b, r["count"]) for r in sorted_value_counts(df, "b").collect()]
    assert got == [(None, 2), (1.0, 2), (2.0, 1)]
    assert value_counts(df, ["b"]).count() == 3


def test_uncastable_values_one_pass(spark):
    df = spark.createDataFrame([("1", "x"), ("2.5", None), ("N/A", "3"), ("N/A", "")], "a string, b string")
    got = sorted((r.column_name, r.value) for r in uncastable_values(df, ["a", "b"]).collect())
    assert got == [("a", "N/A"), ("b", ""), ("b", "x")]


def test_missing_correlation_edge_cases(spark):
    rows = [(None, None, 1, 1.0), (1, 1, None, 1.0), (None, None, 1, 1.0), (1, 1, None, 1.0)]
    df = spark.createDataFrame(rows, "a int, b int, c int, k double")
    corr = {(r.column_a, r.column_b): r.correlation for r in missing_correlation(df, ["a", "b", "c", "k"]).collect()}
    assert abs(corr[("a", "b")] - 1.0) < 1e-12      # identical patterns
    assert abs(corr[("a", "c")] + 1.0) < 1e-12      # opposite patterns
    assert corr[("a", "k")] is None                 # constant indicator
    dist = {(r.column_a, r.column_b): r.distance for r in missing_distance(df, ["a", "b", "c"]).collect()}
    assert dist[("a", "b")] == 0 and dist[("a", "c")] == 4


def test_missing_counts_and_completeness(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (None, "x", 1.0), (3, "y", 2.0)], "a int, s string, d double")
    assert null_counts(df).first().asDict() == {"a": 1, "s": 1, "d": 1}
    mp = {r.column_name: r.missing_pct for r in missing_percent(df).collect()}
    assert mp == {"a": 33.333, "s": 33.333, "d": 33.333}
    c = completeness(df).first()
    assert (c.available_cells, c.missing_cells, c.total_cells) == (6, 3, 9)


def test_profile_numeric(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    p = profile_numeric(df).first()
    assert (p["count"], p.missing, p.distinct, p.min, p.max) == (4, 1, 4, 1.0, 4.0)
    assert p.median == 2.5 and p.q25 == 1.75 and math.isclose(p.stddev, 1.2909944487358056)


def test_union_by_name_allows_missing(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2, 3.0)], "k int, d double")
    u = union_by_name([a, b])
    assert u.count() == 2 and set(u.columns) == {"k", "s", "d"}


def test_distributed_quantiles_match_pandas(spark):
    import pandas as pd
    from hypothesis import given, settings, strategies as st, HealthCheck
    from strata.operators.aggregate import quantiles

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                              st.one_of(st.none(), st.integers(-50, 50).map(lambda x: x / 4))),
                    min_size=1, max_size=60),
           st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]), min_size=1, max_size=3))
    def check(rows, qs):
        df = spark.createDataFrame(rows, "g string, x double").repartition(3)
        got = {(r.g, r.q_index): r.quantile for r in quantiles(df, "x", qs, by=["g"]).collect()}
        pdf = pd.DataFrame(rows, columns=["g", "x"]).dropna()
        want = {}
        for g, part in pdf.groupby("g"):
            for i, q in enumerate(qs):
                want[(g, i)] = float(part["x"].quantile(q))
        assert got.keys() == want.keys()
        for k in want:
            assert abs(got[k] - want[k]) <= 1e-9 * max(1.0, abs(want[k]))

    check()


def test_missing_patterns_wider_than_one_bitmask_word(spark):
    k = 70
    rows = [tuple(None if (r + c) % (c % 5 + 2) == 0 else r for c in range(k)) for r in range(40)]
    schema = ", ".join(f"c{c} int" for c in range(k))
    df = spark.createDataFrame(rows, schema)
    got = {r.column_name: r.missing_count for r in missing_percent(df).collect()}
    want = {f"c{c}": sum(1 for row in rows if row[c] is None) for c in range(k)}
    assert got == want
    dist = {(r.column_a, r.column_b): r.distance for r in missing_distance(df, ["c1", "c65"]).collect()}
    assert dist[("c1", "c65")] == sum(1 for row in rows if (row[1] is None) != (row[65] is None))


def test_quantiles_keep_a_null_group(spark):
    from strata.operators.aggregate import quantiles
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, x double")
    got = {r.g: r.quantile for r in quantiles(df, "x", [0.5], by=["g"]).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_null_groups_survive_share_and_trim(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", 7.0)], "g string, x double")
    shares = {(r.g, r.x): r.share for r in share_of_group(df, "g", "x").collect()}
    assert shares[(None, 1.0)] == 0.25 and shares[("a", 7.0)] == 7.0 / 12.0
    kept = sorted((r.g or "", r.x) for r in quantile_trim(df, "x", 0.5, by=["g"]).collect())
    assert kept == [("", 1.0), ("a", 5.0)]


def test_approx_quantile_ignores_nan_and_null(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 101)] + [(float("nan"),), (None,)], "x double")
    exact = quantile(df, "x", 0.5).first()[0]
    approx = quantile(df, "x", 0.5, approx=True).first()[0]
    assert exact == 50.5 and abs(approx - exact) <= 1.0
    trimmed = quantile_trim(df, "x", 0.9, approx=True)
    assert trimmed.count() == 90


def test_means_ignore_nan_and_keep_small_values(spark):
    from strata.operators.aggregate import mean
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "v double")
    assert df.agg(mean("v")).first()[0] == 2.0
    assert spark.createDataFrame([(1e-9,), (3e-9,)], "v double").agg(mean("v")).first()[0] == 2e-9
    assert spark.createDataFrame([(1e31,)], "v double").agg(mean("v")).first()[0] == 1e31


def test_checksum_and_diff_see_shifted_nulls(spark):
    from strata.operators.quality import layer_checksum, layer_diff
    a = spark.createDataFrame([(None, 5), (1, 1)], "x int, y int")
    b = spark.createDataFrame([(5, None), (1, 1)], "x int, y int")
    assert not layer_checksum({"t": (a, b)}).first().checksum_match
    d = layer_diff({"t": (a, b), "same": (a, a)}).orderBy("table_name").collect()
    assert (d[0].missing_in_target, d[0].data_match) == (0, True)
    assert (d[1].missing_in_target, d[1].extra_in_target) == (1, 1)


def test_bag_compare_counts_copies(spark):
    from strata.operators.quality import bag_compare
    a = spark.createDataFrame([(1,)] * 3 + [(2,)], "x int")
    b = spark.createDataFrame([(1,)] + [(3,)] * 2, "x int")
    assert tuple(bag_compare(a, b).first()) == (4, 3, 3, 2)
    assert tuple(bag_compare(a.limit(0), b.limit(0)).first()) == (0, 0, 0, 0)


def test_reshape_takes_any_label(spark):
    from strata.operators.reshape import transpose_compare, unpivot_pairs
    df = spark.createDataFrame([("New York", 2.0), ("St. John's", 3.0)], "city string, `avg ``x``` double")
    t = transpose_compare(df, "city", ["avg `x`"], "New York", "St. John's", labels={"avg `x`": "it's"}).first()
    assert tuple(t) == ("it's", 2.0, 3.0, 50.0)
    rows = unpivot_pairs(df, [("a 'b'", "avg `x`")], "name", "value", keep=["city"]).collect()
    assert sorted(tuple(r) for r in rows) == [("New York", "a 'b'", 2.0), ("St. John's", "a 'b'", 3.0)]


def test_sample_n_orders_little_more_than_n(spark):
    from strata.operators.sample import sample_key, sample_n
    df = spark.range(20000).withColumnRenamed("id", "k")
    want = [r.k for r in df.withColumn("h", sample_key("k", 7)).orderBy("h", "k").limit(300).collect()]
    assert [r.k for r in sample_n(df, 300, "k", 7).collect()] == want
    assert sample_n(df.limit(5), 300, "k").count() == 5 and sample_n(df.limit(0), 3, "k").count() == 0


def test_quantile_bracket_beyond_the_sketch(spark, monkeypatch):
    import numpy as np
    from strata.operators import aggregate
    monkeypatch.setattr(aggregate, "BRACKET_ACCURACY", 200)
    r = np.random.default_rng(4)
    x = r.integers(0, 3000, 8000) / 7
    df = spark.createDataFrame([(float(v), i % 2) for i, v in enumerate(x)], "v double, g int")
    got = {(r_.g, r_.q_index): r_.quantile for r_ in aggregate.quantiles(df, "v", [0.0, 0.25, 0.5, 0.99, 1.0], by=["g"]).collect()}
    for g in (0, 1):
        for i, q in enumerate((0.0, 0.25, 0.5, 0.99, 1.0)):
            assert abs(got[g, i] - np.quantile(x[g::2], q)) < 1e-9


def test_profile_text(spark):
    from strata.operators.profile import profile_text
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), ("b", 4)], "t string, n int")
    assert [tuple(r) for r in profile_text(df).collect()] == [("t", 3, 1, 2, "a", "b")]


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("accuracy,ordered", [(3, 10), (40, 50), (10000, 100_000)])
def test_quantiles_prove_their_bracket(spark, by, accuracy, ordered):
    """A coarse sketch brackets badly and brackets too large to order are narrowed: the result is exact all the same."""
    from strata.operators.aggregate import quantiles
    r = np.random.default_rng(accuracy)
    x = np.concatenate([r.lognormal(3, 2, 2500), np.full(900, 7.0), r.integers(0, 5, 600)])
    pdf = pd.DataFrame({"x": x, "g": np.where(r.random(len(x)) < 0.8, "a", "b")})
    qs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    df = spark.createDataFrame(pdf)
    got = {(r.g if by else None, r.q_index): r.quantile for r in quantiles(df, "x", qs, by=by, accuracy=accuracy, ordered=ordered).collect()}
    groups = {None: pdf.x} if not by else dict(list(pdf.groupby("g").x))
    assert got == {(g, i): pytest.approx(float(v.quantile(q)), rel=1e-12) for g, v in groups.items() for i, q in enumerate(qs)}


def test_forced_bad_bracket(spark, monkeypatch):
    from strata.operators import aggregate
    real = F.percentile_approx
    wrong = lambda col, at, accuracy: F.transform(real(col, at, accuracy), lambda v: v + 1000) if isinstance(at, list) else real(col, at, accuracy)
    df = spark.range(5000).select(F.col("id").cast("double").alias("x"))
    monkeypatch.setattr(aggregate.F, "percentile_approx", wrong)
    got = [r.quantile for r in aggregate.quantiles(df, "x", [0.1, 0.5, 0.9], accuracy=100, ordered=200).orderBy("q_index").collect()]
    assert got == pytest.approx([499.9, 2499.5, 4499.1], rel=1e-12)


def test_co_missing_of_many_columns_with_different_patterns(spark):
    from strata.operators.profile import missing_correlation, missing_distance
    r = np.random.default_rng(3)
    k, n = 78, 400
    gone = r.random((n, k)) < r.random(k)
    gone[:, 5] = False
    rows = [tuple(None if m else i for m in row) for i, row in enumerate(gone)]
    cols = [f"c{j}" for j in range(k)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in cols)).repartition(5)
    got = {(x.column_a, x.column_b): x.distance for x in missing_distance(df, cols).collect()}
    assert got == {(cols[i], cols[j]): int((gone[:, i] != gone[:, j]).sum()) for i in range(k) for j in range(i + 1, k)}
    corr = {(x.column_a, x.column_b): x.correlation for x in missing_correlation(df, cols).collect()}
    assert corr[("c5", "c6")] is None and corr[("c1", "c2")] == pytest.approx(np.corrcoef(gone[:, 1], gone[:, 2])[0, 1])
    assert missing_distance(df.limit(0), cols).count() == 0


def test_add_metadata_takes_a_clock(spark):
    import datetime as dt
    from strata.operators.project import add_metadata
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3))], "id int, at timestamp")
    fixed = dt.datetime(2024, 5, 6, 7, 8, 9)
    assert add_metadata(df, now=fixed).first().processing_datetime == fixed
    assert add_metadata(df, now=F.col("at")).first().processing_datetime == dt.datetime(2024, 1, 2, 3)
    assert add_metadata(df).first().processing_datetime is not None
