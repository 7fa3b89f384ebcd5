import duckdb
from pyspark.sql import functions as F

from conftest import SF_SMALL

from strata.plans import flights
from strata.plans.testviews import REASON_CODES, flight_view


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and df.columns == ["nationality", "order_count"]


def test_every_sql_twin_has_a_query():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 100


def test_unpivot_sums_equal_wide_sums(spark):
    silver = flights.silver_airport_arrival_daily(flight_view(spark, SF_SMALL, "arrival_like"))
    long = flights.gold_airport_arrival_delay_reason(silver)
    wide = silver.select(sum(F.col(f"DLY_APT_ARR_{c}_1") for c in REASON_CODES).alias("t")).agg(F.sum("t")).first()[0]
    assert long.agg(F.sum("delay_minutes")).first()[0] == wide
    # the 16 reasons add up to the total column (Q18)
    assert silver.filter(sum(F.col(f"DLY_APT_ARR_{c}_1") for c in REASON_CODES) != F.col("DLY_APT_ARR_1")).count() == 0
    assert set(r.delay_reason for r in long.select("delay_reason").distinct().collect()) <= set(REASON_CODES)


def test_monthly_equals_sum_of_daily(spark):
    silver = flights.silver_airport_arrival_daily(flight_view(spark, SF_SMALL, "arrival_like"))
    daily = flights.gold_airport_arrival_kpis_daily(silver)
    monthly = flights.gold_airport_arrival_kpis_monthly(silver)
    # rows with zero arrivals leave the daily table, so compare the arrivals total
    assert (daily.agg(F.sum("total_arrivals")).first()[0] == monthly.agg(F.sum("total_arrivals")).first()[0])
    assert daily.filter("total_arrivals <= 0").count() == 0
    assert daily.filter("delay_rate < 0 OR delay_rate > 1").count() == 0


def test_all_queries_match_sql_twins(spark):
    import sys, os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from check_oracle import TABLES, digest
    import __spark_entry__ as entry
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sqls = entry.oracle_sql()
    bad = []
    for name, fn in entry.queries().items():
        if name not in sqls:
            continue
        sdf = fn(spark, SF_SMALL).toPandas()
        ddf = con.execute(sqls[name]).df()
        if len(sdf) != len(ddf) or sorted(sdf.columns) != sorted(ddf.columns) or digest(sdf) != digest(ddf):
            bad.append(name)
    assert bad == []


def test_sorted_counts_come_in_the_order_of_their_twins(spark):
    import __spark_entry__ as entry
    con = duckdb.connect()
    for t in ("orders", "customer", "nation", "lineitem", "part", "supplier", "region", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("value_counts_sorted", "value_counts_by_area_sorted"):
        got = [tuple(r) for r in entry.queries()[name](spark, SF_SMALL).collect()]
        assert got and got == con.execute(entry.oracle_sql()[name]).fetchall()
