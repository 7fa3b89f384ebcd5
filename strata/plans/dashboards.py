"""Dashboard tables over the gold listing table (currency-converted).

The reference pulled whole tables into pandas on the driver; here every
table is a Spark aggregate and only its small result would ever leave the
cluster. Per-city variants filter on the area (pushed below the joins of
the source view).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.aggregate import (distinct_values, group_metrics, histogram, mean, quantile,
                                       sorted_value_counts, value_counts)
from strata.operators.filters import count_extreme, dropna_subset, filter_not_null, filter_range, quantile_trim
from strata.operators.reshape import transpose_compare
from strata.operators.sample import sample_n
from strata.operators.window import share_of_group, top_n, top_n_per_group
from strata.plans.listings import gold_listings, gold_listings_usd, gold_sql
from strata.plans.registry import query

SAMPLE_SIZE = 5000
SAMPLE_SEED = 42
HIST_LO, HIST_HI, HIST_BINS = 0.0, 200000.0, 50
PRICE_MAX = 450000.0
MAX_MIN_NIGHTS = 90


def city_df(spark: SparkSession, sf_dir: str, city: str) -> DataFrame:
    return gold_listings_usd(spark, sf_dir).filter(F.col("area") == F.lit(city))


# ---------------------------------------------------------------- operators

def city_metrics(df: DataFrame, by: str = "area") -> DataFrame:
    return group_metrics(df, [by], {
        "avg_price": mean("price"),
        "avg_occupancy": F.avg("estimated_occupancy_l365d"),
        "listing_count": F.count("host_id"),
        "avg_rating": mean("review_scores_rating"),
    }).withColumnRenamed(by, "city")


def neighbourhood_stats(df: DataFrame) -> DataFrame:
    return group_metrics(df, ["area", "neighbourhood_cleansed"], {
        "avg_price": mean("price"),
        "avg_occupancy": F.avg("estimated_occupancy_l365d"),
        "listing_count": F.count("host_id"),
        "avg_rating": mean("review_scores_rating"),
    })


def city_overview(df: DataFrame) -> DataFrame:
    return group_metrics(df, ["area"], {
        "total_listings": F.count(F.lit(1)),
        "unique_hosts": F.count_distinct("host_id"),
        "avg_price": F.bround(mean("price"), 2),
        "avg_review_score": F.bround(mean("review_scores_rating"), 2),
        "occupancy_rate_est": F.bround(F.avg("estimated_occupancy_l365d") * 100, 2),
    })


def city_summary(df: DataFrame) -> DataFrame:
    return group_metrics(df, ["area"], {
        "total_listings": F.count(F.lit(1)),
        "avg_price": F.bround(mean("price"), 2),
        "avg_rating": F.bround(mean("review_scores_rating"), 2),
        "occupancy_rate": F.bround(F.avg("estimated_occupancy_l365d"), 2),
        "superhost_share": F.bround(F.avg(F.col("host_is_superhost").cast("double")) * 100, 2),
    })


def superhost_rate(df: DataFrame, by: str = "area") -> DataFrame:
    """Share (%) of listings whose flag is true; NULL counts as false."""
    flag = F.when(F.col("host_is_superhost"), F.lit(100.0)).otherwise(F.lit(0.0))
    return group_metrics(df, [by], {"superhost_rate": F.avg(flag)}).withColumnRenamed(by, "city")


def revenue_estimate(df: DataFrame, by: str = "area") -> DataFrame:
    """avg price x (avg occupancy / 100) x 365, and the occupancy as a
    fraction of the year (``occupancy_rate``)."""
    m = group_metrics(df, [by], {"avg_price": mean("price"), "avg_occupancy": F.avg("estimated_occupancy_l365d")})
    return (m.withColumn("estimated_annual_revenue", F.col("avg_price") * (F.col("avg_occupancy") / 100) * 365)
             .withColumn("occupancy_rate", F.col("avg_occupancy") / 365)
             .withColumnRenamed(by, "city"))


def review_scatter(df: DataFrame, n: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED, key: str = "id") -> DataFrame:
    """dropna -> price <= q99 -> sqrt scaling -> repeatable sample of n."""
    base = dropna_subset(df, ["number_of_reviews", "review_scores_rating", "price"])
    trimmed = quantile_trim(base, "price", 0.99)
    return sample_n(trimmed.withColumn("scaled_price", F.sqrt("price")), n, key, seed)


def rounded(df: DataFrame, *cols: str, digits: int = 4) -> DataFrame:
    """Means of doubles depend in their last bits on the order of addition;
    the registered queries compare them rounded, a little off the ties that
    means of prices in cents often are."""
    return df.withColumns({c: F.round(F.col(c) + 10.0 ** -(digits + 3), digits) for c in cols})


# ------------------------------------------------------------------ SQL bits

_CITY_METRICS_SQL = """SELECT area AS city, AVG(price) AS avg_price, AVG(estimated_occupancy_l365d) AS avg_occupancy,
       COUNT(host_id) AS listing_count, AVG(review_scores_rating) AS avg_rating
FROM gold_usd WHERE area IS NOT NULL GROUP BY area"""
_NEIGH_SQL = """SELECT area, neighbourhood_cleansed, AVG(price) AS avg_price,
       AVG(estimated_occupancy_l365d) AS avg_occupancy, COUNT(host_id) AS listing_count,
       AVG(review_scores_rating) AS avg_rating
FROM gold_usd WHERE area IS NOT NULL AND neighbourhood_cleansed IS NOT NULL
GROUP BY area, neighbourhood_cleansed"""


# ---------------------------------------------------------------- registered

@query("city_metrics", sql=gold_sql(f"""
SELECT city, round(avg_price + 1e-7, 4) AS avg_price, avg_occupancy AS avg_occupancy,
       listing_count, round(avg_rating + 1e-7, 4) AS avg_rating FROM ({_CITY_METRICS_SQL}) m"""))
def q_city_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = city_metrics(gold_listings_usd(spark, sf_dir))
    return rounded(m, "avg_price", "avg_rating").select("city", "avg_price", "avg_occupancy", "listing_count", "avg_rating")


# Display labels of the compared metrics.
METRIC_LABELS = {"avg_price": "Average Price (USD)", "avg_occupancy": "Average Occupancy (%)",
                 "listing_count": "Listing Count", "avg_rating": "Average Rating (out of 5)"}


@query("city_comparison", sql=gold_sql("""
SELECT metric, round(London + 1e-7, 4) AS London, round(Tokyo + 1e-7, 4) AS Tokyo,
       round_even((Tokyo - London) / London * 100, 2) AS pct_diff
FROM (""" + "\nUNION ALL\n".join(
    f"SELECT '{label}' AS metric, MAX(CASE WHEN city = 'London' THEN CAST({m} AS DOUBLE) END) AS London, "
    f"MAX(CASE WHEN city = 'Tokyo' THEN CAST({m} AS DOUBLE) END) AS Tokyo FROM m"
    for m, label in METRIC_LABELS.items()) + ") t", f"m AS ({_CITY_METRICS_SQL})"))
def q_city_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = city_metrics(gold_listings_usd(spark, sf_dir))
    t = transpose_compare(m, "city", list(METRIC_LABELS), "London", "Tokyo", labels=METRIC_LABELS)
    return rounded(t, "London", "Tokyo").select("metric", "London", "Tokyo", "pct_diff")


@query("neighbourhood_stats", sql=gold_sql(f"""
SELECT area, neighbourhood_cleansed, round(avg_price + 1e-7, 4) AS avg_price, avg_occupancy AS avg_occupancy,
       listing_count, round(avg_rating + 1e-7, 4) AS avg_rating FROM ({_NEIGH_SQL}) n"""))
def q_neighbourhood_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = neighbourhood_stats(gold_listings_usd(spark, sf_dir))
    return rounded(n, "avg_price", "avg_rating").select("area", "neighbourhood_cleansed", "avg_price",
                                                        "avg_occupancy", "listing_count", "avg_rating")


def _top_sql(metric: str, desc: bool) -> str:
    order = "DESC" if desc else "ASC"
    return gold_sql(f"""
SELECT area, neighbourhood_cleansed, round({metric} + 1e-7, 4) AS {metric} FROM (
  SELECT *, row_number() OVER (PARTITION BY area ORDER BY {metric} {order} NULLS LAST,
                                neighbourhood_cleansed) AS rn
  FROM ({_NEIGH_SQL}) n) t WHERE rn <= 5""")


def _top_query(metric: str, desc: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        n = neighbourhood_stats(gold_listings_usd(spark, sf_dir))
        t = top_n_per_group(n, "area", metric, 5, descending=desc, tie=["neighbourhood_cleansed"])
        return rounded(t, metric).select("area", "neighbourhood_cleansed", metric)
    return run


query("top_n_price_per_area", sql=_top_sql("avg_price", True))(_top_query("avg_price", True))
query("bottom_n_price_per_area", sql=_top_sql("avg_price", False))(_top_query("avg_price", False))
query("top_n_occupancy_per_area", sql=_top_sql("avg_occupancy", True))(_top_query("avg_occupancy", True))


@query("room_type_counts", sql=gold_sql("""
SELECT area AS city, room_type, COUNT(*) AS count FROM gold_usd
WHERE area IS NOT NULL AND room_type IS NOT NULL GROUP BY area, room_type"""))
def q_room_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = gold_listings_usd(spark, sf_dir).filter(F.col("area").isNotNull() & F.col("room_type").isNotNull())
    return value_counts(df, ["area", "room_type"]).withColumnRenamed("area", "city")


@query("room_type_share", sql=gold_sql("""
SELECT city, room_type, count, CAST(count AS DOUBLE) / SUM(count) OVER (PARTITION BY city) AS share
FROM (SELECT area AS city, room_type, COUNT(*) AS count FROM gold_usd
      WHERE area IS NOT NULL AND room_type IS NOT NULL GROUP BY area, room_type) c"""))
def q_room_type_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return share_of_group(q_room_type_counts(spark, sf_dir), "city", "count")


@query("superhost_rate", sql=gold_sql("""
SELECT area AS city, AVG(CASE WHEN host_is_superhost THEN 100.0 ELSE 0.0 END) AS superhost_rate
FROM gold_usd WHERE area IS NOT NULL GROUP BY area"""))
def q_superhost_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = superhost_rate(gold_listings_usd(spark, sf_dir))
    return s.select("city", "superhost_rate")


@query("revenue_estimate", sql=gold_sql("""
SELECT area AS city, round(AVG(price) + 1e-7, 4) AS avg_price, AVG(estimated_occupancy_l365d) AS avg_occupancy,
       round(AVG(price) * (AVG(estimated_occupancy_l365d) / 100) * 365 + 1e-5, 2) AS estimated_annual_revenue,
       AVG(estimated_occupancy_l365d) / 365 AS occupancy_rate
FROM gold_usd WHERE area IS NOT NULL GROUP BY area"""))
def q_revenue_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = revenue_estimate(gold_listings_usd(spark, sf_dir))
    r = rounded(rounded(r, "avg_price"), "estimated_annual_revenue", digits=2)
    return r.select("city", "avg_price", "avg_occupancy", "estimated_annual_revenue", "occupancy_rate")


@query("city_overview", sql=gold_sql("""
SELECT area, COUNT(*) AS total_listings, COUNT(DISTINCT host_id) AS unique_hosts,
       round_even(AVG(price), 2) AS avg_price, round_even(AVG(review_scores_rating), 2) AS avg_review_score,
       round_even(AVG(estimated_occupancy_l365d) * 100, 2) AS occupancy_rate_est
FROM gold_usd WHERE area IS NOT NULL GROUP BY area"""))
def q_city_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city_overview(gold_listings_usd(spark, sf_dir))


@query("city_summary", sql=gold_sql("""
SELECT area, COUNT(*) AS total_listings, round_even(AVG(price), 2) AS avg_price,
       round_even(AVG(review_scores_rating), 2) AS avg_rating,
       round_even(AVG(estimated_occupancy_l365d), 2) AS occupancy_rate,
       round_even(AVG(CAST(host_is_superhost AS DOUBLE)) * 100, 2) AS superhost_share
FROM gold_usd WHERE area IS NOT NULL GROUP BY area"""))
def q_city_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city_summary(gold_listings_usd(spark, sf_dir))


def _register_city(city: str, suffix: str = "") -> None:
    """The dashboard tables of one city."""
    one_city = f"one_city AS (SELECT * FROM gold_usd WHERE area = '{city}')"

    @query(f"price_histogram{suffix}", sql=gold_sql(f"""
    SELECT bin, CAST({HIST_LO} AS DOUBLE) + bin * CAST({(HIST_HI - HIST_LO) / HIST_BINS} AS DOUBLE) AS bin_start,
           CAST({HIST_LO} AS DOUBLE) + (bin + 1) * CAST({(HIST_HI - HIST_LO) / HIST_BINS} AS DOUBLE) AS bin_end,
           COUNT(*) AS count
    FROM (SELECT least(CAST(floor((price - {HIST_LO}) / {(HIST_HI - HIST_LO) / HIST_BINS}) AS INTEGER), {HIST_BINS - 1}) AS bin
          FROM one_city WHERE price >= {HIST_LO} AND price < {HIST_HI}) b
    GROUP BY bin""", one_city))
    def q_price_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
        return histogram(city_df(spark, sf_dir, city), "price", HIST_LO, HIST_HI, HIST_BINS)


    @query(f"price_by_availability{suffix}", sql=gold_sql("""
    SELECT availability_365, round(AVG(price) + 1e-7, 4) AS avg_price FROM one_city
    WHERE availability_365 IS NOT NULL GROUP BY availability_365""", one_city))
    def q_price_by_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
        g = group_metrics(city_df(spark, sf_dir, city), ["availability_365"], {"avg_price": mean("price")})
        return rounded(g, "avg_price").select("availability_365", "avg_price").orderBy("availability_365")


    def _top_neigh(metric_col: str, alias: str):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            g = group_metrics(city_df(spark, sf_dir, city), ["neighbourhood_cleansed"], {alias: mean(metric_col)})
            return rounded(top_n(g, alias, 10, tie=["neighbourhood_cleansed"]), alias).select("neighbourhood_cleansed", alias)
        return run


    def _top_neigh_sql(metric_col: str, alias: str) -> str:
        return gold_sql(f"""
    SELECT neighbourhood_cleansed, round({alias} + 1e-7, 4) AS {alias} FROM (
      SELECT neighbourhood_cleansed, AVG({metric_col}) AS {alias} FROM one_city
      WHERE neighbourhood_cleansed IS NOT NULL GROUP BY neighbourhood_cleansed) g
    ORDER BY {alias} DESC NULLS LAST, neighbourhood_cleansed LIMIT 10""", one_city)


    query(f"top_neighbourhood_price{suffix}", sql=_top_neigh_sql("price", "avg_price"))(_top_neigh("price", "avg_price"))
    query(f"top_neighbourhood_occupancy{suffix}", sql=_top_neigh_sql("estimated_occupancy_l365d", "avg_occupancy"))(
        _top_neigh("estimated_occupancy_l365d", "avg_occupancy"))


    @query(f"room_type_summary{suffix}", sql=gold_sql("""
    SELECT room_type, COUNT(price) AS count, round(AVG(price) + 1e-7, 4) AS mean FROM one_city
    WHERE room_type IS NOT NULL GROUP BY room_type""", one_city))
    def q_room_type_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
        g = group_metrics(city_df(spark, sf_dir, city), ["room_type"], {"count": F.count("price"), "mean": mean("price")})
        return rounded(g, "mean").select("room_type", "count", "mean").orderBy(F.desc_nulls_last("mean"))


    _TRIM_SQL = """trimmed AS (
      SELECT * FROM one_city
      WHERE number_of_reviews IS NOT NULL AND review_scores_rating IS NOT NULL AND price IS NOT NULL
        AND price <= (SELECT quantile_cont(price, 0.99) FROM one_city
                      WHERE number_of_reviews IS NOT NULL AND review_scores_rating IS NOT NULL AND price IS NOT NULL))"""


    @query(f"trim_q99{suffix}", sql=gold_sql("SELECT id, price, number_of_reviews, review_scores_rating FROM trimmed",
                                    one_city, _TRIM_SQL))
    def q_trim_q99(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = dropna_subset(city_df(spark, sf_dir, city), ["number_of_reviews", "review_scores_rating", "price"])
        return quantile_trim(base, "price", 0.99).select("id", "price", "number_of_reviews", "review_scores_rating")


    @query(f"review_scatter{suffix}", sql=gold_sql(f"""
    SELECT id, price, number_of_reviews, review_scores_rating, sqrt(price) AS scaled_price FROM trimmed
    ORDER BY md5(concat(CAST(id AS VARCHAR), '{SAMPLE_SEED}')), id LIMIT {SAMPLE_SIZE}""", one_city, _TRIM_SQL))
    def q_review_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = review_scatter(city_df(spark, sf_dir, city))
        return s.select("id", "price", "number_of_reviews", "review_scores_rating", "scaled_price")


_register_city("London")
_register_city("Tokyo", "_tokyo")


@query("neighbourhood_map_stats", sql=gold_sql("""
SELECT area, neighbourhood_cleansed, AVG(latitude) AS latitude, AVG(longitude) AS longitude,
       round(AVG(price) + 1e-7, 4) AS price, AVG(estimated_occupancy_l365d) AS estimated_occupancy_l365d
FROM gold_usd WHERE area IS NOT NULL AND neighbourhood_cleansed IS NOT NULL
GROUP BY area, neighbourhood_cleansed"""))
def q_neighbourhood_map_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["latitude", "longitude", "price", "estimated_occupancy_l365d"]
    g = group_metrics(gold_listings_usd(spark, sf_dir), ["area", "neighbourhood_cleansed"],
                      {c: mean(c) for c in cols})
    return rounded(g, "price").select("area", "neighbourhood_cleansed", *cols)


@query("price_quantile", sql=gold_sql("""
SELECT area, quantile_cont(price, 0.99) AS q99 FROM gold_usd
WHERE area IS NOT NULL AND price IS NOT NULL GROUP BY area"""))
def q_price_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantile(gold_listings_usd(spark, sf_dir), "price", 0.99, by=["area"], alias="q99")


@query("sample_n", sql=gold_sql(f"""
SELECT id, area, price FROM gold_usd
ORDER BY md5(concat(CAST(id AS VARCHAR), '{SAMPLE_SEED}')), id LIMIT {SAMPLE_SIZE}"""))
def q_sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_n(gold_listings_usd(spark, sf_dir).select("id", "area", "price"), SAMPLE_SIZE, "id", SAMPLE_SEED)


@query("map_points", sql=gold_sql("SELECT id, price, latitude, longitude FROM gold"))
def q_map_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_listings(spark, sf_dir).select("id", "price", "latitude", "longitude")


@query("value_counts", sql=gold_sql("SELECT minimum_nights, COUNT(*) AS count FROM gold GROUP BY minimum_nights"))
def q_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(gold_listings(spark, sf_dir), "minimum_nights")


@query("value_counts_by_area", sql=gold_sql(
    "SELECT area, bedrooms, COUNT(*) AS count FROM gold GROUP BY area, bedrooms"))
def q_value_counts_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(gold_listings(spark, sf_dir), ["area", "bedrooms"])


@query("value_counts_sorted", sql=gold_sql("""
SELECT minimum_nights, COUNT(*) AS count FROM gold WHERE price > 0
GROUP BY minimum_nights ORDER BY count DESC, minimum_nights NULLS FIRST"""))
def q_value_counts_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum stays of the listings with a price, the most frequent first."""
    return sorted_value_counts(filter_range(gold_listings(spark, sf_dir), "price", gt=0), "minimum_nights")


@query("value_counts_by_area_sorted", sql=gold_sql("""
SELECT area, bedrooms, COUNT(*) AS count FROM gold
GROUP BY area, bedrooms ORDER BY count DESC, area NULLS FIRST, bedrooms NULLS FIRST"""))
def q_value_counts_by_area_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_value_counts(gold_listings(spark, sf_dir), ["area", "bedrooms"])


@query("distinct_values", sql=gold_sql("SELECT DISTINCT area, room_type FROM gold"))
def q_distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(gold_listings(spark, sf_dir), ["area", "room_type"])


@query("filter_outliers", sql=gold_sql(f"""
SELECT id, price, minimum_nights FROM gold WHERE price < {PRICE_MAX} AND minimum_nights <= {MAX_MIN_NIGHTS}"""))
def q_filter_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = gold_listings(spark, sf_dir).select("id", "price", "minimum_nights")
    return filter_range(filter_range(df, "price", lt=PRICE_MAX), "minimum_nights", le=MAX_MIN_NIGHTS)


@query("count_extreme", sql=gold_sql(f"SELECT COUNT(*) AS n_extreme FROM gold WHERE price >= {PRICE_MAX}"))
def q_count_extreme(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_extreme(gold_listings(spark, sf_dir), "price", PRICE_MAX)


@query("filter_not_null", sql=gold_sql(
    "SELECT id, review_scores_rating FROM gold WHERE review_scores_rating IS NOT NULL"))
def q_filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_not_null(gold_listings(spark, sf_dir).select("id", "review_scores_rating"), ["review_scores_rating"])


@query("dropna_subset", sql=gold_sql("""
SELECT id, reviews_per_month, bedrooms FROM gold WHERE reviews_per_month IS NOT NULL AND bedrooms IS NOT NULL"""))
def q_dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dropna_subset(gold_listings(spark, sf_dir).select("id", "reviews_per_month", "bedrooms"),
                         ["reviews_per_month", "bedrooms"])
