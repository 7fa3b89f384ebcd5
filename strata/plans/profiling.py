"""Missing-data analysis and numeric profiles of the cleansed listing table."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import year_of
from strata.operators.profile import (columns_with_missing, completeness, mean_by, missing_correlation,
                                      missing_distance, missing_percent, missing_rate_by, null_counts,
                                      profile_numeric, profile_text)
from strata.operators.aggregate import mean
from strata.plans.listings import cleansed_listings, cleansed_sql
from strata.plans.registry import query
from strata.tables import table

MISSING_COLS = ["host_since", "host_is_superhost", "bedrooms", "price", "review_scores_rating",
                "reviews_per_month", "bathrooms_text", "bathrooms", "latitude", "minimum_nights"]
NUMERIC_COLS = ["price", "review_scores_rating", "reviews_per_month", "bedrooms", "minimum_nights",
                "number_of_reviews", "latitude", "bathrooms"]


def _r6(c):
    return F.round(c, 6)


def _nulls(c: str) -> str:
    return f"(COUNT(*) - COUNT({c}))"


@query("null_counts", sql=cleansed_sql(
    "SELECT " + ", ".join(f"{_nulls(c)} AS {c}" for c in MISSING_COLS) + " FROM cleansed"))
def q_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_counts(cleansed_listings(spark, sf_dir), MISSING_COLS)


_PER_COLUMN = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {_nulls(c)} AS missing_count, COUNT(*) AS n_rows FROM cleansed"
    for c in MISSING_COLS)


@query("missing_percent", sql=cleansed_sql(f"""
SELECT column_name, missing_count,
       CAST((missing_count * 200000 + n_rows) // (2 * n_rows) AS DOUBLE) / CAST(1000 AS DOUBLE) AS missing_pct
FROM ({_PER_COLUMN}) m"""))
def q_missing_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_percent(cleansed_listings(spark, sf_dir), MISSING_COLS)


@query("columns_with_missing", sql=cleansed_sql(f"""
SELECT column_name, missing_count FROM ({_PER_COLUMN}) m WHERE missing_count > 0"""))
def q_columns_with_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns_with_missing(cleansed_listings(spark, sf_dir), MISSING_COLS)


@query("completeness", sql=cleansed_sql(f"""
SELECT CAST(SUM(n_rows) - SUM(missing_count) AS BIGINT) AS available_cells,
       CAST(SUM(missing_count) AS BIGINT) AS missing_cells, CAST(SUM(n_rows) AS BIGINT) AS total_cells
FROM ({_PER_COLUMN}) m WHERE missing_count > 0"""))
def q_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completeness(cleansed_listings(spark, sf_dir), MISSING_COLS, only_missing_columns=True)


def _ind(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END"


@query("missing_correlation", sql=cleansed_sql("\nUNION ALL\n".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
    f"CASE WHEN var_pop({_ind(a)}) = 0 OR var_pop({_ind(b)}) = 0 THEN NULL "
    f"ELSE round(corr({_ind(a)}, {_ind(b)}), 6) END AS correlation FROM cleansed"
    for a, b in combinations(MISSING_COLS, 2))))
def q_missing_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = missing_correlation(cleansed_listings(spark, sf_dir), MISSING_COLS)
    return m.withColumn("correlation", _r6("correlation"))


@query("missing_distance", sql=cleansed_sql("\nUNION ALL\n".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
    f"CAST(SUM(CASE WHEN ({a} IS NULL) <> ({b} IS NULL) THEN 1 ELSE 0 END) AS BIGINT) AS distance FROM cleansed"
    for a, b in combinations(MISSING_COLS, 2))))
def q_missing_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_distance(cleansed_listings(spark, sf_dir), MISSING_COLS)


@query("missing_by_year", sql=cleansed_sql("""
SELECT year, AVG(CASE WHEN review_scores_rating IS NULL THEN 1 ELSE 0 END) * 100 AS missing_pct
FROM (SELECT CAST(year(CAST(try_strptime(host_since, '%Y-%m-%d') AS DATE)) AS INTEGER) AS year,
             review_scores_rating FROM cleansed) t
WHERE year IS NOT NULL GROUP BY year"""))
def q_missing_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cleansed_listings(spark, sf_dir).withColumn("year", year_of("host_since"))
    return missing_rate_by(df, "review_scores_rating", "year")


@query("missing_by_category", sql=cleansed_sql("""
SELECT host_is_superhost, AVG(CASE WHEN reviews_per_month IS NULL THEN 1 ELSE 0 END) * 100 AS missing_pct
FROM cleansed WHERE host_is_superhost IS NOT NULL GROUP BY host_is_superhost"""))
def q_missing_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_rate_by(cleansed_listings(spark, sf_dir), "reviews_per_month", "host_is_superhost")


@query("mean_by_category", sql=cleansed_sql("""
SELECT bedrooms, round(AVG(reviews_per_month), 6) AS avg_reviews_per_month
FROM cleansed WHERE bedrooms IS NOT NULL GROUP BY bedrooms"""))
def q_mean_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mean_by(cleansed_listings(spark, sf_dir), "reviews_per_month", "bedrooms")
    return m.withColumn("avg_reviews_per_month", _r6("avg_reviews_per_month"))


@query("profile_numeric", sql=cleansed_sql("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS count, {_nulls(c)} AS missing, COUNT(DISTINCT {c}) AS distinct, "
    f"round(AVG({c}), 4) AS mean, round(STDDEV_SAMP({c}), 6) AS stddev, CAST(MIN({c}) AS DOUBLE) AS min, "
    f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS median, "
    f"round(quantile_cont({c}, 0.75), 6) AS q75, CAST(MAX({c}) AS DOUBLE) AS max FROM cleansed"
    for c in NUMERIC_COLS)))
def q_profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = profile_numeric(cleansed_listings(spark, sf_dir), NUMERIC_COLS)
    return p.select("column_name", "count", "missing", "distinct", F.round("mean", 4).alias("mean"), _r6("stddev").alias("stddev"), "min",
                    *[_r6(c).alias(c) for c in ("q25", "median", "q75")], "max")


TEXT_COLUMNS = ["bathrooms_text", "room_type", "host_since", "area"]


@query("profile_text", sql=cleansed_sql("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS count, {_nulls(c)} AS missing, COUNT(DISTINCT {c}) AS distinct, "
    f"MIN({c}) AS min, MAX({c}) AS max FROM cleansed" for c in TEXT_COLUMNS)))
def q_profile_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_text(cleansed_listings(spark, sf_dir), TEXT_COLUMNS)


@query("mean_of_dirty_numbers", sql="""
SELECT l_returnflag, round(1e9 * AVG(v) FILTER (WHERE NOT isnan(v)), 4) AS scaled_mean, COUNT(*) FILTER (WHERE isnan(v)) AS not_a_number
FROM (SELECT l_returnflag, CASE WHEN l_orderkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) WHEN l_orderkey % 5 = 0 THEN NULL
             ELSE CAST(l_quantity AS DOUBLE) * 1e-10 END AS v FROM lineitem) t
GROUP BY l_returnflag""")
def q_mean_of_dirty_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means over values far below one, NULLs and the text 'NaN'."""
    v = F.when(F.col("l_orderkey") % 7 == 0, F.lit("NaN")).when(F.col("l_orderkey") % 5 != 0, (F.col("l_quantity").cast("double") * 1e-10).cast("string"))
    text = table(spark, sf_dir, "lineitem").select("l_returnflag", v.alias("v"))
    number = F.col("v").cast("double")
    return text.groupBy("l_returnflag").agg(F.round(mean(number) * 1e9, 4).alias("scaled_mean"),
                                            F.count_if(F.isnan(number)).alias("not_a_number"))


@query("is_missing", sql=cleansed_sql("""
SELECT id, review_scores_rating IS NULL AS rating_missing, bedrooms IS NULL AS bedrooms_missing,
       bathrooms IS NULL AS bathrooms_missing FROM cleansed"""))
def q_is_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.operators.profile import null_to_nan_free
    df = null_to_nan_free(cleansed_listings(spark, sf_dir))
    return df.select("id", F.col("review_scores_rating").isNull().alias("rating_missing"),
                     F.col("bedrooms").isNull().alias("bedrooms_missing"),
                     F.col("bathrooms").isNull().alias("bathrooms_missing"))
