"""Dirty-text parsing and projection queries over the listing-shaped view
and the customer table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import (parse_count_text, parse_flag, parse_list, parse_percent,
                              parse_price, valid_email, lenient_number)
from strata.operators.filters import uncastable_values
from strata.operators.project import add_metadata, cast_map, drop_columns, keep_columns
from strata.plans.registry import query
from strata.plans.testviews import LISTING_COLUMNS, listings_like, with_views
from strata.tables import table

LL = "listings_like"


@query("parse_price", sql=with_views("""
SELECT id, price AS price_text, TRY_CAST(translate(price, '$,', '') AS DOUBLE) AS price
FROM listings_like""", LL))
def q_parse_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = listings_like(spark, sf_dir)
    return df.select("id", F.col("price").alias("price_text"), parse_price("price").alias("price"))


@query("parse_percent", sql=with_views("""
SELECT id, host_response_rate,
       TRY_CAST(regexp_replace(host_response_rate, '%$', '') AS DOUBLE) AS host_response_percentage
FROM listings_like""", LL))
def q_parse_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = listings_like(spark, sf_dir)
    return df.select("id", "host_response_rate",
                     parse_percent("host_response_rate").alias("host_response_percentage"))


@query("parse_bathrooms", sql=with_views(r"""
SELECT id, bathrooms_text,
       CASE WHEN lower(trim(bathrooms_text)) LIKE '%half%' THEN CAST(0.5 AS DOUBLE)
            ELSE TRY_CAST(regexp_extract(bathrooms_text, '(\d+(\.\d+)?)', 1) AS DOUBLE) END AS bathrooms
FROM listings_like""", LL))
def q_parse_bathrooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = listings_like(spark, sf_dir)
    return df.select("id", "bathrooms_text", parse_count_text("bathrooms_text").alias("bathrooms"))


@query("parse_flag", sql=with_views("""
SELECT id, host_is_superhost AS flag_text,
       host_is_superhost = 't' AS flag_keep_null,
       coalesce(host_is_superhost = 't', false) AS flag_null_false
FROM listings_like""", LL))
def q_parse_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = listings_like(spark, sf_dir)
    return df.select("id", F.col("host_is_superhost").alias("flag_text"),
                     parse_flag("host_is_superhost").alias("flag_keep_null"),
                     parse_flag("host_is_superhost", null_as_false=True).alias("flag_null_false"))


_LIST_SQL = """CASE WHEN translate(amenities, '][\\"', '') = '' THEN CAST([] AS VARCHAR[])
     ELSE list_transform(string_split(translate(amenities, '][\\"', ''), ','), lambda x: trim(x)) END"""


@query("parse_list", sql=with_views(f"""
SELECT id, amenities AS amenities_text,
       CAST(len(items) AS INTEGER) AS n_items, array_to_string(items, '|') AS items_joined
FROM (SELECT id, amenities, {_LIST_SQL} AS items FROM listings_like) t""", LL))
def q_parse_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = listings_like(spark, sf_dir).select("id", "amenities", parse_list("amenities").alias("items"))
    return df.select("id", F.col("amenities").alias("amenities_text"),
                     F.size("items").alias("n_items"), F.array_join("items", "|").alias("items_joined"))


def amenity_counts(df: DataFrame, col: str = "amenities", trim_items: bool = True,
                   empty_as_empty: bool = True) -> DataFrame:
    """Tally of list items, lower-cased (explode + partial aggregation).
    ``trim_items=False, empty_as_empty=False`` reproduces a plain split."""
    items = df.select(F.explode(parse_list(col, trim_items, empty_as_empty)).alias("item"))
    return items.groupBy(F.lower("item").alias("item")).agg(F.count(F.lit(1)).alias("count"))


@query("amenity_counts", sql=with_views(f"""
SELECT item, COUNT(*) AS count
FROM (SELECT lower(unnest({_LIST_SQL})) AS item FROM listings_like) t
GROUP BY item""", LL))
def q_amenity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amenity_counts(listings_like(spark, sf_dir))


UNCASTABLE_COLUMNS = ["price", "host_response_rate", "bathrooms_text", "host_since",
                      "review_scores_rating", "bedrooms", "minimum_nights"]


@query("uncastable_values", sql=with_views("\nUNION ALL\n".join(
    f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM listings_like "
    f"WHERE {c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE) IS NULL"
    for c in UNCASTABLE_COLUMNS), LL))
def q_uncastable_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uncastable_values(listings_like(spark, sf_dir), UNCASTABLE_COLUMNS)


CASTS = {"minimum_nights": "int", "host_response_rate": "double", "bedrooms": "int", "price": "double"}


@query("cast_map", sql=with_views("""
SELECT id, TRY_CAST(minimum_nights AS INTEGER) AS minimum_nights,
       TRY_CAST(host_response_rate AS DOUBLE) AS host_response_rate,
       TRY_CAST(bedrooms AS INTEGER) AS bedrooms, TRY_CAST(price AS DOUBLE) AS price
FROM listings_like""", LL))
def q_cast_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = listings_like(spark, sf_dir).select("id", *CASTS)
    return cast_map(df, CASTS)


# The reference's keep-list for the single-city cleansing.
KEEP_COLUMNS = ['host_id', 'host_since', 'host_is_superhost', 'latitude', 'longitude', 'property_type',
                'room_type', 'accommodates', 'bathrooms', 'bathrooms_text', 'bedrooms', 'beds', 'amenities',
                'price', 'minimum_nights', 'maximum_nights', 'number_of_reviews', 'review_scores_rating',
                'license', 'instant_bookable', 'reviews_per_month']
_LL_NAMES = [n for n, _ in LISTING_COLUMNS]
KEEP_PRESENT = [c for c in KEEP_COLUMNS if c in _LL_NAMES]


@query("keep_columns", sql=with_views(f"SELECT {', '.join(KEEP_PRESENT)} FROM listings_like", LL))
def q_keep_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_columns(listings_like(spark, sf_dir), KEEP_PRESENT)


# The reference's drop-list for the two-city cleansing.
DROP_COLUMNS = ["listing_url", "scrape_id", "last_scraped", "source", "name", "description",
                "neighborhood_overview", "picture_url", "host_url", "host_name", "host_about",
                "host_thumbnail_url", "host_picture_url", "neighbourhood", "calendar_last_scraped",
                "processing_datetime", "host_location", "host_since", "first_review", "last_review"]


@query("drop_columns", sql=with_views(
    f"SELECT {', '.join(c for c in _LL_NAMES if c not in DROP_COLUMNS)} FROM listings_like", LL))
def q_drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_columns(listings_like(spark, sf_dir), DROP_COLUMNS)


@query("add_metadata", sql=with_views("""
SELECT id, 'London' AS area_label, true AS stamped FROM listings_like""", LL))
def q_add_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = add_metadata(listings_like(spark, sf_dir).select("id"), area_label="London")
    return df.select("id", "area_label", F.col("processing_datetime").isNotNull().alias("stamped"))


def email_view(customer: DataFrame) -> DataFrame:
    """Addresses built from customer names: valid, broken and NULL ones."""
    base = F.lower(F.regexp_replace("c_name", "#", "."))
    k = F.col("c_custkey")
    email = (F.when(k % 7 == 0, F.lit(None).cast("string"))
              .when(k % 5 == 0, F.concat(base, F.lit("@example")))
              .when(k % 3 == 0, F.concat(base, F.lit("example.org")))
              .when(k % 11 == 0, F.concat(F.lit("@"), base, F.lit(".org")))
              .otherwise(F.concat(base, F.lit("@example.org"))))
    return customer.select("c_custkey", email.alias("email"))


@query("valid_email", sql=r"""
SELECT c_custkey, email,
       coalesce(regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$'), false) AS is_valid
FROM (SELECT c_custkey,
        CASE WHEN c_custkey % 7 = 0 THEN NULL
             WHEN c_custkey % 5 = 0 THEN lower(replace(c_name, '#', '.')) || '@example'
             WHEN c_custkey % 3 = 0 THEN lower(replace(c_name, '#', '.')) || 'example.org'
             WHEN c_custkey % 11 = 0 THEN '@' || lower(replace(c_name, '#', '.')) || '.org'
             ELSE lower(replace(c_name, '#', '.')) || '@example.org' END AS email
      FROM customer) t
""")
def q_valid_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = email_view(table(spark, sf_dir, "customer"))
    return df.select("c_custkey", "email", valid_email("email").alias("is_valid"))


@query("lenient_number", sql=with_views("""
SELECT id, TRY_CAST(bathrooms_text AS DOUBLE) AS bathrooms_number,
       TRY_CAST(host_response_rate AS DOUBLE) AS response_number
FROM listings_like""", LL))
def q_lenient_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = listings_like(spark, sf_dir)
    return df.select("id", lenient_number(F.col("bathrooms_text")).alias("bathrooms_number"),
                     lenient_number(F.col("host_response_rate")).alias("response_number"))
