"""Rental-listing layers: the cleansed two-city gold table, the cleansed
single-city table, city unions and currency conversion.

All steps of a cleansing chain are collapsed into one projection, so the
whole chain is a single narrow stage (no shuffle) that Catalyst can prune.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import convert_currency, parse_count_text, parse_flag, parse_list, parse_percent, parse_price
from strata.operators.filters import filter_range
from strata.operators.reshape import union_by_name
from strata.plans.parsing import DROP_COLUMNS, KEEP_COLUMNS
from strata.plans.registry import query
from strata.plans.testviews import LISTING_COLUMNS, build_contract_listings, contract_listings_sql, listings_like, with_views
from strata.operators.project import add_metadata
from strata.sources.contracts import conform
from strata.sources.layers import materialized
from strata.sources.schemas import contract

# Cleansing lists of the two-city gold table.
GOLD_EXTRA_DROPS = ["estimated_revenue_l365d", "license", "calendar_updated", "neighbourhood_group_cleansed",
                    "host_neighbourhood", "amenities"]
GOLD_FLAGS = ["has_availability", "host_identity_verified", "host_has_profile_pic", "host_is_superhost",
              "instant_bookable"]
GOLD_REQUIRED = ["maximum_maximum_nights"]
GOLD_PERCENTS = {"host_response_rate": "host_response_percentage",
                 "host_acceptance_rate": "host_acceptance_percentage"}

# Currency factors per area used by the dashboards.
CURRENCY_RATES = {"Tokyo": 0.0065, "London": 0.77}


def cleanse_combined_listings(frames: list[DataFrame], drop: list[str] | None = None,
                              flags: list[str] | None = None, required: list[str] | None = None,
                              percents: dict[str, str] | None = None) -> DataFrame:
    """Union the city snapshots by name and cleanse them in one projection:
    drop unused columns; 't'/'f' flags -> boolean with NULL as false; drop
    rows missing a required column; count from bathroom text; money text ->
    double; percent text -> double (source text columns dropped).
    Frames must have the same columns, and the required ones be among them
    (an error otherwise); a warning names other columns that a step looks for in vain."""
    df = union_by_name(frames, allow_missing=False)
    drop = DROP_COLUMNS + GOLD_EXTRA_DROPS if drop is None else drop
    flags = GOLD_FLAGS if flags is None else flags
    required = GOLD_REQUIRED if required is None else required
    percents = GOLD_PERCENTS if percents is None else percents
    present = set(df.columns)
    absent = [r for r in required if r not in present]
    if absent:
        raise ValueError(f"required columns are absent: {', '.join(absent)}")
    missing = [c for c in [*flags, *percents, "price", "bathrooms_text"] if c not in present]
    if missing:
        warnings.warn(f"nothing to cleanse in absent columns: {', '.join(missing)}", stacklevel=2)
    for r in required:
        df = df.filter(F.col(r).isNotNull())
    gone = set(drop) | set(percents)
    out = []
    for c in df.columns:
        if c in gone:
            continue
        if c in flags:
            out.append(parse_flag(c, null_as_false=True).alias(c))
        elif c == "price":
            out.append(parse_price(c).alias(c))
        elif c == "bathrooms" and "bathrooms_text" in present:
            out.append(parse_count_text("bathrooms_text").alias(c))
        else:
            out.append(F.col(c))
    if "bathrooms_text" in present and "bathrooms" not in present:
        out.append(parse_count_text("bathrooms_text").alias("bathrooms"))
    for src, dst in percents.items():
        if src in present:
            out.append(parse_percent(src).alias(dst))
    return df.select(*out)


def cleanse_single_city(df: DataFrame, keep: list[str] | None = None, price_max: float = 10000,
                        max_min_nights: int = 90) -> DataFrame:
    """The single-city cleansing: keep-list, money text -> double, drop
    price outliers (``< price_max``) and long minimum stays
    (``<= max_min_nights``), bathroom count from text, 't'/'f' flags keeping
    NULL, list text -> array."""
    keep = KEEP_COLUMNS if keep is None else keep
    cols = [c for c in keep if c in df.columns] + [c for c in ("id", "area") if c in df.columns and c not in keep]
    df = df.select(*cols).withColumn("price", parse_price("price"))
    df = filter_range(filter_range(df, "price", lt=price_max), "minimum_nights", le=max_min_nights)
    out = []
    has_text = "bathrooms_text" in df.columns
    for c in df.columns:
        if c == "bathrooms" and has_text:
            continue
        if c in ("instant_bookable", "host_is_superhost"):
            out.append(parse_flag(c).alias(c))
        elif c == "amenities":
            out.append(parse_list(c).alias(c))
        else:
            out.append(F.col(c))
    if has_text:
        out.append(parse_count_text("bathrooms_text").alias("bathrooms"))
    return df.select(*out)


def city_frames(df: DataFrame, cities: list[str], area_col: str = "area") -> list[DataFrame]:
    return [df.filter(F.col(area_col) == F.lit(c)) for c in cities]


def gold_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold two-city table over the listing-shaped view (written once)."""
    return materialized(spark, f"gold-listings:{sf_dir}",
                        lambda: cleanse_combined_listings([listings_like(spark, sf_dir)]))


def gold_listings_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold table with the dashboards' currency conversion applied."""
    df = gold_listings(spark, sf_dir)
    return df.withColumn("price", convert_currency("price", "area", CURRENCY_RATES))


# -------------------------------------------------------------- SQL twins

_LL_NAMES = [n for n, _ in LISTING_COLUMNS]


def _gold_select(names: list[str]) -> list[str]:
    """The two-city cleansing of the columns ``names`` as SQL."""
    out = []
    for c in names:
        if c in set(DROP_COLUMNS + GOLD_EXTRA_DROPS) | set(GOLD_PERCENTS) | {"bathrooms"}:
            continue
        if c in GOLD_FLAGS:
            out.append(f"coalesce({c} = 't', false) AS {c}")
        elif c == "price":
            out.append("TRY_CAST(translate(price, '$,', '') AS DOUBLE) AS price")
        else:
            out.append(c)
    out.append(r"CASE WHEN lower(trim(bathrooms_text)) LIKE '%half%' THEN CAST(0.5 AS DOUBLE) "
               r"ELSE TRY_CAST(regexp_extract(bathrooms_text, '(\d+(\.\d+)?)', 1) AS DOUBLE) END AS bathrooms")
    return out + [f"TRY_CAST(regexp_replace({src}, '%$', '') AS DOUBLE) AS {dst}" for src, dst in GOLD_PERCENTS.items()]


_GOLD_SELECT = _gold_select(_LL_NAMES)
GOLD_CTE = "gold AS (SELECT " + ",\n  ".join(_GOLD_SELECT) + " FROM listings_like WHERE maximum_maximum_nights IS NOT NULL)"
GOLD_USD_CTE = ("gold_usd AS (SELECT * REPLACE ("
                "CASE WHEN price IS NOT NULL AND price <> 0 AND area = 'Tokyo' THEN price * CAST(0.0065 AS DOUBLE) "
                "WHEN price IS NOT NULL AND price <> 0 AND area = 'London' THEN price * CAST(0.77 AS DOUBLE) "
                "ELSE price END AS price) FROM gold)")


def gold_sql(sql: str, *extra: str) -> str:
    return with_views(sql, "listings_like", extra=(GOLD_CTE, GOLD_USD_CTE) + extra)


# ------------------------------------------------------------- registered

@query("combined_listings", sql=gold_sql("SELECT * FROM gold"))
def q_combined_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse_combined_listings(city_frames(listings_like(spark, sf_dir), ["London", "Tokyo"]))


#: When the registered load ran: a clock that its stamps can be compared by.
LOADED_AT = "2025-03-01 12:30:00"


@query("combined_listings_contract", sql="WITH " + contract_listings_sql() + "\nSELECT " + ",\n  ".join(
    _gold_select([*contract("listing_two_city").names, "area"]))
    + f",\n  '{LOADED_AT}' AS loaded_at FROM listings WHERE maximum_maximum_nights IS NOT NULL")
def q_combined_listings_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of the two-city contract, NULLs in most of them: each city's own frame, conformed to the contract and
    stamped with the load's area and time, then united by name and cleansed."""
    rows = build_contract_listings(spark, sf_dir)
    frames = []
    for city in ("London", "Tokyo"):
        columns = contract("listing_two_city").names
        raw = rows.where(F.col("area") == city).select(*(columns if city == "London" else reversed(columns)))
        frames.append(add_metadata(conform(raw, contract("listing_two_city")), timestamp_col="loaded_at", now=F.lit(LOADED_AT).cast("timestamp"), area=city))
    out = cleanse_combined_listings(frames)
    return out.withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))


SINGLE_CITY_PRICE_MAX = 450000.0

_SINGLE_COLS = [c for c in KEEP_COLUMNS if c in _LL_NAMES and c != "amenities"]


CLEANSED_CTE = ("cleansed AS (SELECT id, area, " + ", ".join(
    "host_is_superhost = 't' AS host_is_superhost" if c == "host_is_superhost"
    else "instant_bookable = 't' AS instant_bookable" if c == "instant_bookable"
    else "TRY_CAST(translate(price, '$,', '') AS DOUBLE) AS price" if c == "price" else c
    for c in _SINGLE_COLS)
    + r""", CASE WHEN lower(trim(bathrooms_text)) LIKE '%half%' THEN CAST(0.5 AS DOUBLE)
         ELSE TRY_CAST(regexp_extract(bathrooms_text, '(\d+(\.\d+)?)', 1) AS DOUBLE) END AS bathrooms,
  CAST(len(CASE WHEN translate(amenities, '][\"', '') = '' THEN CAST([] AS VARCHAR[])
       ELSE string_split(translate(amenities, '][\"', ''), ',') END) AS INTEGER) AS n_amenities,
  regexp_replace(translate(amenities, '][\"', ''), '\s*,\s*', '|', 'g') AS amenity_items
FROM listings_like
WHERE TRY_CAST(translate(price, '$,', '') AS DOUBLE) < """ + repr(SINGLE_CITY_PRICE_MAX) + " AND minimum_nights <= 90)")


def cleansed_sql(sql: str, *extra: str) -> str:
    return with_views(sql, "listings_like", extra=(CLEANSED_CTE,) + extra)


def cleansed_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-city cleansed table over the listing-shaped view (the
    amenity list as its items joined by bars and their count)."""
    def build():
        df = cleanse_single_city(listings_like(spark, sf_dir), price_max=SINGLE_CITY_PRICE_MAX)
        return (df.withColumn("n_amenities", F.size("amenities"))
                .withColumn("amenity_items", F.array_join("amenities", "|")).drop("amenities"))
    return materialized(spark, f"silver-listings:{sf_dir}", build)


@query("cleansed_listings", sql=cleansed_sql("SELECT * FROM cleansed"))
def q_cleansed_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleansed_listings(spark, sf_dir)


@query("union_cities", sql=gold_sql("""
SELECT id, area, price, 'London' AS city FROM gold_usd WHERE area = 'London'
UNION ALL
SELECT id, area, price, 'Tokyo' AS city FROM gold_usd WHERE area = 'Tokyo'"""))
def q_union_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = gold_listings_usd(spark, sf_dir).select("id", "area", "price")
    london, tokyo = city_frames(df, ["London", "Tokyo"])
    return union_by_name([london.withColumn("city", F.lit("London")), tokyo.withColumn("city", F.lit("Tokyo"))])


@query("convert_currency", sql=gold_sql("""
SELECT g.id, g.area, g.price AS price_local, u.price AS price_usd
FROM gold g JOIN gold_usd u ON g.id = u.id"""))
def q_convert_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = gold_listings(spark, sf_dir)
    return df.select("id", "area", F.col("price").alias("price_local"),
                     convert_currency("price", "area", CURRENCY_RATES).alias("price_usd"))
