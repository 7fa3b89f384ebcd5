"""Input contracts of the reference's datasets, so the same files load
unchanged: field names and types in file order (fixed values)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import (DataType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)

from strata.sources.contracts import save_contract, with_metadata_fields

_TYPES: dict[str, DataType] = {"int": IntegerType(), "bigint": LongType(), "double": DoubleType(),
                               "string": StringType(), "timestamp": TimestampType()}

# Daily airport arrival ATFM delay file.
APT_DLY = """YEAR int, MONTH_NUM int, MONTH_MON string, FLT_DATE string, APT_ICAO string, APT_NAME string,
STATE_NAME string, FLT_ARR_1 int, DLY_APT_ARR_1 double, DLY_APT_ARR_A_1 double, DLY_APT_ARR_C_1 double,
DLY_APT_ARR_D_1 double, DLY_APT_ARR_E_1 double, DLY_APT_ARR_G_1 double, DLY_APT_ARR_I_1 double,
DLY_APT_ARR_M_1 double, DLY_APT_ARR_N_1 double, DLY_APT_ARR_O_1 double, DLY_APT_ARR_P_1 double,
DLY_APT_ARR_R_1 double, DLY_APT_ARR_S_1 double, DLY_APT_ARR_T_1 double, DLY_APT_ARR_V_1 double,
DLY_APT_ARR_W_1 double, DLY_APT_ARR_NA_1 double, FLT_ARR_1_DLY int, FLT_ARR_1_DLY_15 int"""

# Daily ATC pre-departure delay file.
ATC_PRE_DEP = """YEAR int, MONTH_NUM int, MONTH_MON string, FLT_DATE string, APT_ICAO string, APT_NAME string,
STATE_NAME string, FLT_DEP_1 int, FLT_DEP_IFR_2 int, DLY_ATC_PRE_2 double, FLT_DEP_3 int, DLY_ATC_PRE_3 double"""

# Daily en-route ATFM delay file.
ERT_DLY = """YEAR int, MONTH_NUM int, MONTH_MON string, FLT_DATE string, ENTITY_NAME string, ENTITY_TYPE string,
FLT_ERT_1 int, DLY_ERT_1 double, DLY_ERT_A_1 double, DLY_ERT_C_1 double, DLY_ERT_D_1 double, DLY_ERT_E_1 double,
DLY_ERT_G_1 double, DLY_ERT_I_1 double, DLY_ERT_M_1 double, DLY_ERT_N_1 double, DLY_ERT_O_1 double,
DLY_ERT_P_1 double, DLY_ERT_R_1 double, DLY_ERT_S_1 double, DLY_ERT_T_1 double, DLY_ERT_V_1 double,
DLY_ERT_W_1 double, DLY_ERT_NA_1 double, FLT_ERT_1_DLY int, FLT_ERT_1_DLY_15 int"""

# Listing snapshot (one city); the two-city snapshot appends LISTING_EXTRA.
LISTING = """listing_url string, scrape_id bigint, last_scraped string, source string, name string,
description string, neighborhood_overview string, picture_url string, host_id bigint, host_url string,
host_name string, host_since string, host_location string, host_about string, host_response_time string,
host_response_rate string, host_acceptance_rate string, host_is_superhost string, host_thumbnail_url string,
host_picture_url string, host_neighbourhood string, host_listings_count double, host_total_listings_count double,
host_verifications string, host_has_profile_pic string, host_identity_verified string, neighbourhood string,
neighbourhood_cleansed string, neighbourhood_group_cleansed double, latitude double, longitude double,
property_type string, room_type string, accommodates bigint, bathrooms double, bathrooms_text string,
bedrooms double, beds double, amenities string, price string, minimum_nights bigint, maximum_nights bigint,
minimum_minimum_nights bigint, maximum_minimum_nights bigint, minimum_maximum_nights bigint,
maximum_maximum_nights bigint, minimum_nights_avg_ntm double, maximum_nights_avg_ntm double,
calendar_updated double, has_availability string, availability_30 bigint, availability_60 bigint,
availability_90 bigint, availability_365 bigint, calendar_last_scraped string, number_of_reviews bigint,
number_of_reviews_ltm bigint, number_of_reviews_l30d bigint, first_review string, last_review string,
review_scores_rating double, review_scores_accuracy double, review_scores_cleanliness double,
review_scores_checkin double, review_scores_communication double, review_scores_location double,
review_scores_value double, license string, instant_bookable string, calculated_host_listings_count bigint,
calculated_host_listings_count_entire_homes bigint, calculated_host_listings_count_private_rooms bigint,
calculated_host_listings_count_shared_rooms bigint, reviews_per_month double"""
LISTING_EXTRA = """availability_eoy bigint, number_of_reviews_ly bigint, estimated_occupancy_l365d bigint,
estimated_revenue_l365d double"""

# Calendar file.
CALENDAR = """date string, available string, price string, adjusted_price string, minimum_nights bigint,
maximum_nights bigint"""

# Aggregated listing file.
AGG_LISTING = """name string, host_id bigint, host_name string, neighbourhood_group double, neighbourhood string,
latitude double, longitude double, room_type string, price bigint, minimum_nights bigint,
number_of_reviews bigint, last_review string, reviews_per_month double, calculated_host_listings_count bigint,
availability_365 bigint, number_of_reviews_ltm bigint, license string"""


def parse_fields(text: str) -> StructType:
    """``name type, name type, ...`` -> StructType (all nullable). Unlike
    ``StructType.fromDDL`` this needs no running session."""
    fields = []
    for part in text.replace("\n", " ").split(","):
        name, type_name = part.split()
        fields.append(StructField(name, _TYPES[type_name], True))
    return StructType(fields)


CONTRACTS: dict[str, str] = {
    "apt_dly": APT_DLY,
    "atc_pre_dep": ATC_PRE_DEP,
    "ert_dly": ERT_DLY,
    "listing": LISTING,
    "listing_two_city": LISTING + ", " + LISTING_EXTRA,
    "calendar": CALENDAR,
    "agg_listing": AGG_LISTING,
}

# Metadata stamped on each raw table at load time.
FLIGHT_METADATA = [("processing_datetime", TimestampType()), ("source_year", IntegerType()),
                   ("dataset_group", StringType())]
LISTING_METADATA = [("processing_datetime", TimestampType()), ("area", StringType())]


def contract(name: str) -> StructType:
    return parse_fields(CONTRACTS[name])


def raw_contract(name: str) -> StructType:
    """The contract plus the load-metadata fields of its raw table."""
    meta = FLIGHT_METADATA if name in ("apt_dly", "atc_pre_dep", "ert_dly") else LISTING_METADATA
    return with_metadata_fields(contract(name), meta)


def save_all(spark: SparkSession, directory: str) -> list[str]:
    """Write every contract as ``<name>_schema.json`` (what the loaders read)."""
    paths = []
    for name in CONTRACTS:
        path = f"{directory.rstrip('/')}/{name}_schema.json"
        save_contract(spark, contract(name), path)
        paths.append(path)
    return paths
