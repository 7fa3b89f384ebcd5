"""Test-input views shaped like the reference's inputs, derived by Spark
from the driver tables (so their size grows with the tables).

``listings_like`` has the shape of a rental-listing snapshot (money text,
flags, list text, NULLs); ``arrival_like`` / ``enroute_like`` / ``atc_like``
have the shape of the daily flight-delay files. The same column
expressions are emitted as DuckDB CTE text for the SQL twins.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.layers import materialized
from strata.sources.schemas import contract
from strata.tables import table

# ---------------------------------------------------------------- listings

# Column expressions of the listing-shaped view (shared text).
LISTING_COLUMNS: list[tuple[str, str | None]] = [
    ("id", "o_orderkey"),
    ("host_id", "o_custkey"),
    ("area", "case when o_custkey % 2 = 0 then 'London' else 'Tokyo' end"),
    ("neighbourhood_cleansed", "n_name"),
    ("room_type", "o_orderpriority"),
    ("price", None),
    ("review_scores_rating",
     "case when o_orderkey % 5 = 0 then null else cast(3 + (o_orderkey % 200) * 0.01E0 as double) end"),
    ("reviews_per_month", "case when o_orderkey % 13 = 0 then null else cast(o_orderkey % 31 as double) end"),
    ("bedrooms", "case when o_orderkey % 19 = 0 then null else cast(o_orderkey % 5 as double) end"),
    ("estimated_occupancy_l365d", "cast(o_orderkey % 366 as bigint)"),
    ("availability_365", "cast((o_orderkey * 7) % 366 as bigint)"),
    ("number_of_reviews", "cast(o_orderkey % 501 as bigint)"),
    ("minimum_nights", "cast(o_orderkey % 120 as bigint)"),
    ("host_is_superhost",
     "case when o_orderkey % 7 = 0 then null when o_orderkey % 3 = 0 then 't' else 'f' end"),
    ("bathrooms_text",
     "case o_orderkey % 6 when 0 then 'Half-bath' when 1 then '1 bath' when 2 then '1.5 shared baths' "
     "when 3 then 'Shared half-bath' when 4 then null else 'Private bath' end"),
    ("amenities",
     "case o_orderkey % 4 when 0 then '[\"Wifi\", \"Hot tub\"]' when 1 then '[\"Kitchen\"]' "
     "when 2 then '[\"Wifi\", \"Kitchen\", \"TV\"]' else '[]' end"),
    ("host_response_rate",
     "case when o_orderkey % 9 = 0 then 'N/A' else concat(cast(o_orderkey % 101 as string), '%') end"),
    ("host_since", "case when o_orderkey % 17 = 0 then null else cast(cast(o_orderdate as date) as string) end"),
    ("host_acceptance_rate",
     "case when o_orderkey % 23 = 0 then null when o_orderkey % 8 = 0 then 'N/A' else concat(cast((o_orderkey * 3) % 101 as string), '%') end"),
    ("has_availability", "case when o_orderkey % 29 = 0 then null when o_orderkey % 4 = 0 then 'f' else 't' end"),
    ("host_identity_verified", "case when o_custkey % 5 = 0 then 'f' else 't' end"),
    ("host_has_profile_pic", "case when o_custkey % 31 = 0 then null else 't' end"),
    ("instant_bookable", "case when o_orderkey % 2 = 0 then 't' else 'f' end"),
    ("maximum_maximum_nights", "case when o_orderkey % 37 = 0 then null else cast(o_orderkey % 1125 as bigint) end"),
    ("license", "case when o_orderkey % 3 = 0 then null else concat('HM-', cast(o_orderkey as string)) end"),
    ("host_neighbourhood", "case when o_custkey % 3 = 0 then null else n_name end"),
    ("latitude", "cast(c_nationkey as double)"),
    ("longitude", "cast(0 - c_nationkey as double)"),
]

SPARK_PRICE = "case when o_orderkey % 11 = 0 then null else concat('$', format_number(o_totalprice, 2)) end"
DUCK_PRICE = "case when o_orderkey % 11 = 0 then null else concat('$', format('{:,.2f}', o_totalprice)) end"


def listings_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw listing table (written once per application)."""
    return materialized(spark, f"raw-listings:{sf_dir}", lambda: build_listings_like(spark, sf_dir))


def _listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
                  .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))


def build_listings_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listing_rows(spark, sf_dir).select(*[F.expr(e if e else SPARK_PRICE).alias(n) for n, e in LISTING_COLUMNS])


def listings_like_sql() -> str:
    cols = ",\n    ".join(f"{e if e else DUCK_PRICE} AS {n}" for n, e in LISTING_COLUMNS)
    return ("listings_like AS (\n  SELECT\n    " + cols +
            "\n  FROM orders JOIN customer ON o_custkey = c_custkey"
            " JOIN nation ON c_nationkey = n_nationkey\n)")


def _contract_columns() -> list[tuple[str, str | None]]:
    """An expression for every column of the two-city contract: the listing-shaped view's where it has one, else by type, with NULLs."""
    known, out = dict(LISTING_COLUMNS), []
    for j, f in enumerate(contract("listing_two_city").fields):
        if f.name in known:
            out.append((f.name, known[f.name]))
            continue
        kind = f.dataType.simpleString()
        value = {"string": f"concat('v{j}-', cast(o_orderkey % {97 + j} as string))",
                 "double": f"cast(o_orderkey % {50 + j} as double) / 4", "bigint": f"cast(o_orderkey % {50 + j} as bigint)"}[kind]
        out.append((f.name, f"case when o_orderkey % {5 + j % 11} = 0 then null else {value} end"))
    return [*out, ("area", known["area"])]


def build_contract_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with all columns of the two-city contract."""
    return _listing_rows(spark, sf_dir).select(*[F.expr(e if e else SPARK_PRICE).alias(n) for n, e in _contract_columns()])


def contract_listings_sql() -> str:
    cols = ",\n    ".join(f"{e if e else DUCK_PRICE} AS {n}" for n, e in _contract_columns())
    return ("listings AS (\n  SELECT\n    " + cols + "\n  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey\n)")


# ----------------------------------------------------------------- flights

# The 16 delay-reason codes in file order.
REASON_CODES = ["A", "C", "D", "E", "G", "I", "M", "N", "O", "P", "R", "S", "T", "V", "W", "NA"]

#: The supplier makes the files grow with the data.
FLIGHT_KEYS = ["l_shipdate", "n_name", "n_regionkey", "l_suppkey"]
#: Line items that a task groups: its hash maps hold about as many groups, some 600 bytes each.
FLIGHT_ROWS = 250_000
FLIGHT_AGGS: list[tuple[str, str]] = (
    [("f_n", "count(*)"), ("f_total", "sum(l_quantity)")]
    + [(f"f_r{i}", f"sum(case when l_partkey % 16 = {i} then l_quantity end)") for i in range(16)]
    + [("f_dly", "sum(case when l_returnflag = 'R' then 1 else 0 end)"),
       ("f_dly15", "sum(case when l_returnflag = 'R' and l_linestatus = 'F' then 1 else 0 end)")]
)

_MONTHS = "'JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC'"
_COMMON = [
    ("YEAR", "cast(year(l_shipdate) as int)"),
    ("MONTH_NUM", "cast(month(l_shipdate) as int)"),
    ("MONTH_MON", f"substr({_MONTHS}, cast(month(l_shipdate) * 3 - 2 as int), 3)"),
]
_ISO_DATE = "concat(cast(cast(l_shipdate as date) as string), 'T00:00:00Z')"
_FLIGHTS = "cast(case when day(l_shipdate) = 31 then 0 else f_n end as int)"
_AIRPORT = [
    ("APT_ICAO", "concat('eg', substr(n_name, 8))"),
    ("APT_NAME", "n_name"),
    ("STATE_NAME", "cast(n_regionkey as string)"),
]

ARRIVAL_COLUMNS = (
    _COMMON + [("FLT_DATE", _ISO_DATE)] + _AIRPORT
    + [("FLT_ARR_1", _FLIGHTS), ("DLY_APT_ARR_1", "f_total")]
    + [(f"DLY_APT_ARR_{c}_1", f"f_r{i}") for i, c in enumerate(REASON_CODES)]
    + [("FLT_ARR_1_DLY", "cast(f_dly as int)"), ("FLT_ARR_1_DLY_15", "cast(f_dly15 as int)")]
)
ENROUTE_COLUMNS = (
    _COMMON + [("FLT_DATE", _ISO_DATE), ("ENTITY_NAME", "n_name"), ("ENTITY_TYPE", "'ANSP'")]
    + [("FLT_ERT_1", _FLIGHTS), ("DLY_ERT_1", "f_total")]
    + [(f"DLY_ERT_{c}_1", f"f_r{i}") for i, c in enumerate(REASON_CODES)]
    + [("FLT_ERT_1_DLY", "cast(f_dly as int)"), ("FLT_ERT_1_DLY_15", "cast(f_dly15 as int)")]
)
ATC_COLUMNS = (
    _COMMON + [("FLT_DATE", "cast(cast(l_shipdate as date) as string)")] + _AIRPORT
    + [("FLT_DEP_1", _FLIGHTS),
       ("FLT_DEP_IFR_2", "case when day(l_shipdate) % 5 = 0 then null else cast(f_n as int) end"),
       ("DLY_ATC_PRE_2", "f_r0"),
       ("FLT_DEP_3", "cast(f_dly as int)"),
       ("DLY_ATC_PRE_3", "f_total")]
)
FLIGHT_VIEWS = {"arrival_like": ARRIVAL_COLUMNS, "enroute_like": ENROUTE_COLUMNS, "atc_like": ATC_COLUMNS}


def _flight_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    supp = (table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey")))
    # The suppliers are hashed, so no task sorts its line items. The join's shuffle would serve the groups as well, but a
    # supplier's days and most rows would then meet in few tasks; here the tasks grow with the rows.
    joined = li.join(supp.hint("shuffle_hash"), F.col("l_suppkey") == F.col("s_suppkey"))
    tasks = max(1, ceil(li.count() / FLIGHT_ROWS))
    return joined.repartition(tasks, *FLIGHT_KEYS).groupBy(*FLIGHT_KEYS).agg(*[F.expr(e).alias(n) for n, e in FLIGHT_AGGS])


def flight_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw flight table; the three share one written daily aggregate."""
    base = materialized(spark, f"raw-flights:{sf_dir}", lambda: _flight_base(spark, sf_dir))
    return base.selectExpr(*[f"{e} AS {n}" for n, e in FLIGHT_VIEWS[name]])


def flight_view_sql(name: str) -> str:
    aggs = ", ".join(f"{e} AS {n}" for n, e in FLIGHT_AGGS)
    cols = ",\n    ".join(f"{e} AS {n}" for n, e in FLIGHT_VIEWS[name])
    return (f"{name}_base AS (\n  SELECT {', '.join(FLIGHT_KEYS)}, {aggs}\n"
            "  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"
            " JOIN nation ON s_nationkey = n_nationkey\n"
            f"  GROUP BY {', '.join(FLIGHT_KEYS)}\n),\n"
            f"{name} AS (\n  SELECT\n    {cols}\n  FROM {name}_base\n)")


def with_views(sql: str, *views: str, extra: tuple[str, ...] = ()) -> str:
    """Prefix ``sql`` with the CTEs of the named test views, then ``extra``
    CTE definitions (``name AS (...)``) that may refer to them."""
    parts = [listings_like_sql() if v == "listings_like" else flight_view_sql(v) for v in views]
    parts.extend(extra)
    return "WITH " + ",\n".join(parts) + "\n" + sql
