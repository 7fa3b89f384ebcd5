"""Flight-delay layer: three silver datasets and eight gold datasets.

Silver: parse the date (time suffix stripped, unreadable -> NULL), upper-case
the airport code, fill delay-minute columns found by prefix with 0.
Gold: delay minutes unpivoted by reason (16 reason codes, zero rows
dropped), daily KPIs with safe ratios, monthly KPIs by grouped sums.

Each function takes the upstream DataFrame, so raw -> silver -> gold is one
Catalyst plan unless the caller writes a layer out. The unpivot and the daily
KPIs are narrow (no shuffle); the monthly KPIs shuffle only the partial
aggregates (one row per task per group).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import parse_date, safe_ratio
from strata.operators.project import fill_prefixed
from strata.operators.reshape import unpivot_pairs
from strata.plans.registry import query
from strata.plans.testviews import REASON_CODES, flight_view, with_views

# ------------------------------------------------------------------ silver


def silver_enroute_daily(raw: DataFrame) -> DataFrame:
    return raw.select(
        "YEAR", "MONTH_NUM", "MONTH_MON",
        parse_date("FLT_DATE").alias("flt_date"),
        "ENTITY_NAME", "ENTITY_TYPE",
        "FLT_ERT_1", "FLT_ERT_1_DLY", "FLT_ERT_1_DLY_15",
        *fill_prefixed(raw, "DLY_ERT_", 0.0),
    )


def silver_airport_arrival_daily(raw: DataFrame) -> DataFrame:
    return raw.select(
        "YEAR", "MONTH_NUM", "MONTH_MON",
        parse_date("FLT_DATE").alias("flt_date"),
        F.upper("APT_ICAO").alias("apt_icao"),
        "APT_NAME", "STATE_NAME",
        "FLT_ARR_1", "FLT_ARR_1_DLY", "FLT_ARR_1_DLY_15",
        *fill_prefixed(raw, "DLY_APT_ARR_", 0.0),
    )


def silver_airport_atc_departure_daily(raw: DataFrame) -> DataFrame:
    return raw.select(
        "YEAR", "MONTH_NUM", "MONTH_MON",
        parse_date("FLT_DATE", strip_time=False).alias("flt_date"),
        F.upper("APT_ICAO").alias("apt_icao"),
        "APT_NAME", "STATE_NAME",
        "FLT_DEP_1",
        F.coalesce("FLT_DEP_IFR_2", F.lit(0)).alias("flt_dep_ifr"),
        F.coalesce("DLY_ATC_PRE_2", F.lit(0.0)).alias("dly_atc_pre_min"),
    )


# -------------------------------------------------------------------- gold


def delay_by_reason(silver: DataFrame, prefix: str, keep: list[str] | None = None) -> DataFrame:
    """Unpivot the 16 reason columns ``{prefix}{code}_1`` into
    (delay_reason, delay_minutes), keeping rows with minutes > 0."""
    pairs = [(code, f"{prefix}{code}_1") for code in REASON_CODES]
    return (unpivot_pairs(silver, pairs, "delay_reason", "delay_minutes", keep=keep)
            .filter(F.col("delay_minutes") > 0))


def gold_airport_arrival_delay_reason(silver: DataFrame) -> DataFrame:
    return delay_by_reason(silver, "DLY_APT_ARR_")


def gold_enroute_delay_by_reason(silver: DataFrame) -> DataFrame:
    return delay_by_reason(silver, "DLY_ERT_", keep=["YEAR", "MONTH_NUM", "ENTITY_NAME"])


@dataclass(frozen=True)
class Kpis:
    """What the KPI tables of one silver dataset report."""
    place: list[str]
    flights: str                    # the count a day needs to be reported, and the ratio's denominator
    measures: dict[str, str]        # silver column -> reported name, in output order
    ratio: tuple[str, str]          # numerator, reported name


_AIRPORT = ["apt_icao", "APT_NAME", "STATE_NAME"]
ARRIVAL_KPIS = Kpis(_AIRPORT, "FLT_ARR_1", {
    "FLT_ARR_1": "total_arrivals", "FLT_ARR_1_DLY": "delayed_arrivals", "FLT_ARR_1_DLY_15": "delays_over_15min"},
    ("FLT_ARR_1_DLY", "delay_rate"))
ENROUTE_KPIS = Kpis(["ENTITY_NAME", "ENTITY_TYPE"], "FLT_ERT_1", {
    "FLT_ERT_1": "total_flights", "FLT_ERT_1_DLY": "delayed_flights", "FLT_ERT_1_DLY_15": "delays_over_15min"},
    ("FLT_ERT_1_DLY", "delay_rate"))
DEPARTURE_KPIS = Kpis(_AIRPORT, "FLT_DEP_1", {
    "FLT_DEP_1": "total_departures", "flt_dep_ifr": "ifr_departures", "dly_atc_pre_min": "atc_pre_delay_minutes"},
    ("dly_atc_pre_min", "avg_delay_min_per_flight"))


def daily_kpis(silver: DataFrame, kpis: Kpis) -> DataFrame:
    """The measures of each day and place with flights, and their ratio."""
    measures = [F.col(c).alias(name) for c, name in kpis.measures.items()]
    numerator, name = kpis.ratio
    return silver.filter(F.col(kpis.flights) > 0).select(
        "YEAR", "MONTH_NUM", "MONTH_MON", "flt_date", *kpis.place, *measures, safe_ratio(numerator, kpis.flights).alias(name))


def monthly_kpis(silver: DataFrame, kpis: Kpis) -> DataFrame:
    """The measures' sums per month and place."""
    return silver.groupBy("YEAR", "MONTH_NUM", *kpis.place).agg(*[F.sum(c).alias(name) for c, name in kpis.measures.items()])


def gold_airport_arrival_kpis_daily(silver: DataFrame) -> DataFrame:
    return daily_kpis(silver, ARRIVAL_KPIS)


def gold_airport_arrival_kpis_monthly(silver: DataFrame) -> DataFrame:
    return monthly_kpis(silver, ARRIVAL_KPIS)


def gold_enroute_kpis_daily(silver: DataFrame) -> DataFrame:
    return daily_kpis(silver, ENROUTE_KPIS)


def gold_enroute_kpis_monthly(silver: DataFrame) -> DataFrame:
    return monthly_kpis(silver, ENROUTE_KPIS)


def gold_airport_atc_departure_kpis_daily(silver: DataFrame) -> DataFrame:
    return daily_kpis(silver, DEPARTURE_KPIS)


def gold_airport_atc_departure_kpis_monthly(silver: DataFrame) -> DataFrame:
    return monthly_kpis(silver, DEPARTURE_KPIS)


# ----------------------------------------------------------- SQL twins

_ARR_REASONS = [f"DLY_APT_ARR_{c}_1" for c in REASON_CODES]
_ERT_REASONS = [f"DLY_ERT_{c}_1" for c in REASON_CODES]

SILVER_ARRIVAL_SQL = ("silver_arrival AS (SELECT YEAR, MONTH_NUM, MONTH_MON,\n"
                      "  CAST(try_strptime(regexp_replace(FLT_DATE, 'T.*', ''), '%Y-%m-%d') AS DATE) AS flt_date,\n"
                      "  upper(APT_ICAO) AS apt_icao, APT_NAME, STATE_NAME, FLT_ARR_1, FLT_ARR_1_DLY, FLT_ARR_1_DLY_15,\n  "
                      + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in ["DLY_APT_ARR_1"] + _ARR_REASONS)
                      + "\n  FROM arrival_like)")
SILVER_ENROUTE_SQL = ("silver_enroute AS (SELECT YEAR, MONTH_NUM, MONTH_MON,\n"
                      "  CAST(try_strptime(regexp_replace(FLT_DATE, 'T.*', ''), '%Y-%m-%d') AS DATE) AS flt_date,\n"
                      "  ENTITY_NAME, ENTITY_TYPE, FLT_ERT_1, FLT_ERT_1_DLY, FLT_ERT_1_DLY_15,\n  "
                      + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in ["DLY_ERT_1"] + _ERT_REASONS)
                      + "\n  FROM enroute_like)")
SILVER_ATC_SQL = ("silver_atc AS (SELECT YEAR, MONTH_NUM, MONTH_MON,\n"
                  "  CAST(try_strptime(FLT_DATE, '%Y-%m-%d') AS DATE) AS flt_date,\n"
                  "  upper(APT_ICAO) AS apt_icao, APT_NAME, STATE_NAME, FLT_DEP_1,\n"
                  "  coalesce(FLT_DEP_IFR_2, 0) AS flt_dep_ifr, coalesce(DLY_ATC_PRE_2, 0.0) AS dly_atc_pre_min\n"
                  "  FROM atc_like)")


def _arr(sql: str) -> str:
    return with_views(sql, "arrival_like", extra=(SILVER_ARRIVAL_SQL,))


def _ert(sql: str) -> str:
    return with_views(sql, "enroute_like", extra=(SILVER_ENROUTE_SQL,))


def _atc(sql: str) -> str:
    return with_views(sql, "atc_like", extra=(SILVER_ATC_SQL,))


def _reason_union(source: str, cols: str, reason_cols: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {cols}, '{code}' AS delay_reason, {c} AS delay_minutes FROM {source} WHERE {c} > 0"
        for code, c in zip(REASON_CODES, reason_cols))


# ------------------------------------------------------------- registered

@query("silver_airport_arrival_daily", sql=_arr("SELECT * FROM silver_arrival"))
def q_silver_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_airport_arrival_daily(flight_view(spark, sf_dir, "arrival_like"))


@query("silver_enroute_daily", sql=_ert("SELECT * FROM silver_enroute"))
def q_silver_enroute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_enroute_daily(flight_view(spark, sf_dir, "enroute_like"))


@query("silver_airport_atc_departure_daily", sql=_atc("SELECT * FROM silver_atc"))
def q_silver_atc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_airport_atc_departure_daily(flight_view(spark, sf_dir, "atc_like"))


@query("gold_airport_arrival_delay_reason", sql=_arr(_reason_union("silver_arrival", "*", _ARR_REASONS)))
def q_gold_arrival_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_airport_arrival_delay_reason(q_silver_arrival(spark, sf_dir))


@query("gold_enroute_delay_by_reason",
       sql=_ert(_reason_union("silver_enroute", "YEAR, MONTH_NUM, ENTITY_NAME", _ERT_REASONS)))
def q_gold_enroute_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_enroute_delay_by_reason(q_silver_enroute(spark, sf_dir))


@query("gold_airport_arrival_kpis_monthly", sql=_arr("""
SELECT YEAR, MONTH_NUM, apt_icao, APT_NAME, STATE_NAME,
       CAST(SUM(FLT_ARR_1) AS BIGINT) AS total_arrivals,
       CAST(SUM(FLT_ARR_1_DLY) AS BIGINT) AS delayed_arrivals,
       CAST(SUM(FLT_ARR_1_DLY_15) AS BIGINT) AS delays_over_15min
FROM silver_arrival GROUP BY YEAR, MONTH_NUM, apt_icao, APT_NAME, STATE_NAME"""))
def q_gold_arrival_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_airport_arrival_kpis_monthly(q_silver_arrival(spark, sf_dir))


@query("gold_airport_arrival_kpis_daily", sql=_arr("""
SELECT YEAR, MONTH_NUM, MONTH_MON, flt_date, apt_icao, APT_NAME, STATE_NAME,
       FLT_ARR_1 AS total_arrivals, FLT_ARR_1_DLY AS delayed_arrivals, FLT_ARR_1_DLY_15 AS delays_over_15min,
       CAST(FLT_ARR_1_DLY AS DOUBLE) / FLT_ARR_1 AS delay_rate
FROM silver_arrival WHERE FLT_ARR_1 > 0"""))
def q_gold_arrival_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_airport_arrival_kpis_daily(q_silver_arrival(spark, sf_dir))


@query("gold_enroute_kpis_daily", sql=_ert("""
SELECT YEAR, MONTH_NUM, MONTH_MON, flt_date, ENTITY_NAME, ENTITY_TYPE,
       FLT_ERT_1 AS total_flights, FLT_ERT_1_DLY AS delayed_flights, FLT_ERT_1_DLY_15 AS delays_over_15min,
       CAST(FLT_ERT_1_DLY AS DOUBLE) / FLT_ERT_1 AS delay_rate
FROM silver_enroute WHERE FLT_ERT_1 > 0"""))
def q_gold_enroute_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_enroute_kpis_daily(q_silver_enroute(spark, sf_dir))


@query("gold_enroute_kpis_monthly", sql=_ert("""
SELECT YEAR, MONTH_NUM, ENTITY_NAME, ENTITY_TYPE,
       CAST(SUM(FLT_ERT_1) AS BIGINT) AS total_flights,
       CAST(SUM(FLT_ERT_1_DLY) AS BIGINT) AS delayed_flights,
       CAST(SUM(FLT_ERT_1_DLY_15) AS BIGINT) AS delays_over_15min
FROM silver_enroute GROUP BY YEAR, MONTH_NUM, ENTITY_NAME, ENTITY_TYPE"""))
def q_gold_enroute_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_enroute_kpis_monthly(q_silver_enroute(spark, sf_dir))


@query("gold_airport_atc_departure_kpis_daily", sql=_atc("""
SELECT YEAR, MONTH_NUM, MONTH_MON, flt_date, apt_icao, APT_NAME, STATE_NAME,
       FLT_DEP_1 AS total_departures, flt_dep_ifr AS ifr_departures,
       dly_atc_pre_min AS atc_pre_delay_minutes, dly_atc_pre_min / FLT_DEP_1 AS avg_delay_min_per_flight
FROM silver_atc WHERE FLT_DEP_1 > 0"""))
def q_gold_atc_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_airport_atc_departure_kpis_daily(q_silver_atc(spark, sf_dir))


@query("gold_airport_atc_departure_kpis_monthly", sql=_atc("""
SELECT YEAR, MONTH_NUM, apt_icao, APT_NAME, STATE_NAME,
       CAST(SUM(FLT_DEP_1) AS BIGINT) AS total_departures,
       CAST(SUM(flt_dep_ifr) AS BIGINT) AS ifr_departures,
       SUM(dly_atc_pre_min) AS atc_pre_delay_minutes
FROM silver_atc GROUP BY YEAR, MONTH_NUM, apt_icao, APT_NAME, STATE_NAME"""))
def q_gold_atc_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_airport_atc_departure_kpis_monthly(q_silver_atc(spark, sf_dir))


@query("prefix_fill", sql=_arr("SELECT " + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in ["DLY_APT_ARR_1"] + _ARR_REASONS)
                               .replace("coalesce(DLY_APT_ARR_1, 0.0) AS DLY_APT_ARR_1",
                                        "apt_icao, flt_date, coalesce(DLY_APT_ARR_1, 0.0) AS DLY_APT_ARR_1")
                               + " FROM silver_arrival"))
def q_prefix_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = flight_view(spark, sf_dir, "arrival_like")
    return raw.select(F.upper("APT_ICAO").alias("apt_icao"), parse_date("FLT_DATE").alias("flt_date"),
                      *fill_prefixed(raw, "DLY_APT_ARR_", 0.0))
