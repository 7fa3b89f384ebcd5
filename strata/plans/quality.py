"""Reconciliation of table layers over the TPC-H tables.

The layer pairs are a fixture: each TPC-H table against itself (a clean
copy), plus seeded faults on ``orders`` -- rows missing from the target,
a changed value with equal counts, and extra rows in the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.quality import (data_freshness, fk_orphans, layer_checksum, layer_diff, pk_duplicates,
                                      quality_log, reconcile_counts)
from strata.plans.registry import query
from strata.tables import TPCH_TABLES, table

# Seeded faults (source predicate / target definition, shared text).
MISSING_PRED = "o_orderpriority <> '5-LOW'"
CHANGED_PRED = "o_orderstatus = 'P'"
_CHANGED_COLS = ("o_orderkey", "o_custkey", "o_orderstatus",
                 f"CASE WHEN {CHANGED_PRED} THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice",
                 "o_orderdate", "o_orderpriority")

# the same values, but in every hundredth row the NULL stands in the other column
_SHIFTED_A = ("o_orderkey", "o_custkey AS a", "CASE WHEN o_orderkey % 100 <> 0 THEN o_custkey END AS b")
_SHIFTED_B = ("o_orderkey", "CASE WHEN o_orderkey % 100 <> 0 THEN o_custkey END AS a", "o_custkey AS b")


def layer_pairs(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    pairs = {t: (table(spark, sf_dir, t), table(spark, sf_dir, t)) for t in TPCH_TABLES}
    orders = table(spark, sf_dir, "orders")
    pairs["orders_missing_rows"] = (orders, orders.filter(F.expr(MISSING_PRED)))
    pairs["orders_changed_value"] = (orders, orders.selectExpr(*_CHANGED_COLS))
    pairs["orders_extra_rows"] = (orders.filter(F.expr(MISSING_PRED)), orders)
    pairs["orders_shifted_nulls"] = (orders.selectExpr(*_SHIFTED_A), orders.selectExpr(*_SHIFTED_B))
    return pairs


def _pair_sql() -> list[tuple[str, str, str]]:
    out = [(t, t, t) for t in TPCH_TABLES]
    out.append(("orders_missing_rows", "orders", f"(SELECT * FROM orders WHERE {MISSING_PRED})"))
    out.append(("orders_changed_value", "orders", f"(SELECT {', '.join(_CHANGED_COLS)} FROM orders)"))
    out.append(("orders_extra_rows", f"(SELECT * FROM orders WHERE {MISSING_PRED})", "orders"))
    out.append(("orders_shifted_nulls", f"(SELECT {', '.join(_SHIFTED_A)} FROM orders)", f"(SELECT {', '.join(_SHIFTED_B)} FROM orders)"))
    return out


def _counts_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, (SELECT COUNT(*) FROM {s}) AS source_count, "
        f"(SELECT COUNT(*) FROM {t}) AS target_count" for n, s, t in _pair_sql())


def _diff_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, "
        f"(SELECT COUNT(*) FROM (SELECT * FROM {s} EXCEPT ALL SELECT * FROM {t}) x) AS missing_in_target, "
        f"(SELECT COUNT(*) FROM (SELECT * FROM {t} EXCEPT ALL SELECT * FROM {s}) y) AS extra_in_target"
        for n, s, t in _pair_sql())


@query("reconcile_counts", sql=f"""
SELECT table_name, source_count, target_count,
       CASE WHEN source_count = target_count THEN 'OK' ELSE 'MISMATCH' END AS row_count_status
FROM ({_counts_sql()}) c""")
def q_reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile_counts(layer_pairs(spark, sf_dir))


@query("layer_checksum", sql=f"""
SELECT table_name, missing_in_target = 0 AND extra_in_target = 0 AS checksum_match FROM ({_diff_sql()}) d""")
def q_layer_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer_checksum(layer_pairs(spark, sf_dir))


@query("layer_diff", sql=f"""
SELECT table_name, missing_in_target, extra_in_target,
       missing_in_target = 0 AND extra_in_target = 0 AS data_match FROM ({_diff_sql()}) d""")
def q_layer_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer_diff(layer_pairs(spark, sf_dir))


@query("quality_log", sql=f"""
SELECT c.table_name, 'bronze' AS source_layer, 'silver' AS target_layer, c.source_count, c.target_count,
       CASE WHEN c.source_count = c.target_count THEN 'OK' ELSE 'MISMATCH' END AS row_count_status,
       d.missing_in_target = 0 AND d.extra_in_target = 0 AS data_match
FROM ({_counts_sql()}) c JOIN ({_diff_sql()}) d ON c.table_name = d.table_name""")
def q_quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_log(layer_pairs(spark, sf_dir), with_load_time=False)


@query("data_freshness", sql="SELECT 'orders' AS table_name, MAX(o_orderdate) AS latest_date FROM orders")
def q_data_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_freshness(table(spark, sf_dir, "orders"), "o_orderdate", "orders", with_check_time=False)


# Primary keys declared by the silver DDL (tables present here).
PRIMARY_KEYS = {
    "lineitem": ["l_orderkey", "l_linenumber"],
    "orders": ["o_orderkey"],
    "customer": ["c_custkey"],
    "part": ["p_partkey"],
    "supplier": ["s_suppkey"],
    "nation": ["n_nationkey"],
    "region": ["r_regionkey"],
}

# Foreign keys declared by the silver DDL (tables present here).
FOREIGN_KEYS = [
    ("lineitem", ["l_orderkey"], "orders", ["o_orderkey"]),
    ("lineitem", ["l_partkey"], "part", ["p_partkey"]),
    ("lineitem", ["l_suppkey"], "supplier", ["s_suppkey"]),
    ("orders", ["o_custkey"], "customer", ["c_custkey"]),
    ("customer", ["c_nationkey"], "nation", ["n_nationkey"]),
    ("supplier", ["s_nationkey"], "nation", ["n_nationkey"]),
    ("nation", ["n_regionkey"], "region", ["r_regionkey"]),
]


def _pk_query(t: str, key: list[str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return pk_duplicates(table(spark, sf_dir, t), key)
    k = ", ".join(key)
    nulls = " OR ".join(f"{c} IS NULL" for c in key)
    sql = f"SELECT {k}, COUNT(*) AS n_rows FROM {t} GROUP BY {k} HAVING COUNT(*) > 1 OR {nulls}"
    query(f"pk_duplicates_{t}", sql=sql)(run)


def _fk_query(child: str, ck: list[str], parent: str, pk: list[str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fk_orphans(table(spark, sf_dir, child), table(spark, sf_dir, parent), ck, pk)
    k = ", ".join(ck)
    cond = " AND ".join(f"p.{p} = c.{c}" for c, p in zip(ck, pk))
    sql = (f"SELECT {k}, COUNT(*) AS n_rows FROM {child} c WHERE "
           + " AND ".join(f"{c} IS NOT NULL" for c in ck)
           + f" AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {cond}) GROUP BY {k}")
    query(f"fk_orphans_{child}_{parent}", sql=sql)(run)


for _t, _k in PRIMARY_KEYS.items():
    _pk_query(_t, _k)
for _c, _ck, _p, _pk in FOREIGN_KEYS:
    _fk_query(_c, _ck, _p, _pk)


@query("fk_orphans_orders_customer_seeded", sql="""
SELECT o_custkey, COUNT(*) AS n_rows FROM orders o
WHERE o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_mktsegment <> 'BUILDING')
GROUP BY o_custkey""")
def q_fk_orphans_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded fault: the parent layer lost one market segment."""
    parent = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    return fk_orphans(table(spark, sf_dir, "orders"), parent, ["o_custkey"], ["c_custkey"])
