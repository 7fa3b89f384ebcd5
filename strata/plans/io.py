"""Source and sink round trips over the driver tables: CSV export/import
under a contract, yearly multi-file loads, layer copies reconciled, schema
evolution on append, and exactly-once streaming ingest.

Written intermediates go to fresh paths under the cluster's shared
checkpoint directory (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from strata.operators.quality import append_quality_log, quality_log, read_quality_log
from strata.plans.registry import query
from strata.session import scratch_path
from strata.sources import schemas, sinks
from strata.sources.contracts import conform, load_contract, save_contract, with_metadata_fields
from strata.plans.flights import _arr as flights_sql_arrival, silver_airport_arrival_daily
from strata.plans.testviews import flight_view, with_views
from strata.sources.csv import read_csv, read_yearly_csv
from strata.sources.geojson import read_geojson_collection, read_geojson_features
from strata.streaming.ingest import csv_stream, ingest_available
from strata.tables import TPCH_TABLES, footer_stats, table


@query("csv_roundtrip", sql="SELECT * FROM orders")
def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> gzip CSV files (written by the executors) -> read back under
    the orders contract."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-csv")
    orders.write.option("header", True).option("compression", "gzip").csv(path)
    return read_csv(spark, path, contract=orders.schema)


@query("yearly_csv_load", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate,
       CAST(year(l_shipdate) AS INTEGER) AS source_year, 'lineitem' AS dataset_group
FROM lineitem""")
def q_yearly_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem split into one bz2 CSV folder per ship year, then all years
    loaded in one read and stamped with the year of their file path."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    path = scratch_path(spark, "lineitem-yearly")
    # every task writes its own rows' years: no shuffle, however many rows a year has
    (li.withColumn("ship_year", F.year("l_shipdate")).write.partitionBy("ship_year")
       .option("header", True).option("compression", "bzip2").csv(path))
    return read_yearly_csv(spark, [f"{path}/ship_year=*/*.csv.bz2"], contract=li.schema,
                           dataset_group="lineitem", pattern=r"ship_year=([0-9]{4})", source="file_path")


@query("yearly_csv_evolving", sql="""
SELECT l_orderkey, l_linenumber, CASE WHEN year(l_shipdate) <> 1994 THEN l_quantity END AS l_quantity,
       CASE WHEN year(l_shipdate) >= 1995 THEN l_returnflag END AS l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS source_year
FROM lineitem""")
def q_yearly_csv_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years whose files order their columns differently, lack one or have one
    more, in one load: every file is read under its own header."""
    li = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    contract = li.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag").schema
    path = scratch_path(spark, "lineitem-evolving")
    shapes = [("<= 1993", ["l_orderkey", "l_linenumber", "l_quantity"]), ("= 1994", ["l_linenumber", "l_orderkey"]),
              ("= 1995", ["l_quantity", "l_returnflag", "l_linenumber", "l_orderkey"]),
              (">= 1996", ["l_linenumber", "l_comment_size", "l_orderkey", "l_returnflag", "l_quantity"])]
    for n, (years, cols) in enumerate(shapes):
        part = li.where(f"year {years}").withColumn("l_comment_size", F.col("l_linenumber") * 1000).select(*cols, F.col("year").alias("ship_year"))
        part.write.partitionBy("ship_year").option("header", True).csv(f"{path}/{n}")
    return read_yearly_csv(spark, [f"{path}/*/ship_year=*/*.csv"], contract=contract, pattern=r"ship_year=([0-9]{4})", source="file_path")


@query("ctas_copy", sql=f"""
SELECT c.table_name, 'bronze' AS source_layer, 'silver' AS target_layer, c.source_count, c.target_count,
       CASE WHEN c.source_count = c.target_count THEN 'OK' ELSE 'MISMATCH' END AS row_count_status,
       true AS data_match
FROM ({" UNION ALL ".join(f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {t}) AS source_count, "
                          f"(SELECT COUNT(*) FROM {t}) AS target_count" for t in TPCH_TABLES)}) c""")
def q_ctas_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy the TPC-H tables into a new layer (CTAS, error if present), then
    reconcile source and copy in one plan."""
    root = scratch_path(spark, "silver")
    pairs = {}
    for t in TPCH_TABLES:
        src = table(spark, sf_dir, t)
        sinks.ctas(src, f"{root}/{t}", if_exists="error")
        pairs[t] = (src, spark.read.parquet(f"{root}/{t}"))
    return quality_log(pairs, with_load_time=False)


@query("append_merge_schema", sql="""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def q_append_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended batches with different columns, read as one table."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-evolving")
    sinks.append(orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice"), path)
    sinks.append(orders.filter(F.col("o_orderstatus") != "F").select("o_orderkey", "o_custkey", "o_orderpriority"),
                 path)
    return sinks.read_merged(spark, path).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query("stream_ingest", sql="SELECT * FROM orders")
def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders dropped as CSV files and ingested by a checkpointed file stream; run twice -- the second run adds nothing."""
    orders = table(spark, sf_dir, "orders")
    landing = scratch_path(spark, "landing")
    orders.write.option("header", True).csv(landing)
    target, ckpt = scratch_path(spark, "raw-orders"), scratch_path(spark, "raw-orders-ckpt")
    for _ in range(2):
        ingest_available(csv_stream(spark, landing, orders.schema), target, ckpt)
    return spark.read.schema(orders.schema).parquet(target)


@query("conform_arrival_contract", sql=with_views(
    "SELECT " + ", ".join(
        f"TRY_CAST(CAST({f.name} AS VARCHAR) AS {'INTEGER' if f.dataType.simpleString() == 'int' else 'DOUBLE' if f.dataType.simpleString() == 'double' else 'VARCHAR'}) AS {f.name}"
        for f in schemas.contract("apt_dly").fields)
    + ", CAST(NULL AS INTEGER) AS source_year, "
      "CAST(NULL AS VARCHAR) AS dataset_group FROM arrival_like", "arrival_like"))
def q_conform_arrival_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrival file as text (every field a string, as read from CSV)
    conformed to the raw arrival contract: types restored by ``try_cast``,
    metadata fields present (NULL until stamped)."""
    raw = flight_view(spark, sf_dir, "arrival_like")
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    # the load timestamp is left out of the compared output (time-dependent type/value)
    return conform(text, schemas.raw_contract("apt_dly")).drop("processing_datetime")


@query("stream_silver_arrival", sql=flights_sql_arrival("SELECT * FROM silver_arrival"))
def q_stream_silver_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrival files land as CSV text; a checkpointed stream conforms
    them to the arrival contract and applies the (stateless) silver
    transformation on the way into the silver table -- the same function as
    the batch silver dataset, run incrementally and exactly once."""
    raw = flight_view(spark, sf_dir, "arrival_like")
    landing = scratch_path(spark, "landing-apt-dly")
    raw.write.option("header", True).csv(landing)
    target, ckpt = scratch_path(spark, "silver-apt-dly"), scratch_path(spark, "silver-apt-dly-ckpt")
    stream = csv_stream(spark, landing, schemas.contract("apt_dly"))
    ingest_available(silver_airport_arrival_daily(stream), target, ckpt)
    return spark.read.parquet(target)


def _fresh_table(spark: SparkSession, name: str) -> str:
    """An unused catalog name; the table's files go to the shared warehouse."""
    return f"{name}_{uuid.uuid4().hex[:10]}"


@query("overwrite_batch_table", sql="""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders""")
def q_overwrite_batch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table loaded a batch (status) at a time, one batch run twice
    with changed prices: its partition is replaced, the others stay."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_totalprice", "o_orderkey")
    name = _fresh_table(spark, "orders_by_status")
    for status in ("F", "O", "P"):
        sinks.overwrite_batch(orders.where(F.col("o_orderstatus") == status), name, ["o_orderstatus"])
    again = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    sinks.overwrite_batch(again, name, ["o_orderstatus"])
    return spark.table(name).select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("insert_into_positional", sql="SELECT o_orderkey AS order_key, o_custkey AS customer FROM orders")
def q_insert_into_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders into an empty table made from a contract: urgent and high ones, and those without priority, by
    INSERT INTO ... SELECT by position (other names), the rest appended by name (other order)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    first = F.coalesce(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(True))
    target = orders.where(~first).select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer"))
    name = _fresh_table(spark, "order_customers")
    for _ in range(2):                                 # the second time it is there already
        sinks.create_if_absent(spark, name, target.schema)
    sinks.insert_into(orders.where(first).drop("o_orderpriority"), name)
    sinks.append(target.select("customer", "order_key"), name)
    return spark.table(name)


@query("create_or_replace_as", sql="SELECT n_nationkey, upper(n_name) AS n_name FROM nation")
def q_create_or_replace_as(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by another query, then left alone by one that ignores
    an existing table, then overwritten."""
    nation = table(spark, sf_dir, "nation")
    name = _fresh_table(spark, "nations")
    sinks.ctas(nation.select("n_name"), name)
    sinks.ctas(nation.select("n_nationkey", "n_name"), name, if_exists="replace")
    sinks.ctas(nation.limit(0), name, if_exists="ignore")
    sinks.overwrite(nation.select("n_nationkey", F.upper("n_name").alias("n_name")), name)
    return spark.table(name)


@query("contract_roundtrip", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(NULL AS INTEGER) AS source_year, CAST(NULL AS VARCHAR) AS area FROM orders""")
def q_contract_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract saved and loaded through Spark's file system, with metadata
    fields added, and orders as text conformed to it."""
    orders = table(spark, sf_dir, "orders")
    path = f"{scratch_path(spark, 'contract')}/orders_schema.json"
    save_contract(spark, orders.schema, path)
    contract = with_metadata_fields(load_contract(spark, path), [("source_year", IntegerType()), ("area", StringType())])
    return conform(orders.select(*[F.col(c).cast("string").alias(c) for c in reversed(orders.columns)]), contract)


@query("quality_log_newest_first", sql="""
SELECT run, 'orders' AS table_name, (SELECT COUNT(*) FROM orders) AS source_count,
       (SELECT COUNT(*) FROM orders WHERE run = 2 OR o_orderstatus <> 'P') AS target_count FROM (VALUES (1), (2)) r(run)""")
def q_quality_log_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs appended to the monitoring table, read newest first and
    numbered in that order from the back."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "quality-log")
    for target in (orders.where("o_orderstatus <> 'P'"), orders):
        append_quality_log(quality_log({"orders": (orders, target)}), path)
    log = read_quality_log(spark, path)
    run = F.row_number().over(Window.orderBy("load_time")).alias("run")    # one row per run
    return log.select(run, "table_name", "source_count", "target_count").orderBy(F.desc("run"))


@query("geojson_features", sql="SELECT n_name AS neighbourhood, 'Point' AS geometry_type, n_regionkey FROM nation")
def q_geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GeoJSON feature collection per region, written by Spark, read as
    one row per feature."""
    nation = table(spark, sf_dir, "nation")
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("n_name").alias("neighbourhood"), "n_regionkey").alias("properties"),
                       F.struct(F.lit("Point").alias("type"), F.array(F.col("n_nationkey").cast("double"), F.lit(0.5)).alias("coordinates")).alias("geometry"))
    docs = nation.groupBy("n_regionkey").agg(F.collect_list(feature).alias("features")).select(F.lit("FeatureCollection").alias("type"), "features")
    path = scratch_path(spark, "geojson")
    docs.select(F.to_json(F.struct("type", "features")).alias("value")).repartition(5).write.text(path)
    return read_geojson_features(spark, path, multi_line=False).select("neighbourhood", "geometry_type", "n_regionkey")


@query("geojson_collection", sql="""
SELECT c_name AS label, 'Point' AS geometry_type, c_custkey FROM customer""")
def q_geojson_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as one GeoJSON collection in a single file, read by as many tasks as it has splits."""
    customer = table(spark, sf_dir, "customer")
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("c_name").alias("label"), "c_custkey").alias("properties"),
                       F.struct(F.lit("Point").alias("type"), F.array(F.col("c_nationkey").cast("double"), F.lit(0.5)).alias("coordinates")).alias("geometry"))
    rows = customer.select(F.col("c_custkey").alias("at"), F.concat(F.to_json(feature), F.lit(",")).alias("value"))
    ends = spark.createDataFrame([(-2, '{"type": "FeatureCollection", "features": ['), (2 ** 62, '{"type": "Feature", "properties": {}, "geometry": null}\n]}')],
                                 "at long, value string")
    path = scratch_path(spark, "geojson-one")
    rows.unionByName(ends).coalesce(1).sortWithinPartitions("at").select("value").write.text(path)
    return read_geojson_collection(spark, path).where("c_custkey IS NOT NULL").select("label", "geometry_type", "c_custkey")


@query("footer_stats", sql="""
SELECT COUNT(*) AS n_rows, MIN(o_orderkey) AS first_key, MAX(o_orderkey) AS last_key, MAX(o_custkey) AS last_customer FROM orders""")
def q_footer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and key range of orders from the files' footers."""
    return footer_stats(spark, f"{sf_dir.rstrip('/')}/orders.parquet", n_rows=("count", "*"), first_key=("min", "o_orderkey"),
                        last_key=("max", "o_orderkey"), last_customer=("max", "o_custkey"))


@query("clustered_copy", sql="SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey BETWEEN 101 AND 140")
def q_clustered_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written in ranges of their customer; a filter on customers reads the files that hold them."""
    path = scratch_path(spark, "orders-by-customer")
    sinks.ctas(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), path, cluster_by=["o_custkey", "o_orderkey"])
    return sinks.read_table(spark, path).where("o_custkey BETWEEN 101 AND 140")
