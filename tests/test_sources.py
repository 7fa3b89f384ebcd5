import bz2
import gzip
import json
import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from strata.sources import sinks
from strata.sources.contracts import conform, load_contract, save_contract, with_metadata_fields
from strata.sources.csv import read_csv, read_yearly_csv
from strata.sources.geojson import read_geojson_features
from strata.streaming.ingest import csv_stream, ingest_available

CSV_TEXT = ('idx,name,price,note\n'
            '0,"Flat, central",$1.00,plain\n'
            '1,"Two\nlines",$2.50,"say ""hi"""\n'
            '2,,NA,\n')
CONTRACT = StructType([StructField("name", StringType()), StructField("price", StringType()),
                       StructField("note", StringType())])


def _write(path, text, opener=open):
    with opener(path, "wt") as f:
        f.write(text)
    return path


def test_csv_quoting_multiline_and_codecs(spark, tmp_dir):
    plain = _write(os.path.join(tmp_dir, "a.csv"), CSV_TEXT)
    gz = _write(os.path.join(tmp_dir, "b.csv.gz"), CSV_TEXT, gzip.open)
    bz = _write(os.path.join(tmp_dir, "c.csv.bz2"), CSV_TEXT, bz2.open)
    for p in (plain, gz, bz):
        rows = read_csv(spark, p, CONTRACT, drop_first=True).collect()
        assert [r.name for r in rows] == ["Flat, central", "Two\nlines", None]
        assert rows[1].note == 'say "hi"' and rows[2].price == "NA"
    both = read_csv(spark, [plain, gz], CONTRACT, drop_first=True)
    assert both.count() == 6
    keep_id = read_csv(spark, plain)
    assert keep_id.columns[0] == "idx"


def test_contract_roundtrip_and_metadata_fields(spark, tmp_dir):
    path = os.path.join(tmp_dir, "c.json")
    save_contract(spark, CONTRACT, path)
    assert load_contract(spark, path) == CONTRACT
    extended = with_metadata_fields(CONTRACT, [("processing_datetime", TimestampType()), ("area", StringType())])
    assert len(extended.fields) == 5 and len(CONTRACT.fields) == 3   # input not mutated


def test_conform_casts_orders_and_fills(spark):
    df = spark.createDataFrame([("1", "x", "junk")], "A string, extra string, b string")
    schema = StructType([StructField("b", DoubleType()), StructField("a", IntegerType()),
                         StructField("c", LongType())])
    r = conform(df, schema).first()
    assert list(r.asDict().items()) == [("b", None), ("a", 1), ("c", None)]


def test_yearly_files_one_read(spark, tmp_dir):
    for y in (2014, 2015):
        _write(os.path.join(tmp_dir, f"apt_dly_{y}.csv.bz2"), f"YEAR,N\n{y},1\n{y},2\n", bz2.open)
    contract = StructType([StructField("YEAR", IntegerType()), StructField("N", IntegerType())])
    df = read_yearly_csv(spark, [os.path.join(tmp_dir, "apt_dly_*.csv.bz2")], contract, dataset_group="apt_dly")
    got = sorted((r.YEAR, r.source_year, r.dataset_group) for r in df.collect())
    assert got == [(2014, 2014, "apt_dly")] * 2 + [(2015, 2015, "apt_dly")] * 2


def test_geojson_features(spark, tmp_dir):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"neighbourhood": "A"},
         "geometry": {"type": "Point", "coordinates": [23.7, 37.9]}},
        {"type": "Feature", "properties": {"neighbourhood": "B"},
         "geometry": {"type": "Point", "coordinates": [23.8, 37.8]}}]}
    path = os.path.join(tmp_dir, "n.geojson")
    with open(path, "w") as f:
        json.dump(doc, f, indent=1)
    rows = read_geojson_features(spark, path).orderBy("neighbourhood").collect()
    assert [(r.neighbourhood, r.geometry_type) for r in rows] == [("A", "Point"), ("B", "Point")]


def test_write_modes_and_idempotent_batches(spark, tmp_dir):
    target = os.path.join(tmp_dir, "raw")
    schema = StructType([StructField("k", IntegerType()), StructField("area", StringType())])
    sinks.create_if_absent(spark, target, schema, partition_by=["area"])
    sinks.create_if_absent(spark, target, schema, partition_by=["area"])
    assert sinks.read_table(spark, target, schema=schema).count() == 0
    sinks.create_if_absent(spark, "contract_table", schema, partition_by=["area"])
    sinks.create_if_absent(spark, "contract_table", schema, partition_by=["area"])
    assert spark.table("contract_table").columns == ["k", "area"]
    batch = spark.createDataFrame([(1, "London"), (2, "London")], schema)
    other = spark.createDataFrame([(3, "Tokyo")], schema)
    for _ in range(2):   # a re-run must not double the rows
        sinks.overwrite_batch(batch, target, ["area"])
    sinks.overwrite_batch(other, target, ["area"])
    assert spark.read.parquet(target).count() == 3
    copy = os.path.join(tmp_dir, "copy")
    sinks.ctas(batch, copy)
    sinks.ctas(other, copy, if_exists="ignore")
    assert spark.read.parquet(copy).count() == 2
    try:
        sinks.ctas(other, copy)
        raise AssertionError("expected an error")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e).lower() or "path" in str(e).lower()
    sinks.ctas(other, copy, if_exists="replace")
    assert spark.read.parquet(copy).count() == 1


def test_append_merge_schema(spark, tmp_dir):
    target = os.path.join(tmp_dir, "evolve")
    sinks.append(spark.createDataFrame([(1, 1.0)], "k int, a double"), target)
    sinks.append(spark.createDataFrame([(2, "x")], "k int, b string"), target)
    df = sinks.read_merged(spark, target)
    assert set(df.columns) == {"k", "a", "b"}
    got = sorted((r.k, r.a, r.b) for r in df.collect())
    assert got == [(1, 1.0, None), (2, None, "x")]


def test_insert_into_positional(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS ins_target (a INT, b STRING) USING parquet")
    sinks.insert_into(spark.createDataFrame([(1, "x")], "p int, q string"), "ins_target")
    sinks.append(spark.createDataFrame([("y", 2)], "b string, a int"), "ins_target")   # by name
    assert sorted(tuple(r) for r in spark.table("ins_target").collect()) == [(1, "x"), (2, "y")]


def test_stream_ingest_exactly_once(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    _write(os.path.join(landing, "f2019.csv"), "k,v\n1,a\n2,b\n")
    contract = StructType([StructField("k", IntegerType()), StructField("v", StringType())])
    target, ckpt = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "ck")
    assert ingest_available(csv_stream(spark, landing, contract, stamp_year=True), target, ckpt) >= 0
    ingest_available(csv_stream(spark, landing, contract, stamp_year=True), target, ckpt)
    assert spark.read.parquet(target).count() == 2
    _write(os.path.join(landing, "f2020.csv"), "k,v\n3,c\n")
    ingest_available(csv_stream(spark, landing, contract, stamp_year=True), target, ckpt)
    got = sorted((r.k, r.source_year) for r in spark.read.parquet(target).collect())
    assert got == [(1, 2019), (2, 2019), (3, 2020)]


def test_reference_contracts(spark, tmp_dir):
    from strata.sources import schemas
    assert len(schemas.contract("apt_dly").fields) == 27
    assert len(schemas.contract("atc_pre_dep").fields) == 12
    assert len(schemas.contract("ert_dly").fields) == 26
    assert len(schemas.contract("listing").fields) == 74
    assert len(schemas.contract("listing_two_city").fields) == 78
    assert len(schemas.contract("calendar").fields) == 6
    assert len(schemas.contract("agg_listing").fields) == 17
    raw = schemas.raw_contract("apt_dly")
    assert raw.fieldNames()[-3:] == ["processing_datetime", "source_year", "dataset_group"]
    paths = schemas.save_all(spark, tmp_dir)
    assert load_contract(spark, paths[0]) == schemas.contract("apt_dly")


def test_drop_tables_by_prefix(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS layers_t")
    for name in ("silver_a", "gold_b", "raw_c"):
        spark.sql(f"CREATE TABLE IF NOT EXISTS layers_t.{name} (x INT) USING parquet")
    dropped = sinks.drop_tables(spark, "layers_t", ("silver_", "gold_"))
    assert sorted(dropped) == ["gold_b", "silver_a"]
    assert [t.name for t in spark.catalog.listTables("layers_t")] == ["raw_c"]


def test_names_like_schemes_are_tables(spark, tmp_dir):
    from strata.sources.files import is_path
    assert not is_path("s3_orders") and not is_path("gsx") and not is_path("db.abfs_t")
    assert is_path("dbfs:/x") and is_path("wasbs://c@a/x") and is_path("/x") and is_path("file:/x")
    sinks.overwrite(spark.range(3), "s3_orders")
    assert spark.table("s3_orders").count() == 3 and not os.path.exists("s3_orders")
    spark.sql("DROP TABLE s3_orders")


def test_overwrite_batch_keeps_other_partitions(spark):
    for area, n in (("L", 2), ("T", 3), ("L", 5)):
        sinks.overwrite_batch(spark.range(n).selectExpr(f"'{area}' AS area", "id"), "batch_t", ["area"])
    got = {r.area: r["count"] for r in spark.table("batch_t").groupBy("area").count().collect()}
    assert got == {"L": 5, "T": 3}
    spark.sql("DROP TABLE batch_t")


def test_columns_are_matched_by_each_files_header(spark, tmp_dir):
    from strata.sources.csv import read_csv, read_yearly_csv
    _write(os.path.join(tmp_dir, "f2019.csv"), "YEAR,N,M\n2019,1,7\n")
    _write(os.path.join(tmp_dir, "f2020.csv"), "YEAR,M,N\n2020,7,1\n")
    _write(os.path.join(tmp_dir, "f2021.csv"), "\ufeffN,\"X, y\"\n1,2\n")
    _write(os.path.join(tmp_dir, "f2022.csv"), "")
    contract = StructType([StructField("N", IntegerType()), StructField("M", IntegerType())])
    got = sorted(tuple(r) for r in read_yearly_csv(spark, [os.path.join(tmp_dir, "f*.csv")], contract=contract).collect() if r.M)
    assert got == [(1, 7, 2019), (1, 7, 2020)]
    raw = read_csv(spark, tmp_dir)
    assert set(raw.columns) == {"YEAR", "N", "M", "X, y"} and raw.count() == 3


def test_stream_reads_by_header(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    _write(os.path.join(landing, "a.csv"), "id,name,price\n9,x,5\n")
    contract = StructType([StructField("name", StringType()), StructField("price", IntegerType())])
    target, ckpt = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "ck")
    ingest_available(csv_stream(spark, landing, contract), target, ckpt)
    assert [tuple(r) for r in spark.read.parquet(target).collect()] == [("x", 5)]
    _write(os.path.join(landing, "b.csv"), "name,id,price\nz,9,5\n")
    with pytest.raises(ValueError):
        csv_stream(spark, landing, contract)


def test_nan_text_is_missing(spark):
    df = spark.createDataFrame([("NaN",), ("1.5",), ("x",)], "v string")
    assert [r.v for r in conform(df, StructType([StructField("v", DoubleType())])).collect()] == [None, 1.5, None]


def test_required_columns_must_be_there(spark):
    from strata.plans.listings import cleanse_combined_listings
    df = spark.createDataFrame([("$1", 1)], "price string, id int")
    with pytest.raises(ValueError):
        cleanse_combined_listings([df])
    assert cleanse_combined_listings([df], required=["id"]).count() == 1


def test_layers_follow_their_plan_and_inputs(spark, tmp_dir):
    from strata.sources.layers import drop_layers, materialized
    src = os.path.join(tmp_dir, "in")
    spark.range(3).write.parquet(src)
    build = lambda: spark.read.parquet(src).selectExpr("id * 2 AS x")
    first = materialized(spark, "kk", build)
    assert first.count() == 3 and materialized(spark, "kk", build).inputFiles() == first.inputFiles()
    assert materialized(spark, "kk", lambda: spark.range(9)).count() == 9
    spark.range(3).write.mode("append").parquet(src)
    assert materialized(spark, "kk", build).count() == 6
    assert drop_layers(spark) >= 3
    assert materialized(spark, "kk", build).count() == 6


def test_no_private_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace
    from strata.session import checkpoint_dir
    conf = SimpleNamespace(get=lambda k, d=None: None, set=lambda k, v: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://m:7077")
    with pytest.raises(ValueError):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_headers_in_one_job(spark, tmp_dir):
    """Plain and compressed files, empty ones, odd names: the headers come from the executors."""
    import bz2
    import gzip
    import os
    from strata.sources.csv import headers, read_csv
    where = os.path.join(tmp_dir, "landing files")
    os.makedirs(where)
    body = "\n".join(f"{i},x{i}" for i in range(3000)) + "\n"
    for name, opened, head in (("a 1.csv", open, "id,v"), ("b%20.csv.bz2", bz2.open, "id,v"), ("c.csv.gz", gzip.open, "id,v")):
        with opened(os.path.join(where, name), "wt") as f:
            f.write(f"{head}\n{body}")
    open(os.path.join(where, "empty.csv"), "w").close()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert headers(spark, where) == {("id", "v"): where}
    assert read_csv(spark, where, multi_line=False).count() == 9000
    with open(os.path.join(where, "d.csv"), "w") as f:
        f.write("\ufeffv,extra,id\ny,1,7\n")
    found = headers(spark, where)
    assert sorted(found) == [("id", "v"), ("v", "extra", "id")] and [len(found[k]) for k in sorted(found)] == [3, 1]
    got = read_csv(spark, where, multi_line=False)
    assert got.count() == 9001 and got.where("extra = 1").select("id", "v").first() == ("7", "y")
    assert headers(spark, where, modified_after="2999-01-01T00:00:00") == {}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_a_failed_replacement_leaves_the_old_rows(spark, tmp_dir):
    import pytest
    from pyspark.sql import functions as F
    from strata.sources import sinks
    fails = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id").cast("string")).alias("v"))
    for target in (f"{tmp_dir}/replaced", "replaced_t"):
        sinks.overwrite(spark.range(3).select(F.col("id").cast("string").alias("v")), target)
        for call in (lambda t: sinks.overwrite(fails, t), lambda t: sinks.ctas(fails, t, if_exists="replace")):
            with pytest.raises(Exception, match="no"):
                call(target)
            assert sorted(r.v for r in sinks.read_table(spark, target).collect()) == ["0", "1", "2"]
        # a plan may read the table that it replaces
        sinks.overwrite(sinks.read_table(spark, target).where("v <> '1'"), target)
        assert sorted(r.v for r in sinks.read_table(spark, target).collect()) == ["0", "2"]
        sinks.ctas(spark.range(1).select(F.lit("z").alias("other")), target, if_exists="replace")
        assert [tuple(r) for r in sinks.read_table(spark, target).collect()] == [("z",)]
    import os
    assert sorted(os.listdir(tmp_dir)) == ["replaced"]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("replaced_t")] == ["replaced_t"]


def test_a_file_overwritten_in_place_makes_another_layer(spark, tmp_dir):
    import os
    import time
    from strata.sources.layers import materialized
    path = f"{tmp_dir}/in"
    build = lambda: spark.read.schema("v string").text(path)
    os.makedirs(path)
    for text in ("one", "two!", "six"):
        time.sleep(0.02)
        with open(f"{path}/a.txt", "w") as f:
            f.write(text)
        assert [r.v for r in materialized(spark, "in-place", build).collect()] == [text]
