from __future__ import annotations

import glob
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tallyshelf.plans.dimensions import append_products, append_stores, load_stores
from tallyshelf.schemas import PRODUCTS_SCHEMA, STORES_SCHEMA
from tallyshelf.session import (
    CHECKPOINT_SETTING,
    INITIAL_TASKS_SETTING,
    get_spark_session,
    planned_bytes,
    s3a_options,
    scratch_root,
)
from tallyshelf.sinks.csv_files import export_csv
from tallyshelf.sinks.tables import append_table, ensure_table, save_table


@pytest.fixture
def table(spark, request):
    name = f"t_{abs(hash(request.node.name))}"
    spark.sql(f"drop table if exists {name}")
    return name


def test_saving_replaces_the_table(spark, table):
    save_table(spark.range(5), table)
    assert save_table(spark.range(2), table).count() == 2


def test_partitioned_table(spark, table):
    df = spark.range(100, numPartitions=8).select("id", (F.col("id") % 3).alias("p"))
    saved = save_table(df, table, partition_by=["p"])
    assert saved.filter("p = 1").count() == 33
    assert len(saved.filter("p = 1").inputFiles()) == 1


def test_append_goes_by_name_and_repeats(spark, table):
    ensure_table(spark, table, PRODUCTS_SCHEMA)
    ensure_table(spark, table, PRODUCTS_SCHEMA)
    df = spark.createDataFrame([("k", "a, b", "c", "s", "b", 1.0)], PRODUCTS_SCHEMA)
    append_table(df.select(*reversed(df.columns)), table)
    append_table(df, table)
    assert [tuple(r) for r in spark.table(table).collect()] == [("k", "a, b", "c", "s", "b", 1.0)] * 2


def test_store_load_drops_duplicates_of_one_fetch_only(spark, table):
    twice = ("s1", "c", "t, u", "w", 1.0, float("nan"))
    rows = [twice, twice, ("s2", None, None, None, None, None)]
    df = spark.createDataFrame(rows, STORES_SCHEMA)
    report = append_stores(spark, df, table)
    assert (report.read, report.appended, report.duplicates) == (3, 2, 1)
    append_stores(spark, df, table)
    assert spark.table(table).count() == 4
    assert spark.table(table).filter("longitude is null").count() == 4


def test_an_empty_fetch_makes_no_table(spark, table):
    report = append_stores(spark, spark.createDataFrame([], STORES_SCHEMA), table)
    assert (report.read, report.appended) == (0, 0) and not spark.catalog.tableExists(table)


def test_store_load_from_csv(spark, table, tmp_path):
    (tmp_path / "s.csv").write_text("store_id,country,city,channel,latitude,longitude\ns1,c,t,w,1,2\ns1,c,t,w,1,2\n")
    assert load_stores(spark, f"{tmp_path}/s.csv", table).duplicates == 1
    assert spark.table(table).first() == ("s1", "c", "t", "w", 1.0, 2.0)


def test_product_load_keeps_duplicates(spark, table):
    rows = [("k", "n", "c", "s", "b", float("nan"))] * 2
    df = spark.createDataFrame(rows, PRODUCTS_SCHEMA)
    append_products(spark, df.toDF(*[c.upper() for c in df.columns]), table)
    assert [tuple(r) for r in spark.table(table).collect()] == [("k", "n", "c", "s", "b", None)] * 2


def parts(path):
    return glob.glob(f"{path}/part-*.csv")


def test_exports_are_one_headered_file_per_task(spark, tmp_path):
    df = spark.range(10, numPartitions=4)
    assert export_csv(df, f"{tmp_path}/e") == 10 and len(parts(f"{tmp_path}/e")) == 4
    assert export_csv(df, f"{tmp_path}/e") == 10 and len(parts(f"{tmp_path}/e")) == 4
    assert all(open(p).readline() == "id\n" for p in parts(f"{tmp_path}/e"))
    assert export_csv(df.limit(0), f"{tmp_path}/e") == 0


def test_csv_text(spark, tmp_path):
    rows = [(1, 'say "hi", you'), (2, "back\\slash"), (3, ""), (4, None)]
    df = spark.createDataFrame(rows, "n int, t string")
    export_csv(df, f"{tmp_path}/e")
    lines = [line for part in parts(f"{tmp_path}/e") for line in open(part).read().splitlines()[1:]]
    # Empty text and null differ in the file, though a reader takes both for null unless told otherwise.
    assert sorted(lines)[2:] == ['3,""', "4,"]
    back = spark.read.option("header", True).schema(df.schema).csv(f"{tmp_path}/e")
    assert sorted(map(tuple, back.filter("n < 3").collect())) == rows[:2]


def test_csv_may_be_compressed(spark, tmp_path):
    df = spark.range(5000, numPartitions=2).selectExpr("id", "'a long label that every row has' as label")
    assert export_csv(df, f"{tmp_path}/e", compression="gzip") == 5000
    written = glob.glob(f"{tmp_path}/e/part-*")
    assert len(written) == 2 and all(name.endswith(".csv.gz") for name in written)
    back = spark.read.option("header", True).schema(df.schema).csv(f"{tmp_path}/e")
    assert back.exceptAll(df).count() == 0 and back.count() == 5000


def test_s3a_options():
    # Standard variables, temporary credentials included, are the default providers' business.
    assert s3a_options({"AWS_ACCESS_KEY_ID": "a", "AWS_SECRET_ACCESS_KEY": "b", "AWS_SESSION_TOKEN": "c"}) == {}
    assert s3a_options({"AWS_ACCESS_KEY": "a"}) == {}
    assert s3a_options({"AWS_ACCESS_KEY": "a", "AWS_SECRET_KEY": "b", "AWS_REGION": "eu-west-1"}) == {
        "spark.hadoop.fs.s3a.access.key": "a",
        "spark.hadoop.fs.s3a.secret.key": "b",
        "spark.hadoop.fs.s3a.endpoint.region": "eu-west-1",
    }


def test_session_is_in_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_scratch_space_is_the_folder_the_cluster_names(spark):
    before = spark.conf.get(CHECKPOINT_SETTING, None)
    if before:
        assert scratch_root(spark) == before.rstrip("/")
    named = SimpleNamespace(conf={CHECKPOINT_SETTING: "hdfs:///shared/"})
    assert scratch_root(named) == "hdfs:///shared"
    unnamed = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="local[2]"))
    assert scratch_root(unnamed) == scratch_root(unnamed)
    unnamed.sparkContext.master = "yarn"
    with pytest.raises(ValueError, match=CHECKPOINT_SETTING):
        scratch_root(unnamed)


def test_planned_bytes_add_up_over_joins(spark, tmp_path):
    spark.range(10_000).write.parquet(f"{tmp_path}/d")
    one = spark.read.parquet(f"{tmp_path}/d")
    other = spark.read.parquet(f"{tmp_path}/d").withColumnRenamed("id", "n")
    assert 0 < planned_bytes(one.join(other, one["id"] % 7 == other["n"] % 7)) <= 2 * planned_bytes(one)


def test_shuffle_tasks_are_a_setting_of_the_session(spark):
    assert spark.conf.get(INITIAL_TASKS_SETTING, None) is None
    from pyspark.sql import SparkSession

    class Builder:
        config = lambda self, name, value: seen.append((name, value)) or self
        appName = lambda self, name: self
        getOrCreate = lambda self: None

    seen = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(SparkSession, "builder", Builder())
        get_spark_session(hive=False, shuffle_tasks=7000)
    assert (INITIAL_TASKS_SETTING, "7000") in seen
