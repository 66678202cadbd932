from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tallyshelf import fixed_values as fixed
from tallyshelf.checks import feeds, queries
from tallyshelf.operators import joins
from tallyshelf.operators.columns import coerce_columns
from tallyshelf.operators.dedup import newest_per_key
from tallyshelf.operators.joins import broadcast_if_small, broadcast_rows_if_few, join_sources, measured_bytes
from tallyshelf.plans.clean import clean_products, clean_sales, clean_stores
from tallyshelf.plans.overview import retail_sales_overview
from tallyshelf.schemas import SALES_SCHEMA

SF_DIR = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def star(spark):
    rows = [("s1", "k1", 1), ("s1", "k2", 2), ("s9", "k1", 3), ("s1", None, 4)]
    sales = spark.createDataFrame(rows, "store_id string, sku_id string, n int")
    products = spark.createDataFrame([("k1", "tea"), ("k3", "oil")], "sku_id string, sku_name string")
    stores = spark.createDataFrame([("s1", "Chile")], "store_id string, country string")
    return sales, products, stores


def test_unmatched_sales_are_left_out(spark):
    joined = join_sources(*star(spark))
    assert joined.columns == ["store_id", "sku_id", "n", "sku_name", "country"]
    assert [tuple(r) for r in joined.collect()] == [("s1", "k1", 1, "tea", "Chile")]


def test_measured_size_counts_slots_and_text(spark):
    df = spark.createDataFrame([("äb", 1.0), (None, None)], "a string, b double")
    assert measured_bytes(df) == 2 * (16 + 16 * 2) + 3
    assert measured_bytes(df.limit(0)) == 0


def test_broadcasts_are_behind_a_size_check(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("string").alias("k")).write.parquet(f"{tmp_path}/d")
    dim = spark.read.parquet(f"{tmp_path}/d")
    facts = spark.range(10).select(F.col("id").cast("string").alias("k"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert "BroadcastHashJoin" in plan(facts.join(broadcast_if_small(dim, 1_000_000), "k"))
        assert "BroadcastHashJoin" not in plan(facts.join(broadcast_if_small(dim, 20_000), "k"))
        assert "BroadcastHashJoin" not in plan(facts.join(broadcast_if_small(dim, 10), "k"))
        assert "BroadcastHashJoin" in plan(facts.join(broadcast_rows_if_few(dim, 1000), "k"))
        assert "BroadcastHashJoin" not in plan(facts.join(broadcast_rows_if_few(dim, 999), "k"))
    assert broadcast_rows_if_few(dim.limit(0)) is None


def test_a_hot_product_is_split_where_dimensions_are_too_big_to_broadcast(spark, tmp_path):
    spark.range(60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("sku_id"),
        F.lit("s1").alias("store_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    ).write.parquet(f"{tmp_path}/sales")
    keys = spark.range(60_000).select(F.col("id").cast("string").alias("sku_id"))
    keys.unionByName(spark.createDataFrame([("hot",)], "sku_id string")).write.parquet(f"{tmp_path}/products")
    sales, products = spark.read.parquet(f"{tmp_path}/sales"), spark.read.parquet(f"{tmp_path}/products")
    stores = spark.createDataFrame([("s1",)], "store_id string")
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="300k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2.0",
    ):
        joined = join_sources(sales, products, stores)
        assert joined.agg(F.count("*")).first()[0] == 60_000
        joined.write.format("noop").mode("overwrite").save()
        executed = joined.select("sku_id", "payload")
        executed.collect()
        assert "skew=true" in plan(executed)


def test_the_overview_is_one_narrow_pass_over_clean_tables(spark, tmp_path):
    for name, job in (("sales", clean_sales), ("products", clean_products), ("stores", clean_stores)):
        job(getattr(feeds, f"raw_{name}")(spark, SF_DIR)).write.parquet(f"{tmp_path}/{name}")
    read = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in ("sales", "products", "stores")}
    overview = retail_sales_overview(read["sales"], broadcast_if_small(read["products"]), broadcast_if_small(read["stores"]))
    text = plan(overview)
    assert "Exchange hashpartitioning" not in text and text.count("BroadcastHashJoin") == 2
    assert "Python" not in text
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 3
    for unused in ("weekofyear", "supplier_id", "latitude", "longitude", "list_price"):
        assert not any(f"{unused}#" in scan for scan in scans)
    assert overview.columns == list(fixed.OVERVIEW_COLUMNS)
    assert dict(overview.dtypes)["date"] == "date"


def test_the_registered_overview_broadcasts_both_dimensions_behind_a_check(spark, monkeypatch):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(queries.q_retail_sales_overview(spark, SF_DIR))
        sales = text[text.index("BroadcastHashJoin") :]
        assert sales.count("BroadcastHashJoin [") + sales.count("BroadcastHashJoin") >= 2
        # The only exchange of the sales is that of their duplicates.
        wide = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "units_sold" in line]
        assert len(wide) == 1
        monkeypatch.setattr(joins, "measured_bytes", lambda df: 1 << 40)
        text = plan(queries.q_retail_sales_overview(spark, SF_DIR))
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


def test_cleaning_sales_is_one_shuffle_with_partial_aggregation(spark, tmp_path):
    feeds.raw_sales(spark, SF_DIR).write.parquet(f"{tmp_path}/sales")
    text = plan(clean_sales(spark.read.parquet(f"{tmp_path}/sales")))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("HashAggregate") == 2
    assert text.index("Filter") > text.rindex("HashAggregate") and "IsNotNull(units_sold)" in text
    assert "Python" not in text


def longest_method(spark, df) -> int:
    """Bytes of the longest method that any whole stage of the plan is compiled to."""
    with settings(spark, spark__sql__adaptive__enabled="false"):
        fresh = df.select("*")._jdf.queryExecution().executedPlan()
        stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(fresh)
        return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))


@pytest.mark.parametrize("file_format", ["json", "parquet"])
def test_typing_and_cleaning_text_stays_short_enough_for_the_jvm_to_compile(spark, tmp_path, file_format):
    text = feeds.sales_text(spark, SF_DIR)
    text.write.format(file_format).save(f"{tmp_path}/text")
    read = spark.read.schema(text.schema).format(file_format).load(f"{tmp_path}/text")
    assert longest_method(spark, clean_sales(coerce_columns(read, SALES_SCHEMA))) < 8000


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_newest_version_per_key(spark, monkeypatch, limit):
    monkeypatch.setattr(broadcast_rows_if_few, "__defaults__", (limit,))
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 5, "w"), (None, 1, "n")]
    df = spark.createDataFrame(rows, "k string, v int, t string")
    assert sorted(r.t for r in newest_per_key(df, "k", ["v"]).collect()) == ["n", "w", "y", "z"]
    versions = spark.createDataFrame([("b", 5), ("b", 6)], "k string, v int")
    assert sorted(r.t for r in newest_per_key(df, "k", ["v"], versions=versions).collect()) == ["n", "x", "y", "z"]


def test_untouched_where_no_key_has_several_versions(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    assert newest_per_key(df, "k", ["v"]) is df
