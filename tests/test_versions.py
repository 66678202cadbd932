"""Tables replaced by versions, and distinct rows by fingerprint."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyshelf.checks import feeds
from tallyshelf.operators import dedup
from tallyshelf.operators.reports import observe_values
from tallyshelf.plans.clean import CleanTables, clean_sales, save_clean_tables
from tallyshelf.sinks.versions import kept_versions, replace_table, replace_tables


@pytest.fixture
def name(spark):
    spark.sql("create database versions")
    yield "versions.t"
    spark.sql("drop database versions cascade")


def tables(spark):
    return {r["tableName"] for r in spark.sql("show tables in versions").collect()}


def torn(df):
    return df.withColumn("id", F.when(F.col("id") == 70, F.raise_error(F.lit("torn")).cast("long")).otherwise(F.col("id")))


def test_replacing_keeps_one_version_before(spark, name):
    for n in (5, 3, 4, 2):
        assert replace_table(spark.range(n), name).count() == n
    history = kept_versions(spark, name)
    assert [spark.table(v).count() for v in history] == [2, 4]
    assert tables(spark) == {"t", *(v.split(".")[1] for v in history)}


def test_columns_may_change(spark, name):
    replace_table(spark.range(5), name)
    changed = replace_table(spark.range(3).selectExpr("cast(id as string) a", "id b"), name)
    assert changed.columns == ["a", "b"] and changed.count() == 3


def test_a_write_that_fails_halfway_leaves_the_old_rows(spark, name):
    replace_table(spark.range(5), name)
    before = tables(spark)
    with pytest.raises(Exception, match="torn"):
        replace_table(torn(spark.range(0, 100, 1, 8)), name)
    assert spark.table(name).count() == 5 and tables(spark) == before


def test_a_reader_is_not_disturbed(spark, name):
    reader = replace_table(spark.range(5), name)
    replace_table(spark.range(9), name)
    assert reader.count() == 5 and spark.table(name).count() == 9


def test_several_tables_or_none(spark, name):
    replace_tables(spark, {name: spark.range(5), "versions.u": spark.range(6)})
    with pytest.raises(Exception, match="torn"):
        replace_tables(spark, {name: spark.range(1), "versions.u": torn(spark.range(100))})

    def refuse():
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        replace_tables(spark, {name: spark.range(1), "versions.u": spark.range(1)}, check=refuse)
    assert (spark.table(name).count(), spark.table("versions.u").count()) == (5, 6)
    assert len(tables(spark)) == 4


def test_counts_are_observed_and_partitions_kept(spark, name):
    df = spark.range(100, numPartitions=8).select("id", (F.col("id") % 3).alias("p"))
    version = replace_tables(spark, {name: df}, {name: ["p"]})[name]
    assert version.n_rows == 100 and spark.table(name).filter("p = 1").count() == 33
    assert len(spark.table(name).filter("p = 1").inputFiles()) == 1
    assert replace_tables(spark, {name: df.limit(0)})[name].n_rows == 0


def test_a_plain_table_becomes_the_version_before(spark, name):
    spark.range(7).write.saveAsTable(name)
    replace_table(spark.range(2), name)
    assert [spark.table(v).count() for v in kept_versions(spark, name)] == [2, 7]
    replace_table(spark.range(3), name)
    assert "t__v0" not in tables(spark)


def test_observed_values(spark, tmp_path):
    df = spark.createDataFrame([(1, None, None), (None, "x", None)], "a int, b string, c string")
    for columns, wrong in ((("a", "b"), ""), (("a", "c"), "c")):
        watched, check = observe_values(df, columns)
        watched.write.mode("overwrite").parquet(f"{tmp_path}/{len(wrong)}")
        if wrong:
            with pytest.raises(ValueError, match="of c$"):
                check()
        else:
            check()
    watched, check = observe_values(df.limit(0), ("c",))
    watched.write.parquet(f"{tmp_path}/empty")
    check()


def odd_rows(spark):
    rows = [(1, 0.0, None), (1, -0.0, None), (None, 1.0, "a"), (None, 1.0, "a"), (2, float("nan"), "b"), (2, float("nan"), "b")]
    rows += [(k, float(k), "x") for k in range(100)] + [(7, 7.0, "x")] * 50 + [(None, None, None)] * 3 + [(None, None, "a"), (None, None, "a")]
    return spark.createDataFrame(rows, "a int, b double, c string").repartition(5)


def stored(df, path):
    dedup.with_fingerprint(df).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def plain(df):
    return Counter(tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("limit", [0, 2, 10**6])
def test_distinct_by_fingerprint(spark, tmp_path, limit):
    df = odd_rows(spark)
    found = dedup.distinct_by_fingerprint(stored(df, f"{tmp_path}/rows"), limit=limit)
    assert found.columns == df.columns and plain(found) == plain(df.dropDuplicates())


def test_rows_of_one_fingerprint_are_compared_whole(spark, tmp_path):
    df = odd_rows(spark)
    df.withColumn(dedup.FINGERPRINT, F.lit(1).cast("long")).write.parquet(f"{tmp_path}/rows")
    found = dedup.distinct_by_fingerprint(spark.read.parquet(f"{tmp_path}/rows"))
    assert plain(found) == plain(df.dropDuplicates())


def test_no_copies_no_shuffle(spark, tmp_path):
    rows = stored(spark.range(50).selectExpr("id", "id + 0.5D b"), f"{tmp_path}/rows")
    found = dedup.distinct_by_fingerprint(rows)
    assert found.count() == 50 and "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert dedup.distinct_by_fingerprint(rows.limit(0)).count() == 0


def shuffled_rows(node):
    """(columns, rows) of each exchange of rows in a plan that has run."""
    name = node.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return shuffled_rows(node.executedPlan())
    found = []
    if name.endswith("QueryStage"):
        return shuffled_rows(node.plan())
    if name == "Exchange":
        found.append((node.output().size(), node.metrics().apply("shuffleRecordsWritten").value()))
    children = node.children()
    return found + [x for k in range(children.size()) for x in shuffled_rows(children.apply(k))]


def test_only_rows_that_may_have_copies_are_shuffled_whole(spark, tmp_path):
    once = spark.range(5000).selectExpr("id", "id * 2 b", "cast(id as string) c")
    df = once.unionByName(once.filter("id < 20"))
    found = dedup.distinct_by_fingerprint(stored(df, f"{tmp_path}/rows"))
    assert len(found.collect()) == 5000
    wide = [n for columns, n in shuffled_rows(found._jdf.queryExecution().executedPlan()) if columns >= 3]
    assert wide and sum(wide) <= 40


@pytest.mark.parametrize("limit", [0, 10**6])
def test_distinct_by_rescan(spark, tmp_path, limit):
    odd_rows(spark).write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    found = dedup.distinct_by_rescan(df, limit=limit)
    assert found.columns == df.columns and plain(found) == plain(df.dropDuplicates())
    assert {str(v) for r in found.collect() for v in r} == {str(v) for r in df.dropDuplicates().collect() for v in r}


def test_cleaned_sales_without_copies_are_not_shuffled(spark, tmp_path):
    """Whole rows that go through an exchange are those that may have copies."""
    lines = spark.range(3000).selectExpr(
        "id l_orderkey", "1 l_linenumber", "id % 50 l_partkey", "id % 7 l_suppkey", "1.0D + id l_quantity", "2.0D * id l_extendedprice",
        "0.1D l_discount", "0.02D l_tax", "'R' l_returnflag", "timestamp'2024-01-05' l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    feeds.raw_sales(spark, str(tmp_path)).write.parquet(f"{tmp_path}/sales")
    cleaned = clean_sales(spark.read.parquet(f"{tmp_path}/sales"))
    n = len(cleaned.collect())
    wide = [rows for columns, rows in shuffled_rows(cleaned._jdf.queryExecution().executedPlan()) if columns >= 3]
    assert wide and sum(wide) < n / 10


def test_rows_that_change_or_cost_more_when_read_again_are_shuffled(spark, tmp_path):
    spark.range(200).write.parquet(f"{tmp_path}/rows")
    stored_rows = spark.read.parquet(f"{tmp_path}/rows")
    assert dedup._is_columnar_scan(stored_rows.filter("id > 3").selectExpr("id % 7 k"))
    random = stored_rows.select((F.rand() * 5).cast("int").alias("k"))
    stored_rows.write.json(f"{tmp_path}/text")
    text = spark.read.schema("id long").json(f"{tmp_path}/text")
    passed = stored_rows.mapInArrow(lambda batches: batches, "id long")
    joined = stored_rows.join(stored_rows.withColumnRenamed("id", "k"), F.col("id") == F.col("k")).drop("k")
    assert not any(map(dedup._is_columnar_scan, (random, text, passed, joined, spark.range(3))))
    assert dedup.distinct_by_rescan(random).count() <= 5
    assert all(dedup.distinct_by_rescan(df).count() == 200 for df in (text, passed, joined))


def test_saved_clean_sales_are_not_shuffled_whole(spark, tmp_path, name, monkeypatch):
    lines = spark.range(3000).selectExpr(
        "id l_orderkey", "1 l_linenumber", "id % 50 l_partkey", "id % 7 l_suppkey", "1.0D + id l_quantity", "2.0D * id l_extendedprice",
        "0.1D l_discount", "0.02D l_tax", "'R' l_returnflag", "timestamp'2024-01-05' l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    sales = feeds.raw_sales(spark, str(tmp_path))
    products = spark.createDataFrame([("sku-1", "n", "c", "s", "b", 2.0)], "sku_id string, sku_name string, category string, subcategory string, brand string, list_price double")
    stores = spark.createDataFrame([("st-1", "c", "c", "c", 1.0, 1.0)], "store_id string, country string, city string, channel string, latitude double, longitude double")
    shuffled = []
    monkeypatch.setattr(dedup, "distinct_rows", lambda df: shuffled.append(df.count()) or df.dropDuplicates())
    done = save_clean_tables(spark, products, stores, sales, CleanTables("versions.p", "versions.s", "versions.t"))
    wanted = clean_sales(sales.filter("sku_id is not null")).count()
    assert done.versions["versions.t"].n_rows == wanted and 0 < shuffled[0] < wanted / 10
    assert ("sales", "any rule") in {r[:2] for r in done.rejected}
