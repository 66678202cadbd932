from __future__ import annotations

import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyshelf.operators import split_join
from tallyshelf.operators.joins import join_sources
from tallyshelf.operators.split_join import heavy_keys, join_sources_split, save_split, split_facts
from tests.test_joins import plan, settings, star


@pytest.fixture
def database(spark):
    name = f"split_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def skewed(spark, rows=3000):
    """A third of all rows on `hot`, a tenth on `warm`, a tenth without a key, the rest spread."""
    k = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, "warm").when(F.col("id") % 10 == 2, None)
    return spark.range(rows, numPartitions=5).select(
        k.otherwise((F.col("id") % 700).cast("string")).alias("sku_id"),
        F.concat(F.lit("s"), (F.col("id") % 4).cast("string")).alias("store_id"),
        F.col("id").cast("int").alias("n"),
    )


def dimensions(spark):
    names = spark.range(600).select(F.col("id").cast("string").alias("sku_id"))
    names = names.unionByName(spark.createDataFrame([("hot",), ("hot",), ("warm",), (None,)], "sku_id string"))
    products = names.select("sku_id", F.monotonically_increasing_id().cast("string").alias("sku_name"))
    stores = spark.createDataFrame([("s0", "Chile"), ("s1", "Peru"), (None, "Nowhere")], "store_id string, country string")
    return products, stores


def rows(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def test_heavy_keys_are_those_above_the_share(spark):
    assert heavy_keys(skewed(spark), "sku_id", 0.05) == ["hot", "warm"]
    assert heavy_keys(skewed(spark), "sku_id", 0.2) == ["hot"]
    assert heavy_keys(skewed(spark).limit(0), "sku_id") == []
    assert heavy_keys(spark.createDataFrame([(None,)], "sku_id string"), "sku_id") == []


@pytest.mark.parametrize("share", [0.9, 0.05, 0.0001])
@pytest.mark.parametrize("bound", [0, 500, 1 << 20])
def test_split_joins_give_what_the_join_gives(spark, database, share, bound):
    sales, (products, stores) = skewed(spark), dimensions(spark)
    wanted = join_sources(sales, products, stores)
    for split in (split_facts(sales, "sku_id", share), save_split(sales, "sku_id", f"{database}.sales", 4, share)):
        found = join_sources_split(split, products, stores, bound)
        assert set(found.columns) == set(wanted.columns) and rows(found) == rows(wanted)


def test_small_and_empty_inputs(spark):
    sales, products, stores = star(spark)
    for some in (sales, sales.limit(0)):
        for dims in ((products, stores), (products.limit(0), stores), (products, stores.limit(0))):
            found = join_sources_split(split_facts(some, "sku_id"), *dims, 0)
            assert rows(found) == rows(join_sources(some, *dims))


def test_stored_sales_are_not_shuffled(spark, database):
    products, _ = dimensions(spark)
    split = save_split(skewed(spark), "sku_id", f"{database}.sales", 8, 0.05)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        joined = split_join.join_split(split, products, 1000)
        text = plan(joined)
    assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") == 1
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and ", 8)" in exchanges[0]
    # The one exchange is that of the products: what is below it is no scan of sales.
    below = text[text.index("Exchange hashpartitioning") :]
    assert "sales_rest" not in below and "sku_name" in text
    assert not split.rest.filter(F.col("sku_id").isin("hot", "warm")).count()
