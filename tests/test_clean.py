from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import functions as F

from tallyshelf import fixed_values as fixed
from tallyshelf.checks import feeds
from tallyshelf.operators.dedup import one_per_key
from tallyshelf.operators.filters import not_negative, zero_fill
from tallyshelf.plans.clean import clean_products, clean_sales, clean_stores, save_clean_tables
from tallyshelf.schemas import PRODUCTS_SCHEMA, SALES_SCHEMA, STORES_SCHEMA

SF_DIR = "/root/testdata/sf0.001"
NAN = float("nan")


def products(spark, *rows):
    return spark.createDataFrame(rows, PRODUCTS_SCHEMA)


def stores(spark, *rows):
    return spark.createDataFrame(rows, STORES_SCHEMA)


def sale(**changes):
    row = dict(
        date="2024-01-02", year=2024, month=1, day=2, weekofyear=1, weekday=2, is_weekend=0, is_holiday=0,
        temperature=10.0, rain_mm=0.0, store_id="s1", sku_id="k1", units_sold=3, discount_pct=0.0, promo_flag=0,
        gross_sales=30.0, net_sales=27.0, stock_on_hand=50, stock_out_flag=0, lead_time_days=3, supplier_id="p1",
        purchase_cost=5.0, margin_pct=0.3,
    )
    assert set(changes) <= set(row)
    return tuple((row | changes).values())


def sales(spark, *rows):
    return spark.createDataFrame(rows, SALES_SCHEMA)


def test_products_are_normalised(spark):
    df = products(spark, (" ab-1 ", " Nice Tea ", "HOT drinks", " foo-bar  baz ", " Brand ", 1.005))
    assert clean_products(df).first() == ("AB-1", "Nice Tea", "Hot Drinks", "Foo-bar  Baz", "Brand", 1.01)


def test_price_is_tested_after_rounding(spark):
    df = products(
        spark, ("a", "", "", "", "", 0.004), ("b", "", "", "", "", 0.005), ("c", "", "", "", "", None),
        ("d", "", "", "", "", -1.0), ("e", "", "", "", "", 0.0),
    )
    assert [(r.sku_id, r.list_price) for r in clean_products(df).collect()] == [("B", 0.01)]


def test_blank_key_is_kept_and_null_key_is_not(spark):
    df = products(spark, ("   ", "x", "", "", "", 1.0), (None, "y", "", "", "", 1.0))
    assert [r.sku_id for r in clean_products(df).collect()] == [""]


def test_trim_takes_blanks_only(spark):
    df = products(spark, ("\tk ", "x", "", "", "", 1.0))
    assert clean_products(df).first().sku_id == "\tK"


def test_survivor_is_the_smallest_row_nulls_first(spark):
    df = products(
        spark, ("k", "b", "c", "d", "e", 1.0), ("K ", "a", "c", "d", "e", 9.0), ("k", "a", "c", "d", "e", 2.0),
        ("z", "a", "c", "d", "e", 1.0), ("z", None, "c", "d", "e", 5.0),
    )
    kept = {r.sku_id: (r.sku_name, r.list_price) for r in clean_products(df).collect()}
    assert kept == {"K": ("a", 2.0), "Z": (None, 5.0)}


@pytest.mark.parametrize("latitude, longitude, kept", [
    (90.0, 180.0, True), (-90.0, -180.0, True), (90.1, 0.0, False), (0.0, -180.1, False),
    (None, 0.0, False), (0.0, None, False), (NAN, 0.0, False),
])
def test_coordinates(spark, latitude, longitude, kept):
    df = stores(spark, ("s", "c", "t", "ch", latitude, longitude))
    assert clean_stores(df).count() == int(kept)


def test_one_store_per_key(spark):
    df = stores(spark, ("s ", "b", "t", "ch", 1.0, 1.0), ("S", " a", "t", "ch", 2.0, 2.0))
    assert [tuple(r) for r in clean_stores(df).collect()] == [("S", "a", "t", "ch", 2.0, 2.0)]


@pytest.mark.parametrize("changes", [
    {"date": "bad-date"}, {"date": None}, {"store_id": None}, {"sku_id": None}, {"units_sold": -1},
    {"units_sold": None}, {"gross_sales": -0.01}, {"net_sales": None}, {"stock_on_hand": -5}, {"purchase_cost": None},
])
def test_invalid_sales_are_dropped(spark, changes):
    assert clean_sales(sales(spark, sale(**changes))).isEmpty()


def test_sales_are_typed_and_compared_after_normalising(spark):
    df = sales(spark, sale(sku_id=" k1"), sale(sku_id="K1 "), sale(supplier_id="other"))
    cleaned = clean_sales(df).orderBy("supplier_id").collect()
    assert [(r.sku_id, r.supplier_id) for r in cleaned] == [("K1", "OTHER"), ("K1", "P1")]
    assert cleaned[0].date == datetime.date(2024, 1, 2)


def test_nan_passes_the_check_and_becomes_zero_after_duplicates_went(spark):
    rows = clean_sales(sales(spark, sale(gross_sales=NAN), sale(gross_sales=0.0))).collect()
    assert [r.gross_sales for r in rows] == [0.0, 0.0]


def test_fill_does_not_bring_nulls_back(spark):
    df = spark.createDataFrame([(None,), (NAN,), (-1.0,), (2.0,)], "a double")
    assert sorted(r.a for r in zero_fill(df.filter(not_negative("a")), "a").collect()) == [0.0, 2.0]
    assert sorted(r.a for r in zero_fill(df, "a").collect()) == [-1.0, 0.0, 0.0, 2.0]


def test_other_measures_may_be_missing(spark):
    row = clean_sales(sales(spark, sale(discount_pct=None, temperature=NAN))).first()
    assert row.discount_pct is None and math.isnan(row.temperature)


def test_undeclared_columns_pass_through(spark):
    df = products(spark, ("k", "n", "c", "s", "b", 1.0)).withColumn("note", F.lit("x"))
    assert clean_products(df).columns == [*fixed.PRODUCTS, "note"]


@pytest.mark.parametrize("feed, job", [
    (feeds.raw_products, clean_products), (feeds.raw_stores, clean_stores), (feeds.raw_sales, clean_sales),
])
def test_cleaning_is_idempotent_and_independent_of_partitioning(spark, feed, job):
    raw = feed(spark, SF_DIR)
    once = sorted(map(str, job(raw).collect()))
    again = job(raw.repartition(7))
    assert sorted(map(str, again.collect())) == once
    again = again.withColumn("date", F.col("date").cast("string")) if "date" in again.columns else again
    assert sorted(map(str, job(again).collect())) == once


def test_one_per_key_with_a_key_only(spark):
    assert one_per_key(spark.createDataFrame([("a",), ("a",), (None,)], "k string"), "k").count() == 2


def test_a_feed_that_lacks_a_needed_column_is_refused(spark):
    empty = sales(spark, sale(net_sales=None), sale(net_sales=None, store_id="s2"))
    with pytest.raises(ValueError, match="net_sales"):
        save_clean_tables(spark, products(spark), stores(spark), empty)
