from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyshelf import fixed_values as fixed
from tallyshelf.functions import labels, money
from tallyshelf.plans.overview import apply_transformations, build_final_df
from tests.test_clean import sale, sales


def label(spark, column, schema, *values):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize("rain, temperature, expected", [
    (5.0, 7.9, "Winter"), (5.1, 7.9, "Monsoon"), (0.0, 8.0, "Autumn/Spring"), (0.0, 17.0, "Autumn/Spring"),
    (0.0, 17.1, "Summer"), (None, None, "Autumn/Spring"), (None, 3.0, "Winter"), (6.0, None, "Monsoon"),
])
def test_season(spark, rain, temperature, expected):
    assert label(spark, labels.season(), "rain_mm double, temperature double", rain, temperature) == expected


@pytest.mark.parametrize("weekday, expected", [
    (0, "Sunday"), (1, "Monday"), (2, "Tuesday"), (3, "Wednesday"), (4, "Thursday"), (5, "Friday"),
    (6, "Saturday"), (7, "Saturday"), (-1, "Saturday"), (None, "Saturday"),
])
def test_weekday_name(spark, weekday, expected):
    assert label(spark, labels.weekday_name(), "weekday int", weekday) == expected


@pytest.mark.parametrize("discount, expected", [
    (0.0, "No Discount"), (-0.0, "No Discount"), (-0.2, "0-10%"), (0.10, "0-10%"), (0.1000001, "10-25%"),
    (0.25, "10-25%"), (0.50, "25-50%"), (0.51, "50%+"), (None, "50%+"), (float("nan"), "50%+"),
])
def test_discount_band(spark, discount, expected):
    assert label(spark, labels.discount_band(), "discount_pct double", discount) == expected


@pytest.mark.parametrize("out, stock, units, days, expected", [
    (1, 100, 1, 0, "Stock Out"), (0, 1, 2, 20, "Understocked"), (0, 2, 2, 14, "Long Lead Time"),
    (0, 2, 2, 13, "Normal"), (None, None, None, None, "Normal"), (None, None, 5, 14, "Long Lead Time"),
    (2, 0, 1, None, "Understocked"),
])
def test_inventory_risk(spark, out, stock, units, days, expected):
    schema = "stock_out_flag int, stock_on_hand int, units_sold int, lead_time_days int"
    assert label(spark, labels.inventory_risk(), schema, out, stock, units, days) == expected


def test_profit_builds_on_the_rounded_cost(spark):
    # 0.335 * 3 is 1.005, which rounds up to 1.01: 2.0 - 1.01, not round(2.0 - 1.005).
    row = apply_transformations(sales(spark, sale(purchase_cost=0.335, units_sold=3, net_sales=2.0))).first()
    assert (row.total_cost, row.profit_amount) == (1.01, 0.99)


@pytest.mark.parametrize("net, units, expected", [
    (10.0, 3, 3.33), (10.0, 0, 0.0), (10.0, None, 0.0), (10.0, -2, 0.0), (None, 3, None), (0.0, 3, 0.0),
])
def test_revenue_per_unit(spark, net, units, expected):
    assert label(spark, money.revenue_per_unit(), "net_sales double, units_sold int", net, units) == expected


def test_rounding_is_half_up_on_the_decimal_text(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (2.675,)], "a double")
    assert [r[0] for r in df.select(money.cents(F.col("a"))).collect()] == [1.01, -1.01, 2.68]


def test_enriched_columns_come_last_in_order(spark):
    added = apply_transformations(sales(spark, sale())).columns[len(fixed.SALES):]
    assert added == [
        "season", "weekday_name", "discount_amount", "total_cost", "profit_amount", "revenue_per_unit",
        "discount_band", "inventory_risk",
    ]


def test_final_columns(spark):
    df = spark.createDataFrame([tuple(range(24))], [*reversed(fixed.OVERVIEW_COLUMNS), "revenue_per_unit"])
    assert build_final_df(df).columns == list(fixed.OVERVIEW_COLUMNS)
