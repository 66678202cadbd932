"""The three raw feeds, derived from the test tables with dirt on purpose.

Keys come padded, in lower case and null; prices null and zero; coordinates null and out of range;
dates unreadable; measures null and negative; rows and keys twice. `oracles.py` states the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf.schemas import SALES_SCHEMA, as_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(prefix: str, column: str, suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"), F.lit(suffix))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    number = F.col("p_partkey")
    dirty = part.select(
        F.when(number % 97 != 5, _text(" sku-", "p_partkey", " ")).alias("sku_id"),
        _text(" ", "p_name").alias("sku_name"),
        _text("", "p_type", " goods ").alias("category"),
        _text(" ", "p_name").alias("subcategory"),
        _text("", "p_brand", " ").alias("brand"),
        F.when(number % 53 == 0, F.lit(None).cast("double"))
        .when(number % 50 == 1, F.lit(0.0))
        .otherwise(F.col("p_retailprice"))
        .alias("list_price"),
    )
    repeated = part.filter(number % 10 == 0).select(
        _text("SKU-", "p_partkey").alias("sku_id"),
        F.lit("dup").alias("sku_name"),
        F.col("p_type").alias("category"),
        F.col("p_name").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        (F.col("p_retailprice") + 1).alias("list_price"),
    )
    return dirty.unionByName(repeated)


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    number = F.col("s_suppkey")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            _text("st-", "s_suppkey", " ").alias("store_id"),
            _text("", "n_name", " ").alias("country"),
            F.concat(F.lit(" City "), (number % 7).cast("string")).alias("city"),
            F.col("r_name").alias("channel"),
            F.when(number % 41 != 3, ((number * 37) % 190 - 94).cast("double")).alias("latitude"),
            ((number * 91) % 370 - 184).cast("double").alias("longitude"),
        )
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("l_orderkey")
    # Rows of every hundredth order come twice; a repeated array does it in one scan.
    copies = F.when(order % 100 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    weekday = (order + F.col("l_linenumber")) % 7
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return (
        table(spark, sf_dir, "lineitem")
        .select("*", F.explode(copies).alias("copy"))
        .select(
            F.when(order % 211 == 0, "bad-date")
            .otherwise(F.col("l_shipdate").cast("date").cast("string"))
            .alias("date"),
            F.year("l_shipdate").alias("year"),
            F.month("l_shipdate").alias("month"),
            F.dayofmonth("l_shipdate").alias("day"),
            F.weekofyear("l_shipdate").alias("weekofyear"),
            weekday.cast("int").alias("weekday"),
            weekday.isin(0, 6).cast("int").alias("is_weekend"),
            (order % 30 == 0).cast("int").alias("is_holiday"),
            (F.col("l_tax") * 400 - 2.0).alias("temperature"),
            (F.col("l_tax") * 100).alias("rain_mm"),
            _text(" st-", "l_suppkey").alias("store_id"),
            _text("sku-", "l_partkey", " ").alias("sku_id"),
            F.when(order % 307 == 0, F.lit(None).cast("int"))
            .when(order % 401 == 0, F.lit(-1))
            .otherwise(F.col("l_quantity").cast("int"))
            .alias("units_sold"),
            (discount * 6).alias("discount_pct"),
            (discount > 0).cast("int").alias("promo_flag"),
            price.alias("gross_sales"),
            (F.floor(price * (1 - discount) * 100) / 100).alias("net_sales"),
            (F.col("l_linenumber") * 10).cast("int").alias("stock_on_hand"),
            (F.col("l_returnflag") == "R").cast("int").alias("stock_out_flag"),
            (order % 21).cast("int").alias("lead_time_days"),
            _text("sup-", "l_suppkey").alias("supplier_id"),
            (F.floor(price / F.col("l_quantity") * 70) / 100).alias("purchase_cost"),
            F.lit(0.3).alias("margin_pct"),
        )
    )


def sales_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales feed as it lies on disk: every value text."""
    sales = raw_sales(spark, sf_dir)
    return sales.select(*[F.col(name).cast("string").alias(name) for name in as_text(SALES_SCHEMA).names])
