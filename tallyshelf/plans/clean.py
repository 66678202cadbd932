"""Cleaning jobs of the three feeds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf import fixed_values as fixed
from tallyshelf.functions.casting import to_date
from tallyshelf.functions.money import cents
from tallyshelf.functions.text import key_text, plain_text, title_text
from tallyshelf.operators.accounting import Rejections, keep_valid
from tallyshelf.operators.dedup import (
    distinct_by_fingerprint,
    distinct_by_rescan,
    one_per_key,
    with_fingerprint,
)
from tallyshelf.operators.filters import has_keys, inside, not_negative, positive, zero_fill
from tallyshelf.operators.reports import observe_values
from tallyshelf.session import scratch_folder
from tallyshelf.sinks.versions import Version, replace_tables


def normalize_products(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "sku_id": key_text("sku_id"),
        "sku_name": plain_text("sku_name"),
        "category": title_text("category"),
        "subcategory": title_text("subcategory"),
        "brand": plain_text("brand"),
        "list_price": cents(F.col("list_price")),
    })


def normalize_stores(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "store_id": key_text("store_id"),
        "country": plain_text("country"),
        "city": plain_text("city"),
        "channel": plain_text("channel"),
    })


def normalize_sales(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "store_id": key_text("store_id"),
        "sku_id": key_text("sku_id"),
        "supplier_id": key_text("supplier_id"),
        "date": to_date("date"),
    })


def product_rules() -> dict[str, Column]:
    """A key, and a price that is above zero once rounded."""
    return {"sku_id is known": has_keys("sku_id"), "list_price above zero": positive("list_price")}


def store_rules() -> dict[str, Column]:
    """A key and valid coordinates."""
    return {
        "store_id is known": has_keys("store_id"),
        "latitude in range": inside("latitude", fixed.LATITUDE_RANGE),
        "longitude in range": inside("longitude", fixed.LONGITUDE_RANGE),
    }


def sales_rules() -> dict[str, Column]:
    """All keys and no negative measure."""
    keys = {f"{c} is known": has_keys(c) for c in fixed.SALES_KEYS}
    return keys | {f"{c} not negative": not_negative(c) for c in fixed.SALES_MEASURES}


def _all(rules: dict[str, Column]) -> Column:
    return reduce(and_, rules.values())


def clean_products(df: DataFrame) -> DataFrame:
    """Products with a key and a price, one row per key."""
    return one_per_key(normalize_products(df).filter(_all(product_rules())), "sku_id")


def clean_stores(df: DataFrame) -> DataFrame:
    """Stores with a key and valid coordinates, one row per key."""
    return one_per_key(normalize_stores(df).filter(_all(store_rules())), "store_id")


def clean_sales(df: DataFrame) -> DataFrame:
    """Distinct sales with all keys and no negative measure.

    Rows are filtered before they are compared, which gives the same rows as the other way round
    and shuffles fewer. Measures are filled last, since filling could make different rows equal. A feed in
    columnar files is read again rather than shuffled.
    """
    return zero_fill(distinct_by_rescan(normalize_sales(df).filter(_all(sales_rules()))), *fixed.SALES_MEASURES)


def distinct_sales_staged(valid: DataFrame, path: str) -> DataFrame:
    """The same of valid sales by way of a stored copy in `path`: only rows that may have copies are shuffled."""
    staged = with_fingerprint(valid)
    staged.write.parquet(path)
    staged = valid.sparkSession.read.schema(staged.schema).parquet(path)
    return zero_fill(distinct_by_fingerprint(staged), *fixed.SALES_MEASURES)


def clean_sales_staged(df: DataFrame, path: str) -> DataFrame:
    return distinct_sales_staged(normalize_sales(df).filter(_all(sales_rules())), path)


@dataclass(frozen=True)
class CleanTables:
    products: str = fixed.CLEAN_PRODUCTS_TABLE
    stores: str = fixed.CLEAN_STORES_TABLE
    sales: str = fixed.CLEAN_SALES_TABLE


@dataclass(frozen=True)
class CleanReport:
    """The written versions by table, and the rows that each rule kept out, by feed."""

    versions: dict[str, Version]
    rejected: Rejections


def save_clean_tables(
    spark: SparkSession,
    products: DataFrame,
    stores: DataFrame,
    sales: DataFrame,
    tables: CleanTables = CleanTables(),
    partition_by: Sequence[str] = (),
    stage_sales: bool = False,
) -> CleanReport:
    """Clean the typed feeds and replace the three tables; rows are counted, kept and rejected ones, on the way.

    A feed that lacks all values of a needed column is an error, seen while it is read. On any error all three tables
    stay as they were. With `stage_sales` valid sales are stored once more, and then only those that may have copies
    are shuffled: worth it where shuffling all sales costs more than writing them, as the feed is in no columnar files.
    """
    watched, check = observe_values(sales, fixed.SALES_KEYS + fixed.SALES_MEASURES)
    valid_products, rejected_products = keep_valid(normalize_products(products), "products", product_rules())
    valid_stores, rejected_stores = keep_valid(normalize_stores(stores), "stores", store_rules())
    valid_sales, rejected_sales = keep_valid(normalize_sales(watched), "sales", sales_rules())
    with scratch_folder(spark, "valid-sales") as path:
        if stage_sales:
            distinct = distinct_sales_staged(valid_sales, path)
            check()
        else:
            again = normalize_sales(sales).filter(_all(sales_rules()))
            distinct = zero_fill(distinct_by_rescan(again, observed=valid_sales), *fixed.SALES_MEASURES)
        frames = {
            tables.products: one_per_key(valid_products, "sku_id"),
            tables.stores: one_per_key(valid_stores, "store_id"),
            tables.sales: distinct,
        }
        versions = replace_tables(spark, frames, {tables.sales: partition_by}, check)
    return CleanReport(versions, [*rejected_products(), *rejected_stores(), *rejected_sales()])
