"""The curated sales table: star join, labels and measures, final columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyshelf import fixed_values as fixed
from tallyshelf.functions import labels, money
from tallyshelf.operators.joins import BROADCAST_BYTES, join_sources
from tallyshelf.plans.clean import CleanTables
from tallyshelf.sinks.versions import Version, replace_tables


def apply_transformations(df: DataFrame) -> DataFrame:
    """Add the labels and measures. Two steps, as the profit builds on the rounded cost."""
    return df.withColumns({
        "season": labels.season(),
        "weekday_name": labels.weekday_name(),
        "discount_amount": money.discount_amount(),
        "total_cost": money.total_cost(),
    }).withColumns({
        "profit_amount": money.profit_amount(),
        "revenue_per_unit": money.revenue_per_unit(),
        "discount_band": labels.discount_band(),
        "inventory_risk": labels.inventory_risk(),
    })


def build_final_df(enriched: DataFrame) -> DataFrame:
    return enriched.select(*fixed.OVERVIEW_COLUMNS)


def retail_sales_overview(
    sales: DataFrame, products: DataFrame, stores: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The curated rows of three clean frames.

    Only columns that reach the result are measured and broadcast. With both dimensions broadcast
    this is one pass over the sales without a shuffle.
    """
    wanted = {*fixed.OVERVIEW_COLUMNS, "sku_id", "store_id"}
    dimensions = (df.select(*[c for c in df.columns if c in wanted]) for df in (products, stores))
    joined = join_sources(sales, *dimensions, broadcast_bytes)
    return joined.transform(apply_transformations).transform(build_final_df)


def save_overview(
    spark: SparkSession,
    clean: CleanTables = CleanTables(),
    table: str = fixed.OVERVIEW_TABLE,
    partition_by: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> Version:
    """Build the curated table from the clean tables and replace it, whole or not at all."""
    frames = (spark.table(name) for name in (clean.sales, clean.products, clean.stores))
    overview = retail_sales_overview(*frames, broadcast_bytes)
    return replace_tables(spark, {table: overview}, {table: partition_by})[table]
