"""Money measures of a sale, in doubles rounded half up to two places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    return F.round(amount, 2)


def discount_amount() -> Column:
    return cents(F.col("gross_sales") - F.col("net_sales"))


def total_cost() -> Column:
    return cents(F.col("purchase_cost") * F.col("units_sold"))


def profit_amount() -> Column:
    """Taken from the already rounded `total_cost`, so that the published columns add up."""
    return cents(F.col("net_sales") - F.col("total_cost"))


def revenue_per_unit() -> Column:
    """0.0 where nothing, or an unknown number, was sold."""
    per_unit = cents(F.col("net_sales") / F.col("units_sold"))
    return F.when(F.col("units_sold") > 0, per_unit).otherwise(F.lit(0.0))
