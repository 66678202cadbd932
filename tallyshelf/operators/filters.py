"""Row filters of the cleaning jobs. A null never passes a comparison."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_keys(*keys: str) -> Column:
    """All keys known. '' is a known key."""
    return reduce(and_, [F.col(key).isNotNull() for key in keys])


def positive(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) > 0)


def inside(column: str, bounds: tuple[float, float]) -> Column:
    return F.col(column).between(*bounds)


def not_negative(*columns: str) -> Column:
    return reduce(and_, [F.col(column) >= 0 for column in columns])


def zero_fill(df: DataFrame, *columns: str) -> DataFrame:
    """0 for null, and for NaN: NaN sorts above every number and so passes `not_negative`."""
    return df.na.fill(0, subset=list(columns))
