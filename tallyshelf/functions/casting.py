"""Casts that give null for text that does not fit, in every ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A digit and no letter.
_NUMBER_LIKE = r"\A[^a-zA-Z0-9]*[0-9][^a-zA-Z]*\z"


def to_type(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast leniently. Decimal text is cut to its whole part for an integer column: '3.7' is 3.

    Text with an exponent or a suffix, as in '1e3', is no integer. Such text, and text without a digit, is not cast at
    all, as a cast that fails costs an exception each time. The expression is kept short on
    purpose: a stage casts dozens of columns, and the JVM does not compile methods beyond 8000 bytes.
    """
    if source == target:
        return column
    cast = column.try_cast(target)
    if isinstance(source, T.StringType) and isinstance(target, T.IntegerType):
        decimal = column.try_cast("double").try_cast(target)
        return F.when(column.rlike(_NUMBER_LIKE), F.coalesce(cast, decimal))
    return cast


def to_date(column: str) -> Column:
    return F.col(column).try_cast("date")
