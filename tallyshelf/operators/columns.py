"""Operators on columns: typing, renaming and missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyshelf.functions.casting import to_type


def coerce_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast every declared column in one projection; other columns pass through.

    A declared column that the frame lacks is an analysis error.
    """
    present = {field.name.lower(): field.dataType for field in df.schema.fields}
    return df.withColumns({
        field.name: to_type(
            F.col(f"`{field.name}`"), present.get(field.name.lower(), field.dataType), field.dataType
        )
        for field in schema.fields
    })


def lower_case_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float and double columns becomes null, as SQL NULL is the only missing value."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({
        name: F.when(~F.isnan(F.col(f"`{name}`")), F.col(f"`{name}`")) for name in floating
    })
