"""Spark schemas of the feeds and of the message envelope."""

from __future__ import annotations

from pyspark.sql import types as T

from tallyshelf import fixed_values as fixed


def _struct(columns: dict[str, str]) -> T.StructType:
    schema = T.StructType()
    for name, type_name in columns.items():
        schema.add(name, type_name, True)
    return schema


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all strings: how a feed looks on disk before it is typed."""
    return T.StructType([T.StructField(name, T.StringType()) for name in schema.fieldNames()])


def table_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def envelope_schema(row_schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("batch_id", T.IntegerType()),
        T.StructField("rows", T.ArrayType(as_text(row_schema))),
    ])


PRODUCTS_SCHEMA = _struct(fixed.PRODUCTS)
STORES_SCHEMA = _struct(fixed.STORES)
SALES_SCHEMA = _struct(fixed.SALES)
