"""Runs of numbers: what is missing between the numbers that were delivered, and what came several times.

Numbers of one source follow each other without gaps if nothing was lost. There may be few sources and very many
numbers, so no window runs over a source: numbers are taken in spans of `SPAN`, and the spans of a source meet only by
their ends, one row for each, and by the repeated ranges that touch a span's edge, two for each at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = 1_000_000
MISSING, REPEATED = "missing", "repeated"


def _range(kind: str, first: Column, last: Column, deliveries: Column) -> list[Column]:
    return [F.lit(kind).alias("kind"), first.alias("first"), last.alias("last"), deliveries.alias("deliveries")]


def _islands(df: DataFrame, by: list[str], source: str) -> DataFrame:
    """Ranges of one source that follow each other without a gap, with equal deliveries, as one; windows are by `by`."""
    order = Window.partitionBy(*by).orderBy("first")
    follows = (F.lag("last").over(order) == F.col("first") - 1) & (
        F.lag("deliveries").over(order) == F.col("deliveries")
    )
    starts = df.withColumn("_new", F.when(follows, 0).otherwise(1))
    island = F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        starts.withColumn("_island", island)
        .groupBy(*by, "_island", "deliveries")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .select(source, "first", "last", "deliveries")
    )


def delivery_ranges(
    numbers: DataFrame, source: str, number: str, start: int | None = None, span: int = SPAN
) -> DataFrame:
    """(source, kind, first, last, deliveries): missing ranges, and the longest repeated ones of equal deliveries.

    `numbers` has one row for each delivery. Rows without a number are left out; a null source is a source of its own.
    A source begins at `start` or at its smallest number, whichever is less; nothing tells whether numbers after its
    largest were lost. Without gaps and repetitions there are no rows.
    """
    counted = (
        numbers.select(F.col(source), F.col(number).cast("long").alias("first"))
        .filter(F.col("first").isNotNull())
        .groupBy(source, "first")
        .agg(F.count("*").alias("deliveries"))
        .withColumn("_span", F.floor(F.col("first") / span))
    )
    within = Window.partitionBy(source, "_span").orderBy("first")
    stepped = counted.withColumn("_before", F.lag("first").over(within))
    nothing = F.lit(0).cast("long")
    between = _range(MISSING, F.col("_before") + 1, F.col("first") - 1, nothing)
    inner = stepped.filter(F.col("first") - F.col("_before") > 1).select(source, *between)

    ends = counted.groupBy(source, "_span").agg(F.min("first").alias("first"), F.max("first").alias("last"))
    spans = Window.partitionBy(source).orderBy("_span")
    before = F.lag("last").over(spans)
    outer = ends.withColumn("_before", before if start is None else F.coalesce(before, F.lit(start - 1).cast("long")))
    outer = outer.filter(F.col("first") - F.col("_before") > 1).select(source, *between)

    several = counted.filter(F.col("deliveries") > 1).withColumn("last", F.col("first"))
    ranges = _islands(several, [source, "_span"], source)
    at_edge = (F.pmod(F.col("first"), F.lit(span)) == 0) | (F.pmod(F.col("last"), F.lit(span)) == span - 1)
    joined = _islands(ranges.filter(at_edge), [source], source)
    repeated = ranges.filter(~at_edge).unionByName(joined)
    repeated = repeated.select(source, *_range(REPEATED, F.col("first"), F.col("last"), F.col("deliveries")))
    return inner.unionByName(outer).unionByName(repeated)
