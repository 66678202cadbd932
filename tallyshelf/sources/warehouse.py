"""Warehouse source: a whole table, read in parallel over JDBC or a warehouse connector."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Warehouse:
    """Where a table is and how it is split over tasks.

    Give `predicates`, one per task; or a numeric `split_column` with its bounds, which only place the cuts: rows
    outside are read too. With `plan_by`, a column of numbers, text, dates or times, the warehouse is asked where to
    cut so that all of `splits` tasks get about the same number of rows, however unevenly the column is spread.
    """

    table: str
    url: str = ""
    provider: str = "jdbc"
    properties: Mapping[str, str] = field(default_factory=dict)
    predicates: Sequence[str] = ()
    split_column: str = ""
    bounds: tuple[int, int] = (0, 0)
    splits: int = 1
    fetch_rows: int = 10_000
    plan_by: str = ""

    def options(self) -> dict[str, str]:
        options = {"dbtable": self.table, **self.properties}
        if self.provider == "jdbc":
            options |= {"url": self.url, "fetchsize": str(self.fetch_rows)}
            if self.split_column:
                options |= {
                    "partitionColumn": self.split_column,
                    "lowerBound": str(self.bounds[0]),
                    "upperBound": str(self.bounds[1]),
                    "numPartitions": str(self.splits),
                }
        return options


def cuts_sql(table: str, column: str, splits: int) -> str:
    """The least value of each of `splits` equal parts of a column, in SQL that any warehouse knows.

    Parts are those of NTILE. Values are counted first, so that what has to be put in order, by one task in some
    warehouses, is one row for each distinct value. A value is the least of a part if the parts of its last row and of
    the row before its first differ.
    """

    def part(place: str) -> str:
        extra = f"(total - {splits} * FLOOR(total / {splits}))"
        longer = f"{extra} * (FLOOR(total / {splits}) + 1)"
        return (
            f"CASE WHEN {place} < 0 THEN -1 WHEN {place} < {longer} THEN FLOOR({place} / (FLOOR(total / {splits}) + 1)) "
            f"ELSE {extra} + FLOOR(({place} - {longer}) / FLOOR(total / {splits})) END"
        )

    counts = f"SELECT {column} AS value, COUNT(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}"
    runs = f"SELECT value, n, SUM(n) OVER (ORDER BY value ROWS UNBOUNDED PRECEDING) AS upto FROM ({counts}) counts"
    total = f"SELECT COUNT({column}) AS total FROM {table}"
    return (
        f"SELECT MIN(value) AS value FROM ({runs}) runs CROSS JOIN ({total}) whole "
        f"WHERE {part('(upto - 1)')} <> {part('(upto - n - 1)')} GROUP BY upto"
    )


def _literal(value: object) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, str, date)):
        raise ValueError(f"a column of {type(value).__name__} values does not split a table")
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def split_predicates(column: str, cuts: Sequence[object]) -> list[str]:
    """Conditions of which every row fulfils just one: null, and ranges from each cut to the next.

    The first and last range are open, as rows may have come since the cuts were made. Equal cuts are one.
    """
    places = [_literal(cut) for cut in sorted({c for c in cuts if c is not None})[1:]]
    if not places:
        return [f"{column} IS NULL", f"{column} IS NOT NULL"]
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in pairwise(places)]
    return [f"{column} IS NULL", f"{column} < {places[0]}", *between, f"{column} >= {places[-1]}"]


def plan_predicates(warehouse: Warehouse, ask: Callable[[str], DataFrame]) -> list[str]:
    """Predicates for `plan_by`; `ask` runs SQL in the warehouse and gets one row for each split."""
    cuts = ask(cuts_sql(warehouse.table, warehouse.plan_by, warehouse.splits)).collect()
    return split_predicates(warehouse.plan_by, [row[0] for row in cuts])


def read_warehouse_table(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    predicates = list(warehouse.predicates)
    if warehouse.provider == "jdbc" and warehouse.plan_by:
        properties = {**warehouse.properties, "url": warehouse.url}
        predicates = plan_predicates(
            warehouse, lambda sql: spark.read.format("jdbc").options(**properties, dbtable=f"({sql}) cuts").load()
        )
    if warehouse.provider == "jdbc" and predicates:
        properties = {**warehouse.properties, "fetchsize": str(warehouse.fetch_rows)}
        return spark.read.jdbc(warehouse.url, warehouse.table, predicates=predicates, properties=properties)
    return spark.read.format(warehouse.provider).options(**warehouse.options()).load()
